"""Quality rules as a short-circuit cascade.

DataFrame functions only. Counts of words, symbols, repeated lines and repeated 8-word windows are computed for every
document. The other rules are tried one after the other until one rejects; their order is by rejections per second, both
estimated on a sample. The order changes what it costs, never what is kept.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgeo.llm.common import ASCII_SPACE, WORD, count_chars, uniform_hash, written

SPACE = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS = 20
REPEATED_PERCENT = 30

SAMPLE_DOCS = 2000  # documents on which costs and rejections are estimated (expected number)
RUNS = 5  # timed runs of each rule


@dataclass(frozen=True)
class Rule:
    """``rejects``: a condition on ``text`` and the base counts."""

    name: str
    rejects: Column


def default_rules() -> list[Rule]:
    t, words, chars = F.col("text"), F.col("n_words"), F.col("word_chars")
    count = lambda p: F.regexp_count(t, F.lit(p))
    # words in runs of three and more of the same word
    runs = F.regexp_extract_all(t, F.lit(r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]+)(?:\x20\1(?![^\x20\x09-\x0D])){2,}"), F.lit(0))
    in_runs = F.aggregate(runs, F.lit(0), lambda n, run: n + F.regexp_count(run, F.lit(WORD)))
    return [
        Rule("symbols", F.col("n_symbols") * 10 > words),
        Rule("repeated_lines", F.col("n_dup_lines") * 2 > count(r"\n") + 1),
        Rule("word_runs", in_runs * 100 > 15 * words),
        Rule("long_words", chars > 15 * words),
        Rule("short_words", chars < 2 * words),
        Rule("shouting", count_chars(t, "A-Z") > count_chars(t, "a-z")),
        Rule("digits", count_chars(t, "0-9") * 10 > 3 * chars),
        Rule("few_letters", count_chars(t, r"\p{L}") * 10 < 5 * chars),
        Rule("exclamations", count("!") * 4 > words),
        Rule("ellipses", count(r"(?m)(\.\.\.|…)[ \t]*$") * 10 > 3 * (count(r"\n") + 1)),
        Rule("code", count(r"[{};]") * 10 > words),
    ]


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long) of the whole ``text``.

    Words are runs of non-space (ASCII). ``n_repeat_words`` counts the words that stand in an 8-word window found twice or
    more in the text: windows are hashed, sorted with their places, and the places of equal neighbours cover the words. A
    null text counts as empty. All of it happens within the row, in n log n steps.
    """
    trimmed = F.btrim(text, F.lit(ASCII_SPACE))
    rows = docs.withColumn("_words", F.when(F.length(trimmed) > 0, F.split(trimmed, f"{SPACE}+")).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("n_words", F.size("_words").cast("long"))
    at = lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(WINDOW)])
    rows = rows.withColumn("_windows", F.when(F.col("n_words") > WINDOW, F.transform(F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")), at)).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn("_repeats", F.size(F.array_distinct("_windows")) < F.size("_windows")).drop("_words")
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_placed", F.when(F.col("_repeats"), placed)).drop("_windows")
    same = lambda x, k: F.coalesce(F.get(F.col("_placed"), k)["h"] == x["h"], F.lit(False))
    places = F.sort_array(F.transform(F.filter("_placed", lambda x, k: F.when(k > 0, same(x, k - 1)).otherwise(False) | same(x, k + 1)), lambda x: x["i"]))
    rows = rows.withColumn("_places", F.when(F.col("_repeats"), places)).drop("_placed")
    cover = F.transform("_places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_places"), k + 1) - p, F.lit(WINDOW))).cast("long"))
    rows = rows.withColumn("n_repeat_words", F.coalesce(F.aggregate(cover, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))).drop("_places", "_repeats")
    rows = rows.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(ASCII_SPACE))) > 0))
    rows = rows.withColumn("n_dup_lines", F.coalesce(F.size("_lines") - F.size(F.array_distinct("_lines")), F.lit(0)).cast("long")).drop("_lines")
    zero = F.lit(0)
    return rows.withColumns(
        {
            "word_chars": F.coalesce(F.length(text) - F.regexp_count(text, F.lit(SPACE)), zero).cast("long"),
            "n_symbols": F.coalesce(F.regexp_count(text, F.lit(SYMBOL)), zero).cast("long"),
        }
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_PERCENT)


def cascade_order(counted: DataFrame, rules: list[Rule]) -> list[Rule]:
    """The rules by rejections per second on ``counted`` (a sample with its base counts), the most first.

    Each rule runs over the whole sample in one task, so that its time is work and not waiting; the rules take turns, and the
    median of the runs counts.
    """
    alone = counted.coalesce(1)

    def timed(c: Column) -> tuple[float, int]:
        began = time.perf_counter()
        n = alone.agg(F.sum(c.cast("int"))).first()[0]
        return time.perf_counter() - began, n or 0

    jobs = [F.lit(True), *[r.rejects for r in rules]]
    runs = [[timed(c) for c in jobs] for _ in range(1 + RUNS)][1:]  # the first turn opens files and compiles
    seconds = [median(run[i][0] for run in runs) for i in range(len(jobs))]
    worth = [(runs[0][i][1] + 0.5) / max(seconds[i] - seconds[0], 1e-3) for i in range(1, len(jobs))]
    return [r for _, _, r in sorted(((-w, i, r) for i, (w, r) in enumerate(zip(worth, rules, strict=True))), key=lambda x: x[:2])]


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: list[Rule] | None = None, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``key``, the base counts, ``base_failed``, ``kept`` and ``rejected_by`` for every row.

    ``base_failed``: fewer than 20 words, or over 30 % of the words repeated. ``kept`` is false for those and for rows that
    a rule rejects; ``rejected_by`` names ``base`` or the first rule of the cascade that did. Rows with a null or empty text
    have no words and fail. Repeated rows and null keys give one row each; other columns are not read. Texts are read whole, in
    n log n steps; an empty table gives no rows.
    """
    rules = default_rules() if rules is None else rules
    rows = docs.select(docs[key].alias(key), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    total = rows.count()
    share = min(1.0, sample_docs / total) if total else 1.0
    sample = written(base_counts(rows.filter(uniform_hash(F.col(key), F.lit(6)) < share)), "quality-sample")
    ordered = cascade_order(sample.filter(~base_failed()), rules)
    verdict = F.when(base_failed(), "base")
    for rule in ordered:  # a CASE: what stands after the first true condition is not evaluated
        verdict = verdict.when(rule.rejects, rule.name)
    counted = base_counts(rows).withColumn("rejected_by", verdict).drop("text")
    # written, as a later filter on the verdict would otherwise be unfolded into all the counts
    return written(counted.withColumns({"base_failed": base_failed(), "kept": F.col("rejected_by").isNull()}), "quality-verdicts")
