"""Secret scans: fixed patterns, and a battery of randomness tests for strings that no pattern names.

DataFrame functions only. Candidate strings get an inferred encoding; chi-squared uniformity over that alphabet, a runs test
and a serial-correlation test say whether a string looks random. How unlikely a natural string would have symbols so unlike
those of words is its p-value for false-discovery control (Benjamini-Hochberg) within a class of encoding and length. What
is natural comes from the symbols of the corpus's ordinary words, so it needs no natural strings of the same encoding.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgeo.llm.common import written

# The patterns of the contract. Runs of hex digits and AKIA strings are maximal, so their least length can
# stand in the pattern; an assignment that is too short still uses up its text, so its length is checked afterwards.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# encoding: (pattern, alphabet); the first that fits
ENCODINGS = {
    "decimal": (r"^[0-9]+$", _DIGITS),
    "hex": (r"^[0-9a-f]+$|^[0-9A-F]+$", _DIGITS + "abcdef"),
    "base32": (r"^[A-Z2-7]+$", _UPPER + "234567"),
    "base62": (r"^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS),
    "base64": (r"", _UPPER + _LOWER + _DIGITS + "+/"),
}
LENGTHS = (32, 48, 80, 160)  # bounds of the length classes

BATTERY_LEVEL = 0.001  # a random string fails the battery with this probability
DISCOVERY_RATE = 0.05
NATURAL_LEVEL = 1e-6  # strings that fail the battery so clearly show which symbols natural strings have
PRIOR_STRINGS = 10.0  # natural strings of an encoding that weigh as much as the words
ANY_SYMBOL = 0.1  # the share of a natural string's symbols that may be anything
# Symbols of words in any case, and how they count (1,000 symbols in all) besides the corpus's words
SYMBOLS = _LOWER + _DIGITS + "+/"
USUAL = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1) + (2,) * 10 + (1, 1)
P_BINS = 400  # bins of log p, 0.1 wide: the false-discovery step sees counts per bin, never a list of all strings

_CHUNK = 256


def starts(gaps: Column, sizes: Column) -> Column:
    """Start of each match, from the lengths of the stretches before each match and of the matches.

    Running sums in two levels (chunks, then their totals), so that the work stays near linear in the matches.
    """
    none = F.array().cast("array<bigint>")

    def running(a: Column, b: Column) -> Column:
        zero = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))
        return F.aggregate(
            F.arrays_zip(a.alias("g"), b.alias("s")),
            zero,
            lambda acc, x: F.struct(
                (acc["at"] + F.coalesce(x["g"], F.lit(0)) + F.coalesce(x["s"], F.lit(0))).cast("bigint").alias("at"),
                F.concat(acc["out"], F.array((acc["at"] + F.coalesce(x["g"], F.lit(0))).cast("bigint"))).alias("out"),
            ),
        )

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _CHUNK).cast("int")), lambda c: running(F.slice(gaps, c * _CHUNK + 1, _CHUNK), F.slice(sizes, c * _CHUNK + 1, _CHUNK)))
    return F.when(F.size(sizes) == 0, none).otherwise(_joined(chunks))


def _joined(chunks: Column) -> Column:
    """The chunks' starts, each moved by the total of the chunks before."""
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<array<bigint>>").alias("out"))
    moved = F.aggregate(
        chunks,
        zero,
        lambda acc, c: F.struct((acc["at"] + c["at"]).alias("at"), F.concat(acc["out"], F.array(F.transform(c["out"], lambda x: x + acc["at"]))).alias("out")),
        lambda acc: acc["out"],
    )
    return F.flatten(moved)


def with_matches(rows: DataFrame, name: str, text: str, pattern: str, worth: Column, group: int = 0) -> DataFrame:
    """``rows`` with the array ``name`` of ``start, end, token`` of every match, in code points; ``token`` is ``group``.

    Matches and the stretches between them come from the same pattern, so they alternate. ``worth`` is a cheap test without
    which there is no match.
    """
    g, s, t = f"_{name}_gaps", f"_{name}_sizes", f"_{name}_tokens"
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn(t, F.when(worth, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    any_ = F.size(t) > 0
    rows = rows.withColumns(
        {
            g: F.when(any_, F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(t)), lambda x: F.length(x).cast("bigint"))).otherwise(none),
            s: F.when(any_, F.transform(t, lambda x: F.length(x).cast("bigint"))).otherwise(none),
        }
    )
    rows = rows.withColumn(f"_{name}_starts", F.when(any_, starts(F.col(g), F.col(s))).otherwise(none))
    if group:
        rows = rows.withColumn(t, F.when(any_, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(F.col(t)))
    zipped = F.arrays_zip(F.col(f"_{name}_starts").alias("a"), F.col(s).alias("n"), F.col(t).alias("t"))
    made = F.transform(zipped, lambda x: F.struct(x["a"].alias("start"), (x["a"] + x["n"]).alias("end"), x["t"].alias("token")))
    return rows.withColumn(name, made).drop(g, s, t, f"_{name}_starts")


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0, relative error below 1.2e-7 (Chebyshev fit)."""
    # fixed values: the coefficients of the fit, highest power first
    coefficients = (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223)
    t = F.lit(1.0) / (F.lit(1.0) + x * 0.5)
    sum_ = F.lit(coefficients[0])
    for c in coefficients[1:]:
        sum_ = sum_ * t + c
    return t * F.exp(sum_ - x * x)


def upper_tail(z: str) -> Column:
    """P(Z >= z) of a standard normal variable."""
    half = erfc(F.abs(z) / 2**0.5) / 2
    return F.when(F.col(z) >= 0, half).otherwise(1 - half)


def battery(strings: DataFrame) -> DataFrame:
    """``strings`` (with ``token``) with ``encoding, n, m, chi2, counts`` (of each symbol) and ``p_random``, the battery's combined p-value."""
    rows = strings.withColumn("encoding", F.coalesce(*[F.when(F.col("token").rlike(p), F.lit(e)) for e, (p, _) in ENCODINGS.items()]))
    alphabet = F.coalesce(*[F.when(F.col("encoding") == e, F.lit(a)) for e, (_, a) in ENCODINGS.items()])
    body = F.when(F.col("encoding") == "hex", F.lower("token")).otherwise(F.translate("token", "-_", "+/"))
    rows = rows.withColumns({"_alphabet": alphabet, "_body": body})
    rows = rows.withColumn("_x", F.transform(F.split("_body", ""), lambda c: F.instr(F.col("_alphabet"), c) - 1))
    rows = rows.withColumns({"n": F.size("_x").cast("double"), "m": F.length("_alphabet").cast("double")})
    total = lambda c, f: F.aggregate(c, F.lit(0.0), lambda a, x: a + f(x))
    rows = rows.withColumn("_counts", F.transform(F.sequence(F.lit(0), (F.col("m") - 1).cast("int")), lambda k: F.size(F.filter("_x", lambda x: x == k)).cast("double")))
    rows = rows.withColumns({"_mean": total("_x", lambda x: x) / F.col("n"), "_high": total("_x", lambda x: F.when(x * 2 >= F.col("m"), 1.0).otherwise(0.0))})
    pairs = F.arrays_zip(F.slice("_x", F.lit(1), F.size("_x") - 1).alias("a"), F.slice("_x", F.lit(2), F.size("_x") - 1).alias("b"))
    rows = rows.withColumns(
        {
            "chi2": total("_counts", lambda o: o * o) * F.col("m") / F.col("n") - F.col("n"),
            "_var": total("_x", lambda x: (x - F.col("_mean")) * (x - F.col("_mean"))),
            "_cov": total(pairs, lambda p: (p["a"] - F.col("_mean")) * (p["b"] - F.col("_mean"))),
            "_runs": total(pairs, lambda p: F.when((p["a"] * 2 >= F.col("m")) != (p["b"] * 2 >= F.col("m")), 1.0).otherwise(0.0)) + 1,
            "_expect": F.col("_high") * (F.col("n") - F.col("_high")) * 2 / F.col("n") + 1,
        }
    )
    df = F.col("m") - 1
    spread = (F.col("_expect") - 1) * (F.col("_expect") - 2) / (F.col("n") - 1)
    rows = rows.withColumns(
        {
            "_z_even": (F.col("chi2") - df) / F.sqrt(df * 2 * (F.col("n") - 1) / F.col("n")),
            # all symbols in one half, or one symbol only: no run or correlation to speak of, as far from random as can be
            "_z_runs": F.when(spread > 0, F.abs(F.col("_runs") - F.col("_expect")) / F.sqrt(spread)).otherwise(40.0),
            "_z_serial": F.when(F.col("_var") > 0, F.abs(F.col("_cov") / F.col("_var") + 1 / F.col("n")) * F.sqrt("n")).otherwise(40.0),
        }
    )
    log_p = [F.log(F.greatest(p, F.lit(1e-300))) for p in (upper_tail("_z_even"), 2 * upper_tail("_z_runs"), 2 * upper_tail("_z_serial"))]
    rows = rows.withColumn("_fisher", -(log_p[0] + log_p[1] + log_p[2]))
    f = F.col("_fisher")
    rows = rows.withColumn("p_random", F.exp(-f) * (1 + f + f * f / 2))
    return rows.withColumn("counts", F.col("_counts")).drop(*[c for c in rows.columns if c.startswith("_") and c != "_row"])


def words_of(text: Column) -> Column:
    """``text`` without its candidate strings, in lower case and with one character for each symbol of base64."""
    words = F.when(text.rlike(CANDIDATE), F.regexp_replace(text, CANDIDATE, " ")).otherwise(text)
    return F.replace(F.replace(F.lower(words), F.lit("-"), F.lit("+")), F.lit("_"), F.lit("/"))


def symbol_counts(words: str) -> Column:
    """How often each of ``SYMBOLS`` stands in the column ``words``."""
    return F.array(*[(F.octet_length(words) - F.octet_length(F.replace(F.col(words), F.lit(c), F.lit("")))).cast("long") for c in SYMBOLS])


def natural_scores(words: list[float], natural: dict[str, tuple[float, list[float]]]) -> dict[str, list[float]]:
    """For each encoding the log ratio of every symbol's probability in a random and in a natural string.

    ``words``: counts of ``SYMBOLS`` in words; ``natural``: number of natural strings of an encoding, and sums of their shares
    of each symbol. Letters of words count for either case, as words may be written in both.
    """
    of = {c: w + u for c, w, u in zip(SYMBOLS, words, USUAL, strict=True)}
    out = {}
    for encoding, (_, alphabet) in ENCODINGS.items():
        plain = [of[c.lower()] for c in alphabet]
        k, shares = natural.get(encoding, (0, [0.0] * len(alphabet)))
        mixed = [(PRIOR_STRINGS * w / sum(plain) + s) / (PRIOR_STRINGS + k) for w, s in zip(plain, shares, strict=True)]
        out[encoding] = [-math.log((1 - ANY_SYMBOL) * p * len(alphabet) + ANY_SYMBOL) for p in mixed]
    return out


def discoveries(tested: DataFrame, words: list[float]) -> DataFrame:
    """The rows of ``tested`` that are taken for secrets: random by the battery, and past the false-discovery threshold.

    A natural string whose likelihood ratio of random to natural symbols is r or more has a probability of 1 / r at most,
    whatever its length: so 1 / r is its p-value.
    """
    most = max(len(a) for _, a in ENCODINGS.values())
    shares = [F.sum((F.get("counts", F.lit(k)) / F.col("n")).cast("decimal(30,9)")).cast("double") for k in range(most)]
    seen = tested.filter(F.col("p_random") < NATURAL_LEVEL).groupBy("encoding").agg(F.count("*").alias("k"), F.array(*shares).alias("shares")).collect()  # a row per encoding
    natural = {r["encoding"]: (r["k"], r["shares"][: len(ENCODINGS[r["encoding"]][1])]) for r in seen}
    scores = F.coalesce(*[F.when(F.col("encoding") == e, F.array(*[F.lit(x) for x in s])) for e, s in natural_scores(words, natural).items()])
    length = F.coalesce(*[F.when(F.col("n") < b, i) for i, b in enumerate(LENGTHS)], F.lit(len(LENGTHS)))
    ratio = F.aggregate(F.zip_with("counts", scores, lambda o, s: o * s), F.lit(0.0), lambda a, x: a + x)
    rows = tested.withColumns({"length": length, "bin": F.least(F.lit(P_BINS), F.floor(F.greatest(ratio, F.lit(0.0)) * 10)).cast("int")})
    # Benjamini-Hochberg on bins: strings of a bin or a smaller p, and the largest p in the bin
    group = ["encoding", "length"]
    counts = rows.groupBy(*group, "bin").agg(F.count("*").alias("n_bin"))  # at most encodings x lengths x bins rows
    whole = counts.groupBy(*group).agg(F.sum("n_bin").alias("n_all"))
    deeper = counts.select(*group, F.col("bin").alias("other"), F.col("n_bin").alias("n_other"))
    upto = counts.join(deeper, group).filter("other >= bin").groupBy(*group, "bin").agg(F.sum("n_other").alias("n_upto"))
    passed = upto.join(whole, group).filter(F.exp(-F.col("bin") / 10.0) * F.col("n_all") <= DISCOVERY_RATE * F.col("n_upto"))
    threshold = passed.groupBy(*group).agg(F.min("bin").alias("least_bin"))
    return rows.join(threshold, group).filter((F.col("bin") >= F.col("least_bin")) & (F.col("p_random") >= BATTERY_LEVEL))


def _ranked(kind: str) -> Column:
    """The matches of a kind as spans; the order of kinds stands for itself in sorting."""
    return F.transform(kind, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind")))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, spans`` for every row: ``spans`` is an array of ``start, rank, end, kind``, sorted.

    Offsets are code points of the whole text, ends exclusive. Kinds: ``assign``, ``access``, ``hex`` (fixed patterns), and
    ``random`` (the battery's finds that overlap no other span). A null or empty text has no spans. Repeated rows and null
    keys give one row each; other columns are not read. What is kept between the two passes is the spans and symbol counts.
    Texts are read whole, whatever their length; an empty table gives no rows.
    """
    rows = docs.select(docs[key].alias(key), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    t = F.col("text")
    rows = with_matches(rows, "assign", "text", ASSIGN, t.rlike(ASSIGN), group=2)
    rows = with_matches(rows, "access", "text", ACCESS, t.contains("AKIA"))
    rows = with_matches(rows, "hex", "text", HEX, t.rlike(HEX))
    rows = with_matches(rows, "candidates", "text", CANDIDATE, t.rlike(CANDIDATE))
    rows = rows.withColumn("assign", F.filter("assign", lambda x: F.length(x["token"]) >= ASSIGN_LEAST))
    ranked = [_ranked(k) for k in KINDS[:3]]
    rows = rows.withColumn("_words", words_of(t)).select(key, F.concat(*ranked).alias("base"), "candidates", symbol_counts("_words").alias("symbols"), F.monotonically_increasing_id().alias("_row"))
    found = written(rows, "secrets-found")
    words = [float(x or 0) for x in found.agg(*[F.sum(F.col("symbols")[k]) for k in range(len(SYMBOLS))]).first()]
    strings = found.filter(F.size("candidates") > 0).select("_row", "base", F.explode("candidates").alias("c")).select("_row", "base", "c.*")
    tested = written(battery(strings), "secrets-tested")
    free = ~F.exists("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"]))
    new = F.struct("start", F.lit(3).alias("rank"), "end", F.lit(KINDS[3]).alias("kind"))
    added = discoveries(tested, words).filter(free).groupBy(F.col("_row").alias("_of")).agg(F.collect_list(new).alias("added"))
    joined = found.join(added, F.col("_row") == F.col("_of"), "left")
    return joined.select(key, F.sort_array(F.concat("base", F.coalesce("added", F.slice("base", F.lit(1), F.lit(0))))).alias("spans"))


def count_kind(spans: Column | str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
