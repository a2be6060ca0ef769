"""Mixing sources to target weights by iterative proportional fitting.

Token weights are raked to target shares per source, language and topic; documents are then sampled with the calibrated
probabilities. The contingency table has one row per source, with its tokens by language and topic as an array (both are
short, given lists), so a round of fitting is one narrow aggregate however many sources there are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgeo.llm.common import WORD, count_chars, uniform_hash, written

OTHER = "other"
PATIENCE = 8  # rounds without a smaller miss after which targets count as unreachable


@dataclass(frozen=True)
class Mix:
    """Targets. Shares are relative; ``other`` (values not listed, or null) keeps its own share unless it is listed.

    ``source_power``: a source's target is its tokens to this power (1: as found, 0: all alike).
    ``keep``: the share of all tokens that the sample should hold.
    """

    languages: dict[str, float] = field(default_factory=lambda: {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1})
    topics: dict[str, float] = field(default_factory=lambda: {"prose": 0.93, "table": 0.05, "symbols": 0.01, "shouting": 0.009, "brief": 0.001})
    source_power: float = 0.7
    keep: float = 0.6
    rounds: int = 100
    tolerance: float = 1e-6
    seed: int = 3


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where the optimiser unfolds expressions."""
    return F.transform(F.array(value), use)[0]


def labels_of(text: Column, source: Column, lang: Column) -> Column:
    """Struct ``source, lang, topic, tokens`` of a document: its words, and its register from counts over the whole text.

    A null source is ``other``, a null text is empty.
    """

    def count(pattern: str) -> Column:
        return F.regexp_count(body, F.lit(pattern))

    body = F.coalesce(text.cast("string"), F.lit(""))

    def topic(words: Column) -> Column:
        return (
            F.when(words < 20, "brief")
            .when(count(r"\|") * 10 > words, "table")
            .when(count(r"[#*$%&<>]") * 3 > words, "symbols")
            .when(count_chars(body, "A-Z") > count_chars(body, "a-z"), "shouting")
            .otherwise("prose")
        )

    fixed = [F.coalesce(source.cast("string"), F.lit(OTHER)).alias("source"), lang.cast("string").alias("lang")]
    return bound(count(WORD), lambda words: F.struct(*fixed, topic(words).alias("topic"), words.cast("long").alias("tokens")))


def labelled(docs: DataFrame, keys: list[Column], text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """``keys`` and the labels of every document."""
    return docs.select(*keys, labels_of(docs[text], docs[source], docs[lang]).alias("_label")).select(*[F.col(k) for k in docs.select(*keys).columns], "_label.*")


def _targets(wanted: dict[str, float], names: list[str], found: np.ndarray) -> np.ndarray:
    """Target shares of the categories that have tokens; an unlisted ``other`` keeps its own share."""
    own = found / found.sum()
    listed = np.array([wanted.get(n, 0.0) for n in names])
    free = np.array([n not in wanted for n in names])
    share = np.where(free, own, 0.0)
    listed = np.where(found > 0, listed, 0.0)
    if listed.sum() > 0:
        share += listed / listed.sum() * (1 - share.sum())
    return share / share.sum() if share.sum() > 0 else own


@dataclass
class Fit:
    """Result of the fit: a factor per source (DataFrame), per language and per topic, the scale, and what was reached."""

    sources: DataFrame
    languages: dict[str, float]
    topics: dict[str, float]
    scale: float
    rounds: int
    residual: float


def fit(rows: DataFrame, mix: Mix) -> Fit:
    """Rake the token weights of ``rows`` (source, lang, topic, tokens) to the targets of ``mix``.

    Each round sets every source's factor from the current language and topic factors and sums the table by language and
    topic, in one job; the driver holds only those sums. Stops when all language and topic shares are within the tolerance
    (sources are exact by then), else after ``mix.rounds`` rounds, or when ``PATIENCE`` rounds together
    brought no progress (1 %): no weights can meet the targets then. ``residual`` is the largest miss of a share.
    """
    langs = [*[n for n in mix.languages if n != OTHER], OTHER]
    topics = [*[n for n in mix.topics if n != OTHER], OTHER]
    size = len(langs) * len(topics)
    where = lambda c, names: F.coalesce(*[F.when(F.col(c) == n, i) for i, n in enumerate(names[:-1])], F.lit(len(names) - 1))
    at = where("lang", langs) * len(topics) + where("topic", topics)
    placed = rows.filter("tokens > 0").select("source", "tokens", at.alias("at"))
    cells = written(
        placed.groupBy("source").agg(F.array(*[F.sum(F.when(F.col("at") == k, F.col("tokens")).otherwise(0)).cast("double") for k in range(size)]).alias("w")), "mixing-cells"
    )
    tokens = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    total_power = cells.agg(F.sum(F.pow(tokens(F.col("w")), F.lit(mix.source_power)))).first()[0]
    if not total_power:
        return Fit(cells.select("source", F.lit(1.0).alias("factor")), dict.fromkeys(langs, 1.0), dict.fromkeys(topics, 1.0), 1.0, 0, 0.0)
    target = F.pow(tokens(F.col("w")), F.lit(mix.source_power)) / total_power

    def weighted(b: np.ndarray, c: np.ndarray) -> Column:
        by = F.array(*[F.lit(float(x)) for x in np.outer(b, c).ravel()])
        return F.zip_with("w", by, lambda w, f: w * f)

    def table(factor: Column) -> np.ndarray:
        sums = cells.withColumn("f", factor).agg(*[F.sum(F.col("f") * F.col("w")[k]) for k in range(size)]).first()
        return np.array([x or 0.0 for x in sums]).reshape(len(langs), len(topics))

    b, c = np.ones(len(langs)), np.ones(len(topics))
    found = table(F.lit(1.0))
    want_lang, want_topic = _targets(mix.languages, langs, found.sum(axis=1)), _targets(mix.topics, topics, found.sum(axis=0))
    rounds, residual, misses = 0, np.inf, []
    over = lambda want, have: np.divide(want, have, out=np.zeros_like(want), where=have > 0)
    while rounds < mix.rounds:
        rounds += 1
        by_source = table(target / tokens(weighted(b, c)))
        have = by_source * np.outer(b, c)
        residual = max(np.abs(have.sum(axis=1) - want_lang).max(), np.abs(have.sum(axis=0) - want_topic).max())
        misses.append(residual)
        if residual < mix.tolerance or (rounds > PATIENCE and residual > 0.99 * misses[-1 - PATIENCE]):
            break
        b = over(want_lang, (by_source * c).sum(axis=1))
        c = over(want_topic, (by_source * b[:, None]).sum(axis=0))
    factor = target / tokens(weighted(b, c))
    sources = written(cells.select("source", "w", factor.alias("factor")), "mixing-factors")
    # p = min(1, scale * weight): raise the scale until the expected tokens of the sample are the wanted share
    budget, scale = mix.keep * found.sum(), 0.0
    each = [(F.col("w")[k], F.col("factor") * float(x)) for k, x in enumerate(np.outer(b, c).ravel())]
    for _ in range(mix.rounds):
        full = lambda f, s=scale: f * s >= 1
        capped, rest = sources.agg(
            F.sum(sum((F.when(full(f), w).otherwise(0.0) for w, f in each), F.lit(0.0))), F.sum(sum((F.when(full(f), 0.0).otherwise(w * f) for w, f in each), F.lit(0.0)))
        ).first()
        new = (budget - capped) / rest if rest > 0 else scale
        if new <= scale * (1 + 1e-9):
            break
        scale = new
    return Fit(sources.select("source", "factor"), dict(zip(langs, b.tolist(), strict=True)), dict(zip(topics, c.tolist(), strict=True)), scale, rounds, float(residual))


def scaled_weight(done: Fit, label: Column, factor: Column) -> Column:
    """The sampling probability before it is cut at 1; 0 without tokens."""
    by = lambda c, given: F.coalesce(*[F.when(label[c] == n, F.lit(float(x))) for n, x in given.items() if n != OTHER], F.lit(float(given[OTHER])))
    return F.when(label["tokens"] > 0, F.round(factor * by("lang", done.languages) * by("topic", done.topics) * done.scale, 9)).otherwise(0.0)


def sample(rows: DataFrame, key: Column, mix: Mix) -> DataFrame:
    """``rows`` with ``weight`` (relative to an even sample), ``probability`` and ``sampled``, and what the fit reached, the
    same in every row: ``residual``, the largest miss of a target share, and ``rounds``.

    ``rows`` has ``source, lang, topic, tokens``. A row is sampled if a number made from ``key`` alone falls below its
    probability, so the choice is the same in any run, order or partitioning, and repeated rows go together. Rows without
    tokens have weight 0 and are not sampled. A very long text weighs by its tokens; an empty table gives no rows.
    """
    rows = written(rows, "mixing-rows")
    done = fit(rows, mix)
    known = rows.join(done.sources, "source", "left")
    known = known.withColumn("_p", scaled_weight(done, F.struct("source", "lang", "topic", "tokens"), F.col("factor"))).drop("factor")
    known = known.withColumns({"weight": F.round(F.col("_p") / mix.keep, 9), "probability": F.least(F.lit(1.0), "_p")}).drop("_p")
    known = known.withColumn("sampled", uniform_hash(key, F.lit(mix.seed)) < F.col("probability"))
    return known.withColumns({"residual": F.lit(done.residual), "rounds": F.lit(done.rounds)})


def draw(docs: DataFrame, mix: Mix, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """The sampled rows of ``docs``, all columns. Rows are told apart by key and text, so null keys are drawn like others.

    The texts are read twice (to fit, then to draw) and never shuffled: a row meets its source's factor only.
    """
    done = fit(labelled(docs, [], text, source, lang), mix)
    factors = done.sources.select(F.col("source").alias("_of"), "factor")
    chosen = docs.join(factors, F.coalesce(docs[source].cast("string"), F.lit(OTHER)) == factors["_of"], "left")
    chance = bound(labels_of(docs[text], docs[source], docs[lang]), lambda label: scaled_weight(done, label, factors["factor"]))
    drawn = uniform_hash(F.xxhash64(docs[key], docs[text]), F.lit(mix.seed)) < F.coalesce(chance, F.lit(0.0))
    return chosen.filter(drawn).select(*[docs[c] for c in docs.columns])
