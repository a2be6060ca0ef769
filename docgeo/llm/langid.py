"""Language identification by Bayesian evidence fusion.

Independent pieces of evidence are added as log-likelihoods per language: the text (byte trigrams), the language a page
declares, the suffix of its address, and a prior of its host. All but the text model are learned from the rows themselves
by grouped sums of the text's own posteriors; the host's prior is smoothed by its domain's, that by the corpus's. Each row's
own share is taken out of the sums it is judged by. One more class, ``und``, stands for text of no known language.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgeo.llm.common import map_arrow, slices, uniform_hash, written

LANGUAGES = ("en", "de", "fr", "es")
UNDETERMINED = "und"

# Labelled documents per language that the text model is fitted on (expected number; a hash sample of all labelled ones).
TRAINING_DOCS = 2000

BUCKETS = 1 << 16
SMOOTHING = 0.005  # added to each trigram's count: little, as the back-off serves unseen trigrams of known letters
BACK_OFF = 0.1  # share of the letters' own distribution in a language's, for trigrams that it was not seen with
UND_UNIFORM = 0.3  # share of the even distribution in the und class

# A trigram shares two bytes with the next one, so a text of n trigrams counts as n / 3 independent observations.
OVERLAP = 3.0

# Pseudo-rows with which the level above smooths a host and a domain, and the corpus a declared value or suffix.
HOST_ROWS, DOMAIN_ROWS, VALUE_ROWS = 5.0, 20.0, 10.0

_SCALE = 1_000_000  # posteriors are summed as whole millionths, so that no sum depends on its order
_SPACE = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in range(256))


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of the lower-cased text; digits and punctuation count as space, runs of space don't count."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_SPACE) + b" ", dtype=np.uint8)
    keep = raw != 32
    keep[1:] |= raw[:-1] != 32  # the first space of a run stays
    keep[0] = True
    raw = raw[keep].astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, dtype=np.uint32)
    return (((raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]) * np.uint32(2654435761)) >> np.uint32(16)


def _count(languages: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Trigram counts per language, and under ``und`` those of the same texts with their characters in random order."""
        for batch in batches:
            for part in slices(batch, "text"):
                counts = np.zeros((len(languages) + 1, BUCKETS), dtype=np.int64)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    chars = np.array(list(text))
                    np.random.default_rng(len(text)).shuffle(chars)
                    counts[languages.index(lang)] += np.bincount(trigrams(text), minlength=BUCKETS)
                    counts[-1] += np.bincount(trigrams("".join(chars.tolist())), minlength=BUCKETS)
                row, bucket = np.nonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(bucket), pa.array(counts[row, bucket])], names=["row", "bucket", "n"])

    return run


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", languages: Iterable[str] = LANGUAGES, docs: int = TRAINING_DOCS) -> np.ndarray:
    """Log-probabilities ``[bucket, language..., und]`` from a hash sample of about ``docs`` labelled rows per language.

    Rows without text or with another label are not used; a language without rows gets the even distribution. What comes
    to the driver is bounded by languages times buckets.
    """
    languages = list(languages)
    named = labelled.select(labelled[lang].alias("lang"), labelled[text].cast("string").alias("text"), labelled[key].alias("key")).filter(F.col("lang").isin(languages))
    n = {r["lang"]: r["count"] for r in named.groupBy("lang").count().collect()}
    share = F.coalesce(*[F.when(F.col("lang") == x, F.lit(min(1.0, docs / c))) for x, c in n.items()], F.lit(0.0))
    sample = named.filter((uniform_hash(F.col("key"), F.lit(4)) < share) & F.col("text").isNotNull()).select("lang", "text")
    counted = map_arrow(sample, _count(languages), "row long, bucket long, n long").groupBy("row", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(languages) + 1, BUCKETS))
    counts[counted["row"], counted["bucket"]] = counted["n"]
    p = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    p[:-1] = (1 - BACK_OFF) * p[:-1] + BACK_OFF * p[-1]
    p[-1] = (1 - UND_UNIFORM) * p[-1] + UND_UNIFORM / BUCKETS
    return np.ascontiguousarray(np.log(p).T.astype(np.float32))


def text_scores(rows: DataFrame, model: np.ndarray, text: str = "text") -> DataFrame:
    """``rows`` without ``text``, with ``scores`` (log-likelihood of the whole text per class) and ``n_trigrams``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # BUCKETS x classes numbers, whatever the data
    rest = [c for c in rows.columns if c != text]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for part in slices(batch, text):
                found = [trigrams(t or "") for t in part.column(part.schema.get_field_index(text)).to_pylist()]
                # very long texts piece by piece: the gathered rows of the model stay small
                scores = [sum((table[f[i : i + BUCKETS]].sum(axis=0, dtype=np.float64) for i in range(0, len(f), BUCKETS)), np.zeros(table.shape[1])) for f in found]
                out = pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in rest], names=rest)
                out = out.append_column("scores", pa.array([s.tolist() for s in scores], pa.list_(pa.float64())))
                yield out.append_column("n_trigrams", pa.array([len(f) for f in found], pa.int64()))

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rest)
    return map_arrow(rows, run, f"{fields}, scores array<double>, n_trigrams long")


def with_softmax(rows: DataFrame, scores: list[Column], prefix: str) -> DataFrame:
    """``rows`` with ``prefix0, prefix1, ...``: the scores as probabilities. Step by step, so that no expression is repeated."""
    names = [f"{prefix}{i}" for i in range(len(scores))]
    rows = rows.withColumns(dict(zip(names, scores, strict=True)))
    rows = rows.withColumn("_top", F.greatest(*names))
    rows = rows.withColumns({n: F.exp(F.col(n) - F.col("_top")) for n in names})
    rows = rows.withColumn("_sum", sum((F.col(n) for n in names[1:]), F.col(names[0])))
    return rows.withColumns({n: F.col(n) / F.col("_sum") for n in names}).drop("_top", "_sum")


def identify(rows: DataFrame, model: np.ndarray, keys: list[str], text: str = "text", languages: Iterable[str] = LANGUAGES, min_confidence: float = 0.5) -> DataFrame:
    """``keys, lang, confidence, accepted, n_trigrams`` for every row.

    ``rows`` has ``keys``, the text and the evidence columns ``declared``, ``suffix``, ``host``, ``domain`` (strings; null
    where there is none, which says nothing either way). ``lang`` is the class of the largest posterior (ties: the first
    in ``languages``, ``und`` last), ``confidence`` that posterior. A row is accepted if the class is a language and its
    confidence reaches ``min_confidence``. A null text or one without letters is ``und`` with confidence 1 and not
    accepted. Repeated rows give repeated results and count as evidence each time. Texts are read whole, whatever their
    length; an empty table gives no rows.
    """
    classes = [*languages, UNDETERMINED]
    scored = text_scores(rows.select(*keys, text, "declared", "suffix", "host", "domain"), model, text)
    numbers = range(len(classes))
    has = F.col("n_trigrams") > 0  # rows without letters are no evidence of a host's language
    scored = with_softmax(written(scored, "langid-scores"), [F.col("scores")[i] / OVERLAP for i in numbers], "own_")
    scored = scored.withColumns({f"own_{i}": F.when(has, F.round(F.col(f"own_{i}") * _SCALE).cast("long")).otherwise(0) for i in numbers})
    scored = scored.withColumn("one", F.when(has, 1).otherwise(0))
    sums = [F.sum(f"own_{i}").alias(f"own_{i}") for i in numbers]
    total = scored.agg(*sums, F.sum("one").alias("one")).first()
    corpus = [((total[f"own_{i}"] or 0) / _SCALE + 1.0) / ((total["one"] or 0) + len(classes)) for i in numbers]

    judged = scored
    for level in ("host", "domain", "declared", "suffix"):
        found = scored.filter(F.col(level).isNotNull()).groupBy(F.col(level).alias(f"of_{level}")).agg(
            F.struct(*[(F.sum(f"own_{i}") / _SCALE).alias(f"s{i}") for i in numbers], F.sum("one").cast("double").alias("n")).alias(f"{level}_sums")
        )
        judged = judged.join(written(found, f"langid-{level}"), F.col(level) == F.col(f"of_{level}"), "left").drop(f"of_{level}")

    def without_own(level: str, i: int) -> Column:
        """Sum of the level's posteriors for class i without the row's own; 0 where the row has no such evidence."""
        return F.coalesce(F.col(f"{level}_sums.s{i}") - F.col(f"own_{i}") / _SCALE, F.lit(0.0))

    def rows_but_own(level: str) -> Column:
        return F.coalesce(F.col(f"{level}_sums.n") - F.col("one"), F.lit(0.0))

    def smoothed(level: str, i: int, above: Column, weight: float) -> Column:
        return (without_own(level, i) + above * weight) / (rows_but_own(level) + weight)

    judged = judged.withColumns({f"domain_{i}": smoothed("domain", i, F.lit(corpus[i]), DOMAIN_ROWS) for i in numbers})
    judged = judged.withColumns({f"host_{i}": smoothed("host", i, F.col(f"domain_{i}"), HOST_ROWS) for i in numbers})
    scores = []
    for i in numbers:
        values = [F.when(F.col(f"{v}_sums").isNull(), 0.0).otherwise(F.log(smoothed(v, i, F.lit(corpus[i]), VALUE_ROWS) / corpus[i])) for v in ("declared", "suffix")]
        scores.append(F.col("scores")[i] / OVERLAP + F.log(f"host_{i}") + values[0] + values[1])
    judged = with_softmax(judged, scores, "post_")
    judged = judged.withColumn("_best", F.greatest(*[f"post_{i}" for i in numbers]))
    named = F.coalesce(*[F.when(F.col(f"post_{i}") == F.col("_best"), F.lit(c)) for i, c in enumerate(classes)])
    out = judged.select(*keys, F.when(has, named).otherwise(UNDETERMINED).alias("lang"), F.when(has, F.round("_best", 6)).otherwise(1.0).alias("confidence"), "n_trigrams")
    accepted = (F.col("lang") != UNDETERMINED) & (F.col("confidence") >= min_confidence)
    # written, as a later filter on the verdict would otherwise be unfolded into all the scores
    return written(out.select(*keys, "lang", "confidence", accepted.alias("accepted"), "n_trigrams"), "langid-judged")


def page_evidence(url: Column, html: Column) -> dict[str, Column]:
    """Text and evidence columns of a web page; null where the page or its address has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    folder = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([A-Za-z]{2})(?:-[A-Za-z]+)?(?:[/?#]|$)", 1))
    shown = html
    for pattern in (r"(?is)<(script|style)\b.*?</\1\s*>", r"(?s)<!--.*?-->", r"<[^>]*>", r"&[A-Za-z]+;|&#[0-9]+;"):
        shown = F.regexp_replace(shown, pattern, " ")
    declared = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})", 1))
    return {
        "text": shown,
        "declared": F.nullif(declared, F.lit("")),
        "suffix": F.nullif(F.concat(F.regexp_extract(host, r"\.([a-z0-9-]+)$", 1), F.when(folder != "", F.concat(F.lit("/"), folder)).otherwise("")), F.lit("")),
        "host": F.nullif(host, F.lit("")),
        "domain": F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")),
    }


def document_evidence(text: Column, source: Column) -> dict[str, Column]:
    """Evidence columns of a plain document: its source is its host."""
    nothing = F.lit(None).cast("string")
    return {"text": text.cast("string"), "declared": nothing, "suffix": nothing, "host": source.cast("string"), "domain": nothing}


def keep_known_languages(docs: DataFrame, model: np.ndarray, text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is accepted. Rows are told apart by text and source, not by an id."""
    row = F.xxhash64(docs[text], docs[source])
    evidence = document_evidence(docs[text], docs[source])
    judged = identify(docs.select(row.alias("_row"), *[c.alias(k) for k, c in evidence.items()]), model, ["_row"])
    gone = written(judged.filter(~F.col("accepted")).select("_row").distinct(), "langid-rejected")
    return docs.join(gone, row == gone["_row"], "left_anti")
