"""What incremental runs keep: per-document results by document, and sums of confidence per location and per point.

All parts live in one log (``sources.logtable``) and change together, one delta per batch. A document that comes again
replaces what it had: rows count only if their delta is the last that saw their document, and the sums get the new rows
added and the old ones taken back. A lookup of one document reads one bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgeo.operators.whitelist import SEQ
from docgeo.schemas import DOC_LANGUAGE_SCHEMA, WHITELIST_SCHEMA
from docgeo.session import cut_lineage
from docgeo.sources.logtable import BUCKETS, LogTable, Manifest, Part

_DOC, _LONG, _STRING, _DOUBLE = T.StructField("doc_id", T.LongType()), T.LongType(), T.StringType(), T.DoubleType()
_EXACT = T.DecimalType(38, 9)  # sums that can be taken back without a trace

_SUMS = [T.StructField("total", _EXACT), T.StructField("n", _LONG), T.StructField("missing", _LONG)]
_GEO = [_DOC, T.StructField("query", _STRING), T.StructField("frequency", _LONG), *[T.StructField(c, _DOUBLE) for c in ("lat", "lon")]]
_GEO += [T.StructField("class", _STRING), T.StructField("type", _STRING), T.StructField("importance", _DOUBLE)]

LEDGER_SCHEMA = T.StructType([*WHITELIST_SCHEMA.fields, _DOC, T.StructField(SEQ, _LONG)])
PARTS = {
    "documents": Part(T.StructType([_DOC]), ("doc_id",)),
    "ledger": Part(LEDGER_SCHEMA, ("doc_id",)),
    "coordinates": Part(T.StructType(_GEO), ("doc_id",)),
    "languages": Part(DOC_LANGUAGE_SCHEMA, ("doc_id",)),
    "locations": Part(T.StructType([T.StructField("location", _STRING), *_SUMS]), ("location",)),
    "points": Part(T.StructType([T.StructField("lat", _DOUBLE), T.StructField("lon", _DOUBLE), *_SUMS]), ("lat", "lon")),
}
BY_DOCUMENT = [name for name, part in PARTS.items() if part.key == ("doc_id",)]
SUMS = {"locations": ["location"], "points": ["lat", "lon"]}


def _sums(rows: DataFrame, key: list[str]) -> DataFrame:
    """Sums of confidence, rows and rows without one, per key: rows of ``sign`` -1 are taken back."""
    value, sign = F.col("confidence").cast("decimal(18,9)"), F.col("sign")
    return rows.groupBy(*key).agg(
        F.sum(F.coalesce(value, F.lit(0).cast("decimal(18,9)")) * sign).alias("total"),
        F.sum(sign).cast("long").alias("n"),
        F.sum(F.when(F.col("confidence").isNull(), sign).otherwise(0)).cast("long").alias("missing"),
    )


class CorpusState:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.log = LogTable(spark, root, PARTS, buckets)

    def is_applied(self, source: str, batch: int) -> bool:
        return self.log.is_applied(source, batch)

    def _current(self, part: str, manifest: Manifest, only: Column | None = None) -> DataFrame:
        """Rows whose document no later delta has seen; ``only``: a condition on bucket and doc_id, met before anything else."""
        rows, seen = self.log.read(part, manifest), self.log.read("documents", manifest)
        if only is not None:
            rows, seen = rows.where(only), seen.where(only)
        if len(manifest.deltas) > 1:
            last = seen.groupBy("bucket", "doc_id").agg(F.max("delta").alias("delta"))
            rows = rows.join(last, ["bucket", "doc_id", "delta"], "left_semi")
        return rows

    def read(self, part: str) -> DataFrame:
        """A part by document, as if all documents had come once, in their last state."""
        return self._current(part, self.log.manifest()).select(*PARTS[part].schema.names)

    def of_document(self, part: str, doc_id: int) -> DataFrame:
        """The rows of one document: the filter on its bucket prunes all other files."""
        only = (F.col("bucket") == self.log.bucket_of(part, F.lit(doc_id).cast("long"))) & (F.col("doc_id") == doc_id)
        return self._current(part, self.log.manifest(), only).select(*PARTS[part].schema.names)

    def averages(self, part: str) -> DataFrame:
        """Mean confidence per location (``locations``) or point (``points``), NULL if one of its rows has none."""
        key = SUMS[part]
        sums = self.log.read(part).groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("total", "n", "missing")]).where(F.col("n") > 0)
        return sums.select(*key, F.when(F.col("missing") == 0, F.col("total").cast("double") / F.col("n")).alias("confidence"))

    def upsert(self, documents: DataFrame, ledger: DataFrame, coordinates: DataFrame, languages: DataFrame, source: str | None = None, batch: int = 0) -> Manifest:
        """Put the results of ``documents`` (doc_id) in the place of what these had before. Documents without any rows count
        too: they had some, perhaps. A batch of a source that is in already changes nothing."""
        m = self.log.manifest()
        if source is not None and m.applied.get(source, -1) >= batch:
            return m
        documents = documents.select("doc_id").distinct()
        ledger = cut_lineage(ledger.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER_SCHEMA]))
        changes = ledger.select("location", "lat", "lon", "confidence", F.lit(1).alias("sign"))
        if m.deltas:
            mine = documents.withColumn("bucket", self.log.bucket_of("documents"))
            replaced = self._current("ledger", m).join(mine, ["bucket", "doc_id"], "left_semi")
            changes = changes.unionByName(replaced.select("location", "lat", "lon", "confidence", F.lit(-1).alias("sign")))
        sums = {part: _sums(changes, key) for part, key in SUMS.items()}
        return self.log.append({"documents": documents, "ledger": ledger, "coordinates": coordinates, "languages": languages, **sums}, source, batch)

    def compact(self) -> Manifest:
        """One delta: current rows by document, and one row per location and point that still has rows."""
        m = self.log.manifest()

        def merge(part: str, rows: DataFrame) -> DataFrame:
            if part == "documents":
                return rows.select("doc_id").distinct()
            if part in BY_DOCUMENT:
                return self._current(part, m)
            return rows.groupBy(*SUMS[part]).agg(*[F.sum(c).alias(c) for c in ("total", "n", "missing")]).where(F.col("n") > 0)

        return self.log.compact(merge)

    def vacuum(self) -> list[str]:
        return self.log.vacuum()
