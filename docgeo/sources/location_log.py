"""The location cache as a log: a run adds the names that are new, and never writes the others again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docgeo.operators.geocode import one_per_query
from docgeo.schemas import LOCATED_CACHE_SCHEMA, LOCATION_CACHE_COLUMNS, PLACE_COLUMNS
from docgeo.session import cut_lineage
from docgeo.sources.logtable import BUCKETS, LogTable, Manifest, Part

ROWS = "locations"


def _with_places(rows: DataFrame) -> DataFrame:
    for c in PLACE_COLUMNS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    return rows.select(*LOCATION_CACHE_COLUMNS, *PLACE_COLUMNS)


class LocationLog:
    """One row per name: the best one (highest importance, then lowest place_id) of all that were added."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.log = LogTable(spark, root, {ROWS: Part(LOCATED_CACHE_SCHEMA, ("query",))}, buckets)

    def read(self) -> DataFrame:
        """The cache, with country and continent. Deltas of names that were all new are simply put together; only if some
        delta improved a known name is the best row of each name picked."""
        m = self.log.manifest()
        rows = self.log.read(ROWS, m).drop("delta", "bucket")
        return rows if m.unique else one_per_query(rows)

    def add(self, resolved: DataFrame, source: str | None = None, batch: int = 0) -> Manifest:
        """Add the rows whose name is new, or that are better than the row of a known name. Writes nothing else."""
        new = one_per_query(_with_places(resolved).where(F.col("query").isNotNull()))
        known = self.read().select("query", F.col("importance").alias("_importance"), F.col("place_id").alias("_place"), F.lit(True).alias("_known"))
        better = new.join(known, "query", "left").where(F.col("_known").isNull() | self._beats())
        better = cut_lineage(better.select(*LOCATION_CACHE_COLUMNS, *PLACE_COLUMNS, F.col("_known").isNotNull().alias("_known")))
        counts = better.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_known").cast("int")).alias("known")).first()
        if not counts["n"] and source is None:
            return self.log.manifest()
        return self.log.append({ROWS: better}, source, batch, unique=not counts["known"])

    @staticmethod
    def _beats() -> Column:
        """The order of ``one_per_query``: higher importance (NULL last), then the lower place_id (NULL first)."""
        new, old = F.col("importance"), F.col("_importance")
        higher = (new.isNotNull() & old.isNull()) | F.coalesce(new > old, F.lit(False))
        lower = (F.col("place_id").isNull() & F.col("_place").isNotNull()) | F.coalesce(F.col("place_id") < F.col("_place"), F.lit(False))
        return higher | (new.eqNullSafe(old) & lower)

    def compact(self) -> Manifest:
        return self.log.compact(lambda _, rows: one_per_query(rows.drop("delta", "bucket")))

    def vacuum(self) -> list[str]:
        return self.log.vacuum()
