"""Whitelist: stack all documents' places, condense by name or by coordinates, average confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgeo.functions.aggregates import avg_strict, first_by
from docgeo.schemas import WHITELIST_COLUMNS

SEQ = "_seq"  # ledger order: batch of the run that produced the row (earlier batches come first)


def build_whitelist(doc_geo: DataFrame, seq: int = 0) -> DataFrame:
    """Uncondensed whitelist ledger from enriched doc_geo: ``id`` is the file name, else the doc_id as text.

    Keeps ``doc_id`` and a batch number so "first" values have an explicit order when condensing.
    """
    file_name = F.col("file_name") if "file_name" in doc_geo.columns else F.lit(None).cast("string")
    return doc_geo.select(
        F.coalesce(file_name, F.col("doc_id").cast("string")).alias("id"),
        F.col("query").alias("location"),
        "frequency", "lat", "lon", "class", "type", "importance", "country", "continent", "confidence",
        "doc_id", F.lit(seq).alias(SEQ),
    )


def append(ledger: DataFrame, earlier: DataFrame) -> DataFrame:
    """Earlier ledger rows first, then the new ones (``unionByName``; missing order columns become 0)."""
    def norm(df):
        for c, v in (("doc_id", F.lit(None).cast("long")), (SEQ, F.lit(0))):
            if c not in df.columns:
                df = df.withColumn(c, v)
        return df.select(*WHITELIST_COLUMNS, "doc_id", SEQ)

    return norm(earlier).unionByName(norm(ledger))


def _order(*extra: str):
    return F.struct(F.col(SEQ), F.col("doc_id"), *[F.col(c) for c in extra])


def condense(whitelist: DataFrame, mode: str = "name", averages: DataFrame | None = None) -> DataFrame:
    """Condensed whitelist with the whitelist's 11 columns. ``averages``: the mean confidence of each location (location,
    confidence) or of each point (lat, lon, confidence), if it is kept up elsewhere; else it is taken from the rows.

    ``name``: one row per (id, location): frequency summed, importance averaged (NULL if any is NULL), lat, lon,
    class, type, country, continent from the first row; confidence = mean over all rows of that location.
    ``coords``: one row per (id, lat, lon): the most frequent name (row count, ties to the lowest name), frequency
    summed, class, type, importance, country, continent from the first row (name order); confidence = mean over all
    rows at those coordinates. Groups with a missing key are dropped. Both averages are aggregates joined
    back, never a window over a possibly hot location.
    """
    wl = whitelist
    for c, v in (("doc_id", F.lit(None).cast("long")), (SEQ, F.lit(0))):
        if c not in wl.columns:
            wl = wl.withColumn(c, v)
    if mode == "name":
        keys = ["id", "location"]
        wl = wl.where(F.col("id").isNotNull() & F.col("location").isNotNull())
        order = _order()  # the location is a key
        conf = averages if averages is not None else wl.groupBy("location").agg(avg_strict("confidence").alias("confidence"))
        main = wl.groupBy(*keys).agg(
            F.sum("frequency").alias("frequency"),
            avg_strict("importance").alias("importance"),
            # one value, so that its order is kept (and shuffled) once
            first_by(F.struct("lat", "lon", "class", "type", "country", "continent"), order).alias("first"),
        ).select(*keys, "frequency", "importance", "first.*")
        return main.join(conf, "location").select(*WHITELIST_COLUMNS)
    if mode == "coords":
        keys = ["id", "lat", "lon"]
        wl = wl.where(F.col("id").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull())
        order = _order("location")
        conf = averages if averages is not None else wl.groupBy("lat", "lon").agg(avg_strict("confidence").alias("confidence"))
        main = wl.groupBy(*keys).agg(
            F.mode("location", deterministic=True).alias("location"),
            F.sum("frequency").alias("frequency"),
            first_by(F.struct("class", "type", "importance", "country", "continent"), order).alias("first"),
        ).select(*keys, "location", "frequency", "first.*")
        return main.join(conf, ["lat", "lon"]).select(*WHITELIST_COLUMNS)
    raise ValueError(f"mode must be 'name' or 'coords', not {mode!r}")


def head(whitelist: DataFrame, n: int = 6) -> DataFrame:
    """First ``n`` rows in a total order (id, location, lat, lon)."""
    return whitelist.orderBy("id", "location", "lat", "lon").limit(n)
