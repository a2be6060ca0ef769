"""Persistent tables: the location cache (versioned), blacklist, whitelist, boundary polygons."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docgeo.schemas import BLACKLIST_SCHEMA, LOCATION_CACHE_COLUMNS, LOCATION_CACHE_SCHEMA, WHITELIST_SCHEMA
from docgeo.sources.location_log import LocationLog
from docgeo.sources.logtable import listed

CURRENT = "_CURRENT"

# quotes inside a field are doubled, and a field may hold line breaks
CSV = {"header": True, "quote": '"', "escape": '"'}


def _versions(spark: SparkSession, root: str) -> dict[int, bool]:
    """Numbers of the version directories under ``root``, and whether each was written completely."""
    return listed(spark, root, r"v-(\d+)")


def _current(spark: SparkSession, root: str) -> str | None:
    """Name of the current version: what the pointer says, or the newest complete one if the pointer is lost."""
    try:
        rows = spark.read.text(f"{root.rstrip('/')}/{CURRENT}").collect()  # one tiny pointer file
        if rows:
            return json.loads(rows[0][0])["version"]
    except AnalysisException:
        pass
    complete = [n for n, whole in _versions(spark, root).items() if whole]
    return f"v-{max(complete):06d}" if complete else None


def open_location_cache(spark: SparkSession, root: str) -> DataFrame:
    """The cache under ``root``: the log of incremental runs, or the current version of saved snapshots, or an empty cache
    with the declared schema."""
    if listed(spark, f"{root.rstrip('/')}/manifests", r"m-(\d+)"):
        return LocationLog(spark, root).read().select(*LOCATION_CACHE_COLUMNS)
    version = _current(spark, root)
    if version is None:
        return spark.createDataFrame([], LOCATION_CACHE_SCHEMA)
    return spark.read.schema(LOCATION_CACHE_SCHEMA).parquet(f"{root.rstrip('/')}/{version}")


def save_location_cache(spark: SparkSession, cache: DataFrame, root: str) -> str:
    """Write ``cache`` as a new version directory, then switch the pointer to it.

    The number follows the largest one listed, so no version is ever overwritten, with or without a pointer; a failed
    write leaves an incomplete directory that nothing reads. Returns the new version name.
    """
    version = f"v-{max(_versions(spark, root), default=-1) + 1:06d}"
    cache.select(*LOCATION_CACHE_COLUMNS).write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{version}")
    spark.createDataFrame([(json.dumps({"version": version}),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{root.rstrip('/')}/{CURRENT}")
    return version


def read_blacklist(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return spark.read.options(**CSV, multiLine=True).schema(BLACKLIST_SCHEMA).csv(path)
    df = spark.read.parquet(path)
    return df.select("location", *[c for c in ("lat", "lon") if c in df.columns])


def read_whitelist(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return spark.read.options(**CSV, multiLine=True, nullValue="NA").schema(WHITELIST_SCHEMA).csv(path)
    return spark.read.schema(WHITELIST_SCHEMA).parquet(path)


def save_whitelist(whitelist: DataFrame, path: str, fmt: str = "parquet") -> None:
    if fmt == "csv":
        whitelist.write.mode("overwrite").options(**CSV, nullValue="NA").csv(path)
    else:
        whitelist.write.mode("overwrite").parquet(path)


def _points(ring: Column, separator: str, within: str) -> Column:
    """ARRAY<STRUCT<x,y>> of a ring written as text."""
    return F.transform(
        F.split(F.trim(ring), separator),
        lambda p: F.struct(F.split(F.trim(p), within)[0].cast("double").alias("x"), F.split(F.trim(p), within)[1].cast("double").alias("y")),
    )


def boundaries_from_wkt(df: DataFrame, wkt_col: str = "wkt") -> DataFrame:
    """Boundary table (poly_id, country, continent, rings) from WKT POLYGON or MULTIPOLYGON text.

    All rings of all parts go into one list: by the even-odd rule a point is inside if it is inside one part and none of
    its holes."""
    rings = F.regexp_extract_all(F.col(wkt_col), F.lit(r"\(([^()]+)\)"), F.lit(1))
    return df.select("poly_id", "country", "continent", F.transform(rings, lambda r: _points(r, r"\s*,\s*", r"\s+")).alias("rings"))


def boundaries_from_geojson(df: DataFrame, geometry_col: str = "geometry") -> DataFrame:
    """The same table from GeoJSON geometries (Polygon or MultiPolygon) as text."""
    rings = F.regexp_extract_all(F.col(geometry_col), F.lit(r"\[\s*\[([^\[\]]+\](?:\s*,\s*\[[^\[\]]+\])*)\s*\]"), F.lit(1))
    texts = F.transform(rings, lambda r: F.regexp_replace(r, r"\]\s*$", ""))
    return df.select("poly_id", "country", "continent", F.transform(texts, lambda r: _points(r, r"\]\s*,\s*\[", r"\s*,\s*")).alias("rings"))
