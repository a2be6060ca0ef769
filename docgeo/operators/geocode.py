"""Geocoding through a persistent location cache and a resolver (offline gazetteer or a user callable)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgeo.functions.text import strip_braces
from docgeo.schemas import DOC_GEO_COLUMNS, LOCATION_CACHE_COLUMNS, LOCATION_CACHE_SCHEMA, PLACE_COLUMNS
from docgeo.session import ship_package, written


def _best_order():
    return [F.desc_nulls_last("importance"), F.asc("place_id")]


def one_per_query(rows: DataFrame) -> DataFrame:
    """One row per ``query``: highest importance (NULL last), then lowest place_id."""
    w = Window.partitionBy("query").orderBy(*_best_order())
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def strip_name_braces(doc_location: DataFrame) -> DataFrame:
    """Remove ``{`` and ``}`` from names, then re-sum frequencies of names that became equal; drop empty names."""
    return (
        doc_location.withColumn("location", strip_braces("location"))
        .where(F.length("location") > 0)
        .groupBy("doc_id", "location")
        .agg(F.sum("frequency").alias("frequency"))
    )


def without_braces(mentions: DataFrame) -> DataFrame:
    """Mentions with ``{`` and ``}`` removed from the lemma; empty ones drop out. Counted then (``entities.name_frequencies``),
    they give what ``strip_name_braces`` makes of the counts, in one grouping."""
    return mentions.withColumn("lemma", strip_braces("lemma")).where(F.length("lemma") > 0)


def distinct_names(doc_location: DataFrame) -> DataFrame:
    """Corpus-wide list of names to look up: each name travels once, however many documents mention it."""
    return doc_location.select(F.col("location").alias("query")).distinct()


def cache_hits(names: DataFrame, cache: DataFrame) -> DataFrame:
    """Cache rows whose query is among the names."""
    return cache.join(distinct_names(names), "query", "left_semi")


def cache_misses(names: DataFrame, cache: DataFrame) -> DataFrame:
    """Names not in the cache (query)."""
    return distinct_names(names).join(cache.select("query"), "query", "left_anti")


def resolve_offline(misses: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Resolver over a gazetteer table with the cache's columns: best row per missed name; names the gazetteer
    lacks produce no row."""
    return one_per_query(gazetteer.join(misses.select("query").distinct(), "query", "left_semi")).select(
        *LOCATION_CACHE_COLUMNS
    )


def resolve_with(misses: DataFrame, resolver: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Resolver hook: ``resolver(batch)`` gets a pandas frame with column ``query`` and returns cache rows.

    Runs per Arrow batch on the executors. A batch whose call raises is not fatal: its names simply stay
    unresolved (and are looked up again in a later run).
    """
    return resolve_with_status(misses, resolver).where("status = 'resolved'").drop("status")


def _as_schema(out: pd.DataFrame, schema: T.StructType) -> pd.DataFrame:
    """``out`` with the columns and types of ``schema``; absent columns become NULL, wrong values raise."""
    columns = {}
    for f in schema.fields:
        c = out[f.name] if f.name in out.columns else pd.Series([None] * len(out), index=out.index, dtype=object)
        if isinstance(f.dataType, T.NumericType):
            c = pd.to_numeric(c)
            c = c.astype("Int64") if isinstance(f.dataType, T.IntegralType) else c.astype(float)
        elif isinstance(f.dataType, T.StringType):
            c = c.map(lambda v: None if pd.isna(v) else str(v))
        columns[f.name] = c
    return pd.DataFrame(columns)


def resolve_with_status(misses: DataFrame, resolver: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Cache rows plus ``status`` for every missed name: ``resolved`` (one row per answer), ``not found`` or ``failed``
    (one row with the name alone). An answer that lacks columns is filled with NULL; one whose values don't fit the
    cache's types counts as failed."""
    schema = LOCATION_CACHE_SCHEMA
    ship_package(misses.sparkSession)

    def run(batches):
        for pdf in batches:
            try:
                out = resolver(pdf[["query"]].copy())
                out = _as_schema(pdf[:0] if out is None else out, schema).assign(status="resolved")
                missing = "not found"
            except Exception:  # noqa: BLE001 - a failing lookup must not stop the run
                out, missing = _as_schema(pdf[:0], schema).assign(status="resolved"), "failed"
            rest = pdf[~pdf["query"].isin(out["query"])]
            yield out
            if len(rest):
                yield _as_schema(rest, schema).assign(status=missing)

    with_status = T.StructType([*schema.fields, T.StructField("status", T.StringType())])
    return misses.select("query").distinct().mapInPandas(run, with_status)


def update_cache(cache: DataFrame, resolved: DataFrame) -> DataFrame:
    """Old cache plus newly resolved rows, exact duplicates removed, then one row per query."""
    return one_per_query(cache.select(*LOCATION_CACHE_COLUMNS).unionByName(resolved.select(*LOCATION_CACHE_COLUMNS)).distinct())


def attach_coordinates(doc_location: DataFrame, cache: DataFrame, unique: bool = False) -> DataFrame:
    """doc_geo (doc_id, query, frequency, lat, lon, class, type, importance): inner join of names and cache;
    names without a cache row drop out (see ``unresolved_names``). ``unique``: the cache has one row per name, else the best
    one is taken. Country and continent come along if the cache has them. Catalyst broadcasts the cache side if its
    bytes allow; otherwise a shuffle join with AQE skew splitting handles names that many documents share."""
    places = [c for c in PLACE_COLUMNS if c in cache.columns]
    c = (cache if unique else one_per_query(cache)).select("query", "lat", "lon", "class", "type", "importance", *places)
    return doc_location.join(c, doc_location["location"] == c["query"]).select(*DOC_GEO_COLUMNS, *places)


def unresolved_names(doc_location: DataFrame, cache: DataFrame) -> DataFrame:
    """(doc_id, location, frequency) rows that no cache row explains."""
    return doc_location.join(cache.select(F.col("query").alias("location")), "location", "left_anti").select(
        "doc_id", "location", "frequency"
    )


@dataclass
class Geocoded:
    doc_geo: DataFrame  # documents' names with coordinates
    new_cache: DataFrame  # the cache with the names that were resolved (not computed unless it is read)
    unresolved: DataFrame  # (doc_id, location, frequency) without a cache row
    resolved: DataFrame  # the new cache rows alone

    def __getitem__(self, i: int) -> DataFrame:
        return (self.doc_geo, self.new_cache, self.unresolved, self.resolved)[i]


def geocode(doc_location: DataFrame, cache: DataFrame, gazetteer: DataFrame | None = None, resolver=None, place: Callable[[DataFrame], DataFrame] | None = None, stripped: bool = False) -> Geocoded:
    """Whole geocoding step.

    Misses are collected over the whole corpus and resolved once. Only the cache rows of the corpus's own names are picked,
    deduplicated and written down (with the new ones, marked); the rest of the cache is neither copied nor sorted. ``place``
    adds country and continent to rows with coordinates: to the new ones, and to known ones if the cache lacks them. ``stripped``: the
    names have no braces any more (``without_braces``).
    """
    names = written(doc_location if stripped else strip_name_braces(doc_location), "names")
    misses = cache_misses(names, cache)
    if resolver is not None:
        resolved = written(resolve_with(misses, resolver), "resolved")  # asked once, whatever reads the answers
    elif gazetteer is not None:
        resolved = resolve_offline(misses, gazetteer)
    else:
        resolved = cache.limit(0).select(*LOCATION_CACHE_COLUMNS)
    known = all(c in cache.columns for c in PLACE_COLUMNS)
    columns = [*LOCATION_CACHE_COLUMNS, *(PLACE_COLUMNS if known and place else [])]
    hits = cache_hits(names, cache).select(*columns)
    if place:
        resolved, hits = place(resolved), hits if known else place(hits)
    marked = hits.withColumn("_new", F.lit(False)).unionByName(resolved.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    used = written(one_per_query(marked), "used")
    resolved = used.where("_new").drop("_new")
    return Geocoded(attach_coordinates(names, used, unique=True), update_cache(cache, resolved), unresolved_names(names, used), resolved)
