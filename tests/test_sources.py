"""Readers, cache versions, CSV quoting, boundaries and the resolver's contract."""

import shutil

import pandas as pd
import pytest

from docgeo.operators import enrich
from docgeo.operators import geocode as G
from docgeo.schemas import LOCATION_CACHE_SCHEMA
from docgeo.sources import tables


def _cache(spark, *names):
    return spark.createDataFrame([{f.name: n if f.name == "query" else None for f in LOCATION_CACHE_SCHEMA.fields} for n in names], LOCATION_CACHE_SCHEMA)


def test_a_lost_pointer_loses_nothing(spark, tmpdir_path):
    root = f"{tmpdir_path}/cache"
    assert tables.save_location_cache(spark, _cache(spark, "a"), root) == "v-000000"
    assert tables.save_location_cache(spark, _cache(spark, "a", "b"), root) == "v-000001"
    shutil.rmtree(f"{root}/_CURRENT")
    assert sorted(r["query"] for r in tables.open_location_cache(spark, root).collect()) == ["a", "b"]
    assert tables.save_location_cache(spark, _cache(spark, "c"), root) == "v-000002"
    assert [r["query"] for r in tables.open_location_cache(spark, root).collect()] == ["c"]
    assert spark.read.parquet(f"{root}/v-000000").count() == 1  # no version is overwritten


def test_csv_fields_with_quotes_commas_and_line_breaks(spark, tmpdir_path):
    path = f"{tmpdir_path}/blacklist.csv"
    with open(path, "w") as f:
        f.write('"location","lat","lon"\n"The ""Old"", Town",1.5,2.5\n"two\nlines",,\n')
    rows = {r["location"]: (r["lat"], r["lon"]) for r in tables.read_blacklist(spark, path, "csv").collect()}
    assert rows == {'The "Old", Town': (1.5, 2.5), "two\nlines": (None, None)}


def test_polygons_of_several_parts(spark):
    wkt = "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1)), ((10 10, 12 10, 12 12, 10 12, 10 10)))"
    geo = '{"type": "MultiPolygon", "coordinates": [[[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]], [[[10, 10], [12, 10], [12, 12], [10, 12], [10, 10]]]]}'
    df = spark.createDataFrame([(1, "X", "Y", wkt, geo)], "poly_id long, country string, continent string, wkt string, geometry string")
    points = spark.createDataFrame([(3.0, 3.0), (1.5, 1.5), (11.0, 11.0), (8.0, 8.0)], "lat double, lon double")
    for boundaries in (tables.boundaries_from_wkt(df), tables.boundaries_from_geojson(df)):
        found = {(r["lat"], r["lon"]): r["country"] for r in enrich.locate_points(points, boundaries).collect()}
        assert found == {(3.0, 3.0): "X", (1.5, 1.5): None, (11.0, 11.0): "X", (8.0, 8.0): None}


def _resolver(kind):
    """A resolver made here, so that it travels to the workers by value."""

    def partial(batch):
        return pd.DataFrame({"query": batch["query"], "lat": "50.5", "lon": 8})[batch["query"] != "nowhere"]

    def raising(batch):
        raise RuntimeError("no connection")

    return {"partial": partial, "raising": raising, "none": lambda batch: None, "wrong": lambda batch: batch.assign(lat="north")}[kind]


@pytest.mark.parametrize(
    ("kind", "statuses"),
    [
        ("partial", {"here": "resolved", "nowhere": "not found"}),
        ("raising", {"here": "failed", "nowhere": "failed"}),
        ("none", {"here": "not found", "nowhere": "not found"}),
        ("wrong", {"here": "failed", "nowhere": "failed"}),
    ],
)
def test_resolver_contract(spark, kind, statuses):
    resolver = _resolver(kind)
    misses = spark.createDataFrame([("here",), ("nowhere",), ("here",)], "query string").coalesce(1)
    out = G.resolve_with_status(misses, resolver).collect()
    assert {r["query"]: r["status"] for r in out} == statuses and len(out) == 2
    resolved = G.resolve_with(misses, resolver)
    assert resolved.schema == LOCATION_CACHE_SCHEMA or resolved.columns == [f.name for f in LOCATION_CACHE_SCHEMA.fields]
    assert [(r["query"], r["lat"]) for r in resolved.collect()] == ([("here", 50.5)] if kind == "partial" else [])
