"""State that grows by what is new: the location log, the results by document, replays, edits and compaction."""

import os

import pytest
from pyspark.sql import functions as F

from docgeo.operators import geocode as G
from docgeo.operators import whitelist as W
from docgeo.plans import pipeline as P
from docgeo.plans.fixtures import Fixtures
from docgeo.plans.queries import _inputs, q_updated_cache
from docgeo.schemas import LOCATION_CACHE_COLUMNS, LOCATION_CACHE_SCHEMA
from docgeo.sources.location_log import LocationLog
from docgeo.sources.logtable import LogTable, Part
from docgeo.sources.tables import open_location_cache
from docgeo.streaming import incremental
from docgeo.streaming.state import CorpusState
from tests.conftest import SF001


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def location(query, importance=None, place="p", lat=1.0):
    values = {"query": query, "importance": importance, "place_id": place, "lat": lat, "lon": 2.0}
    return {f.name: values.get(f.name) for f in LOCATION_CACHE_SCHEMA.fields}


def cache(spark, *found):
    return spark.createDataFrame(list(found), LOCATION_CACHE_SCHEMA)


def test_log_of_several_parts(spark, tmpdir_path):
    parts = {"a": Part(spark.createDataFrame([], "k long, v string").schema, ("k",)), "b": Part(spark.createDataFrame([], "k long").schema, ("k",))}
    log = LogTable(spark, tmpdir_path, parts, buckets=4)
    assert not log.exists() and log.read("a").count() == 0
    log.append({"a": spark.createDataFrame([(i, f"v{i}") for i in range(20)], "k long, v string"), "b": spark.range(3).toDF("k")}, "s", 0)
    log.append({"a": spark.createDataFrame([(99, None)], "k long, v string")}, "s", 0)  # a replay
    assert log.read("a").count() == 20 and log.manifest().number == 0
    log.append({"a": spark.createDataFrame([(99, None)], "k long, v string")}, "s", 1)
    assert rows(log.read("a").where("delta = 1").select("k", "v")) == [(99, None)] and log.read("b").count() == 3
    one = log.read("a").where((F.col("bucket") == log.bucket_of("a", F.lit(7).cast("long"))) & (F.col("k") == 7))
    assert rows(one.select("v")) == [("v7",)] and len({os.path.dirname(f) for f in one.inputFiles()}) >= 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    # files that no manifest lists are not read: a write that failed before its manifest
    log._write(2, {"b": spark.range(50).toDF("k")})
    assert log.read("b").count() == 3
    log.append({"b": spark.range(1).toDF("k")})
    assert log.manifest().deltas == (0, 1, 3)
    log.compact(lambda part, df: df)
    assert log.read("a").count() == 21 and log.read("b").count() == 4 and log.is_applied("s", 1)
    other = LogTable(spark, tmpdir_path, parts, buckets=9)  # opened with another number: the table's own holds
    assert other.buckets == 4 and rows(other.read("a").where((F.col("bucket") == other.bucket_of("a", F.lit(7).cast("long"))) & (F.col("k") == 7)).select("v")) == [("v7",)]
    gone = log.vacuum()
    assert any("delta=2" in p for p in gone) and log.read("a").count() == 21 and log.vacuum() == []


def test_location_log_writes_only_new_names(spark, tmpdir_path):
    log = LocationLog(spark, tmpdir_path, buckets=4)
    log.add(cache(spark, location("a", 0.5), location("b"), location("b", 0.2, "q")))
    log.add(cache(spark, location("a", 0.5), location("c", 0.1)))
    m = log.log.manifest()
    assert m.unique and [log.log.read("locations", m).where(F.col("delta") == d).count() for d in m.deltas] == [2, 1]
    assert "Window" not in log.read()._jdf.queryExecution().toString()
    assert log.add(cache(spark, location("a", 0.5))).number == m.number  # nothing new: nothing is written
    # better rows of known names: higher importance, then the lower place_id
    log.add(cache(spark, location("a", 0.9, "z", 5.0), location("c", 0.1, "o", 6.0), location("b", 0.1, "a")))
    got = {r["query"]: (r["importance"], r["place_id"], r["lat"]) for r in log.read().collect()}
    assert got == {"a": (0.9, "z", 5.0), "b": (0.2, "q", 1.0), "c": (0.1, "o", 6.0)} and not log.log.manifest().unique
    log.compact()
    assert {r["query"]: (r["importance"], r["place_id"], r["lat"]) for r in log.read().collect()} == got and log.log.manifest().unique
    assert rows(open_location_cache(spark, tmpdir_path).select("query")) == [("a",), ("b",), ("c",)]


def test_location_log_equals_the_updated_cache(spark, tmpdir_path):
    """After any number of deltas and a compaction: the cache that the workflow computes in one go."""
    fx = Fixtures(spark, SF001)
    want = rows(q_updated_cache(spark, SF001).select(*LOCATION_CACHE_COLUMNS))
    log = LocationLog(spark, tmpdir_path)
    log.add(fx.starting_cache())
    for part in range(3):
        docs = fx.corpus().where(F.col("doc_id") % 3 == part)
        log.add(P.geocoded(_inputs(fx, docs=docs, cache=log.read())).resolved, "s", part)
    assert rows(log.read().select(*LOCATION_CACHE_COLUMNS)) == want
    log.compact()
    log.vacuum()
    assert rows(open_location_cache(spark, tmpdir_path)) == want


@pytest.fixture(scope="module")
def corpus(spark):
    return Fixtures(spark, SF001).corpus().drop("file_name").where("doc_id < 90")


def run(spark, root, fx, schema):
    def make_inputs(batch, known):
        return _inputs(fx, docs=batch.withColumn("file_name", F.lit(None).cast("string")), cache=known)

    kw = dict(ledger_dir=f"{root}/ledger", cache_root=f"{root}/cache", checkpoint_location=f"{root}/ckpt")
    incremental.run_incremental(spark, f"{root}/in", schema, make_inputs, **kw)
    return make_inputs, kw


def test_edited_and_repeated_documents(spark, tmpdir_path, corpus):
    fx = Fixtures(spark, SF001)
    corpus.where("doc_id % 2 = 0").write.parquet(f"{tmpdir_path}/in/part=0")
    make_inputs, kw = run(spark, tmpdir_path, fx, corpus.schema)
    # the second delivery: new documents, two edited ones (one left without any text), and one sent again unchanged
    other = corpus.where("doc_id = 5").select("text").first()[0]
    edited = F.when(F.col("doc_id") == 4, F.lit(other)).when(F.col("doc_id") == 6, F.lit("")).otherwise(F.col("text"))
    last = corpus.withColumn("text", edited)
    last.where("doc_id % 2 = 1 or doc_id in (4, 6, 8)").write.parquet(f"{tmpdir_path}/in/part=1")
    run(spark, tmpdir_path, fx, corpus.schema)
    state = CorpusState(spark, kw["ledger_dir"])
    one = P.scanned(_inputs(fx, docs=last.withColumn("file_name", F.lit(None).cast("string"))))
    geo = P.geocoded(one, locate=True)
    ledger = P.whitelist_ledger(one, geo=geo)
    columns = ["id", "location", "frequency", "lat", "lon", "class", "type", "country", "continent", "confidence"]
    assert rows(state.read("ledger").select(*columns)) == rows(ledger.select(*columns))
    assert rows(state.read("coordinates").select("doc_id", "query", "frequency")) == rows(geo.doc_geo.select("doc_id", "query", "frequency"))
    assert rows(state.read("languages")) == rows(P.detected(one).select("doc_id", "code", "proportion", "rank"))
    for mode, part, key in (("name", "locations", ["location"]), ("coords", "points", ["lat", "lon"])):
        want = ledger.groupBy(*key).agg(F.avg("confidence").alias("confidence"))
        assert rows(state.averages(part).select(*key, F.round("confidence", 9))) == rows(want.select(*key, F.round("confidence", 9)))
        kept = [c for c in columns if c != "confidence"]
        want, got = W.condense(ledger, mode), incremental.condensed(spark, kw["ledger_dir"], mode)
        assert rows(got.select(*kept, F.round("confidence", 9))) == rows(want.select(*kept, F.round("confidence", 9)))
    # a replay of the last batch changes nothing, neither does a run without new files
    before = state.log.manifest()
    incremental.process_batch(last.where("doc_id = 4"), make_inputs, state, LocationLog(spark, kw["cache_root"]), kw["checkpoint_location"], 1)
    run(spark, tmpdir_path, fx, corpus.schema)
    assert state.log.manifest() == before
    all_rows, points = rows(state.read("ledger")), rows(state.averages("points"))
    state.compact()
    state.vacuum()
    assert rows(state.read("ledger")) == all_rows and rows(state.averages("points")) == points
    # one document: its bucket alone is read
    mine = state.of_document("coordinates", 5)
    assert rows(mine) == [r for r in rows(state.read("coordinates")) if r[0] == 5]
    assert mine._jdf.queryExecution().executedPlan().toString().count("PartitionFilters: [isnotnull(bucket") >= 1


def test_a_batch_geocodes_once(spark, tmpdir_path, corpus):
    """A resolver is asked for each unknown name once, and for known ones never."""
    asked = spark.sparkContext.accumulator(0)
    fx = Fixtures(spark, SF001)

    def resolver(batch):
        asked.add(len(batch))
        return batch.assign(lat=50.0, lon=8.0, importance=0.5, place_id="x")

    def make_inputs(batch, known):
        return _inputs(fx, docs=batch.withColumn("file_name", F.lit(None).cast("string")), cache=known, resolver=resolver)

    state, log = CorpusState(spark, f"{tmpdir_path}/l"), LocationLog(spark, f"{tmpdir_path}/c")
    incremental.process_batch(corpus, make_inputs, state, log, "s", 0)
    names = log.read().count()
    assert asked.value == names > 0 and log.read().where("country is not null").count() > 0
    incremental.process_batch(corpus, make_inputs, state, log, "s", 1)
    assert asked.value == names and log.read().count() == names


def test_geocode_touches_only_the_names_of_the_corpus(spark):
    known = cache(spark, location("a", 0.1), location("a", 0.4, "q", 9.0), location("z", 0.3))
    gazetteer = cache(spark, location("b", 0.2), location("b", 0.1), location("y", 0.2))
    names = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "b", 1), (2, "nowhere", 1)], "doc_id long, location string, frequency long")
    geo = G.geocode(names, known, gazetteer)
    assert rows(geo.doc_geo.select("doc_id", "query", "lat", "importance")) == [(1, "a", 9.0, 0.4), (1, "b", 1.0, 0.2), (2, "b", 1.0, 0.2)]
    assert rows(geo.resolved.select("query")) == [("b",)] and rows(geo.unresolved) == [(2, "nowhere", 1)]
    assert rows(geo.new_cache.select("query", "importance")) == [("a", 0.4), ("b", 0.2), ("z", 0.3)]
