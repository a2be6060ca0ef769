"""Sources/sinks round trips and the incremental run."""

import os

from pyspark.sql import functions as F

from docgeo.plans import pipeline as P
from docgeo.plans.fixtures import Fixtures
from docgeo.plans.queries import _inputs
from docgeo.sources import corpus, tables
from docgeo.streaming import incremental
from tests.conftest import SF001


def test_text_folder_and_file_ids(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "files_to_be_imported")
    os.makedirs(d)
    for i, t in enumerate(["In Berlin ist es schöner als in Hamburg", "Nothing here"]):
        with open(os.path.join(d, f"doc{i}.txt"), "w") as f:
            f.write(t)
    docs = corpus.read_text_files(spark, d)
    assert sorted(r.file_name for r in docs.collect()) == ["doc0.txt", "doc1.txt"]
    lex = spark.createDataFrame([("de", "Berlin", "Berlin", "GPE"), ("de", "Hamburg", "Hamburg", "LOC")],
                                "lang string, surface string, lemma string, entity_type string")
    from docgeo.operators import entities as E, language as L
    out = E.extract_locations(docs, L.given_language(docs, "de"), lex)
    assert sorted((r.location, r.frequency) for r in out.collect()) == [("Berlin", 1), ("Hamburg", 1)]


def test_cache_versions(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "cache")
    empty = tables.open_location_cache(spark, root)
    assert empty.count() == 0 and len(empty.columns) == 16
    g = Fixtures(spark, SF001).gazetteer().limit(5)
    v0 = tables.save_location_cache(spark, g, root)
    v1 = tables.save_location_cache(spark, tables.open_location_cache(spark, root), root)
    assert (v0, v1) == ("v-000000", "v-000001")
    assert tables.open_location_cache(spark, root).count() == 5


def test_whitelist_csv_round_trip(spark, tmpdir_path):
    wl = P.run_whitelist(_inputs(Fixtures(spark, SF001)), "name")
    path = os.path.join(tmpdir_path, "whitelist.csv")
    tables.save_whitelist(wl, path, "csv")
    back = tables.read_whitelist(spark, path, "csv")
    assert back.count() == wl.count()
    assert back.subtract(wl).count() == 0


def test_incremental_two_batches_equal_one_shot(spark, tmpdir_path):
    fx = Fixtures(spark, SF001)
    src = os.path.join(tmpdir_path, "incoming")
    docs = fx.corpus().drop("file_name")
    docs.where("doc_id % 2 = 0").write.parquet(os.path.join(src, "part=0"))
    schema = docs.schema

    def make_inputs(batch, cache):
        return _inputs(fx, docs=batch.withColumn("file_name", F.lit(None).cast("string")), cache=cache)

    kw = dict(ledger_dir=os.path.join(tmpdir_path, "ledger"), cache_root=os.path.join(tmpdir_path, "cache"),
              checkpoint_location=os.path.join(tmpdir_path, "ckpt"))
    incremental.run_incremental(spark, src, schema, make_inputs, **kw)
    docs.where("doc_id % 2 = 1").write.parquet(os.path.join(src, "part=1"))
    incremental.run_incremental(spark, src, schema, make_inputs, **kw)
    inc = incremental.condensed(spark, kw["ledger_dir"], "name")
    one = P.run_whitelist(_inputs(fx, cache=tables.open_location_cache(spark, kw["cache_root"])), "name")
    cols = ["id", "location", "frequency", "lat", "lon", "class", "type", "country", "continent"]
    r = lambda df: sorted(tuple(x) for x in df.select(*cols, F.round("confidence", 9)).collect())
    assert r(inc) == r(one)


def test_sample_accessors(spark):
    fx = Fixtures(spark, SF001)
    inp = _inputs(fx)
    geo = P.geocoded(inp)[0]
    assert {r.doc_id for r in P.coordinates_of(geo, 2).collect()} <= {2}
    from docgeo.operators import language as L
    langs = L.detect_languages(fx.corpus(), fx.language_profile())
    rows = P.languages_of(langs, 2).collect()
    assert rows and abs(sum(r.proportion for r in rows) - 1.0) < 1e-9
    meta = P.run_metadata(fx.report_documents())
    assert P.metadata_of(meta, 0).first().grade == "Note: 0"
    assert P.field_of_all(meta, "grade").columns == ["doc_id", "grade"]
    assert all(len(r.preview) <= 1000 for r in P.text_preview(fx.documents()).collect())


def test_boundaries_from_wkt(spark):
    from docgeo.operators import enrich as N

    wkt = spark.createDataFrame(
        [(1, "A", "X", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))")],
        "poly_id int, country string, continent string, wkt string",
    )
    b = tables.boundaries_from_wkt(wkt)
    rings = b.first().rings
    assert len(rings) == 2 and (rings[0][1].x, rings[0][1].y) == (10.0, 0.0)
    pts = spark.createDataFrame([(1.0, 1.0), (5.0, 5.0)], "lat double, lon double")
    out = {(r.lat, r.lon): r.country for r in N.locate_points(pts, b).collect()}
    assert out == {(1.0, 1.0): "A", (5.0, 5.0): None}
