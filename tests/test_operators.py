"""Unit tests on small hand-made frames (the reference's doc examples and the quirks we keep or change)."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from docgeo.operators import confidence as C
from docgeo.operators import entities as E
from docgeo.operators import enrich as N
from docgeo.operators import filters as FL
from docgeo.operators import metadata as M
from docgeo.operators import whitelist as W
from docgeo.schemas import WHITELIST_COLUMNS

GEO = "doc_id long, query string, frequency long, lat double, lon double, class string, type string, importance double"


def test_four_cities_confidence(spark):
    rows = [
        (1, "Hamburg", 10, 53.551086, 9.993682),
        (1, "Bremen", 2, 53.073635, 8.806422),
        (1, "Lübeck", 2, 53.869720, 10.686389),
        (1, "München", 1, 48.137154, 11.576124),
    ]
    df = spark.createDataFrame([r + ("place", "city", 0.5) for r in rows], GEO)
    out = {r.query: r.confidence for r in C.cluster_confidence(df).collect()}
    assert out == {"Hamburg": 1.0, "Bremen": 1.0, "Lübeck": 1.0, "München": 0.0}
    d = {r.query: r.distance_km for r in C.centroid_distance(df).collect()}
    assert d["München"] == pytest.approx(570.59, abs=0.01)


def test_one_or_two_locations_all_confident(spark):
    df = spark.createDataFrame(
        [(1, "A", 1, 0.0, 0.0, "p", "c", 0.1), (2, "A", 1, 0.0, 0.0, "p", "c", 0.1), (2, "B", 3, 10.0, 10.0, "p", "c", 0.1)], GEO
    )
    assert {r.confidence for r in C.cluster_confidence(df).collect()} == {1.0}


def _brute(d, m, max_k=5, gain=1.15):
    n = len(d)
    if n <= 2:
        return float("inf")
    mean = (m * d).sum() / m.sum()

    def best(k):
        top, cut = -1.0, None
        for cuts in itertools.combinations(range(1, n), k - 1):
            bounds = (0,) + cuts + (n,)
            b = sum((m[a:z] * d[a:z]).sum() ** 2 / m[a:z].sum() for a, z in zip(bounds, bounds[1:]))
            b -= (m * d).sum() ** 2 / m.sum()
            if b > top + 1e-9:
                top, cut = b, bounds[1]
        return top, cut

    n_rows = int(m.sum())
    kmax = min(max_k, n_rows - 1, n)
    bk, cut = best(2)
    if n_rows > 3:
        for k in range(3, kmax + 1):
            b, c = best(k)
            if b < gain * bk:
                break
            bk, cut = b, c
    _ = mean
    return float(d[cut - 1])


@pytest.mark.parametrize("seed", range(40))
def test_kmeans_dp_matches_brute_force(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(3, 10))
    d = np.sort(rng.choice(np.arange(1, 2000), size=n, replace=False).astype(float) * rng.uniform(0.1, 3))
    m = rng.integers(1, 4, size=n).astype(float)
    assert C.choose_cut(d, m) == _brute(d, m)


@pytest.mark.parametrize("n", [3, 17, 60, 1700])
def test_kmeans_dp_matches_plain_dp(n):
    """All values and split points of the table, below and above a thousand distances."""
    rng = np.random.default_rng(n)
    x = np.sort(rng.choice(10 * n, size=n, replace=False).astype(float)) - 5.0 * n
    m = rng.integers(1, 5, size=n).astype(float)
    mass, total = np.concatenate([[0.0], np.cumsum(m)]), np.concatenate([[0.0], np.cumsum(m * x)])
    best, arg, *_ = C._dc_dp(x, m, 3)
    plain = np.full((4, n + 1), -np.inf)
    plain[1, 1:] = total[1:] ** 2 / mass[1:]
    for k in (2, 3):
        for b in range(k, n + 1):
            a = np.arange(k - 1, b)
            values = plain[k - 1][a] + (total[b] - total[a]) ** 2 / (mass[b] - mass[a])
            plain[k, b] = values.max()
            assert np.isclose(values[arg[k, b] - (k - 1)], values.max())
        assert np.allclose(best[k, k:], plain[k, k:])


def test_missing_coordinates_take_no_part(spark):
    rows = [(1, "a", 1, 50.0, 8.0), (1, "b", 1, 51.0, 9.0), (1, "c", 1, 52.0, 10.0), (1, "d", 3, None, None), (1, "e", 2, 40.0, None), (2, "f", 1, None, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, query string, frequency long, lat double, lon double")
    out = {r["query"]: r for r in C.centroid_distance(df).collect()}
    assert (out["a"]["c_lat"], out["a"]["c_lon"]) == (51.0, 9.0) and out["b"]["distance_km"] == 0.0
    assert [out[q]["distance_km"] for q in "def"] == [None, None, None]
    scored = {r["query"]: r["confidence"] for r in C.cluster_confidence(df).collect()}
    assert set(scored) == set("abcdef") and all(scored[q] == 0.0 for q in "def") and scored["b"] == 1.0


def test_consolidate_a_long_chain_against_a_plain_scan(spark):
    rng = np.random.default_rng(4)
    rows = [(int(d), 1, int(p), int(n), f"t{p}", f"l{n}", "GPE") for d in (1, 2) for p in range(3000) for n in rng.choice([1, 2, 3], size=rng.integers(1, 3), replace=False)]
    schema = "doc_id long, model_rank int, pos int, len int, token string, lemma string, entity_type string"
    want, end = [], {}
    for r in sorted(rows, key=lambda r: (r[0], r[2], -r[3])):
        if r[2] >= end.get(r[0], 0):
            want.append(r)
            end[r[0]] = r[2] + r[3]
    assert sorted(tuple(r) for r in E.consolidate(spark.createDataFrame(rows, schema).repartition(5), 3).collect()) == sorted(want)


def test_regex_metadata(spark):
    df = spark.createDataFrame(
        [(1, "Die Fördersumme liegt bei 10 Millionen €."), (2, "rating: 4 Note 2"), (3, "am 3.10.2019 EUR 12,5 Mio.")],
        "doc_id long, text string",
    )
    no_match = M.extract_metadata(df.where("doc_id = 1"), {"x": [r"[0-9]+[Millionen]?(DM|€)"]}).first()
    assert no_match.x is None
    out = {r.doc_id: r for r in M.extract_metadata(df).collect()}
    assert out[2].grade == "Note 2"  # first pattern wins, not first position
    assert out[3].date == "3.10.2019" and out[3].funding_volume == "EUR 12,5 Mio."


def test_clean_names(spark):
    df = spark.createDataFrame(
        [(1, 1, 0, "New\nYork", "\tNew_York  "), (1, 1, 1, "a  b", "Saint   Louis"), (1, 1, 2, "X", "X")],
        "doc_id long, model_rank int, pos int, token string, lemma string",
    )
    out = sorted((r.token, r.lemma) for r in E.clean_names(df.withColumn("entity_type", F.lit("GPE"))).collect())
    assert out == [("New York", "New York"), ("a  b", "Saint Louis")]


def test_consolidate_leftmost_longest(spark):
    spans = [(0, 1, "New"), (0, 2, "New York"), (1, 1, "York"), (1, 3, "York in Rome"), (3, 1, "Rome")]
    df = spark.createDataFrame(
        [(7, 1, p, n, t, t, "GPE") for p, n, t in spans],
        "doc_id long, model_rank int, pos int, len int, token string, lemma string, entity_type string",
    )
    assert sorted(r.token for r in E.consolidate(df, 3).collect()) == ["New York", "Rome"]


def test_consolidate_chain(spark):
    # overlapping bigrams at 0..5: greedy keeps 0, 2, 4; the unigram at 6 is blocked by the bigram at 5? no: 4 ends at 6
    spans = [(p, 2, f"b{p}") for p in range(6)] + [(6, 1, "u6")]
    df = spark.createDataFrame(
        [(1, 1, p, n, t, t, "GPE") for p, n, t in spans],
        "doc_id long, model_rank int, pos int, len int, token string, lemma string, entity_type string",
    )
    assert sorted(r.pos for r in E.consolidate(df, 2).collect()) == [0, 2, 4, 6]


def test_combine_models_equals_iterated_anti_joins(spark):
    rows = [(1, 1, 0, "A"), (1, 2, 0, "A"), (1, 2, 5, "B"), (1, 3, 5, "B"), (1, 3, 9, "C"), (2, 2, 0, "A")]
    df = spark.createDataFrame(rows, "doc_id long, model_rank int, pos int, token string")
    got = sorted(tuple(r) for r in E.combine_models(df).collect())
    kept = df.where("model_rank = 1")
    for r in (2, 3):
        new = df.where(f"model_rank = {r}").join(kept.select("doc_id", "token"), ["doc_id", "token"], "left_anti")
        kept = kept.unionByName(new)
    assert got == sorted(tuple(r) for r in kept.select(*df.columns).collect())


def test_removal_rules(spark):
    df = spark.createDataFrame(
        [(1, "a", 1, 0.0, 0.0, "office", "x", 0.1), (1, "b", 1, 0.0, 0.0, "waterway", "fuel", 0.1),
         (1, "c", 1, 0.0, 0.0, "waterway", "river", 0.1), (1, "d", 1, 0.0, 0.0, None, None, 0.1),
         (1, "e", 1, 0.0, 0.0, "place", "all", 0.1)], GEO)
    keep = sorted(r.query for r in FL.remove_classes(df, [("office", "all"), ("waterway", "fuel")]).collect())
    assert keep == ["c", "d", "e"]
    rules = spark.createDataFrame([("office", "all"), ("waterway", "fuel")], "class string, type string")
    assert sorted(r.query for r in FL.remove_classes(df, rules).collect()) == keep
    # (all, all) only removes a literal type "all"
    assert sorted(r.query for r in FL.remove_classes(df, [("all", "all")]).collect()) == ["a", "b", "c", "d"]


def test_point_in_polygon_hole_and_overlap(spark):
    square = [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)],
              [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0), (4.0, 4.0)]]
    other = [[(5.0, 5.0), (20.0, 5.0), (20.0, 20.0), (5.0, 20.0), (5.0, 5.0)]]
    b = spark.createDataFrame(
        [(2, "B", "X", [[{"x": x, "y": y} for x, y in r] for r in other]),
         (1, "A", "X", [[{"x": x, "y": y} for x, y in r] for r in square])],
        "poly_id int, country string, continent string, rings array<array<struct<x:double,y:double>>>")
    pts = spark.createDataFrame([(1.0, 1.0), (5.0, 5.5), (8.0, 8.0), (30.0, 30.0)], "lat double, lon double")
    out = {(r.lat, r.lon): r.country for r in N.locate_points(pts, b).collect()}
    # (lat 5, lon 5.5) sits in A's hole but inside B; (8, 8) is in both: lowest id wins
    assert out == {(1.0, 1.0): "A", (5.0, 5.5): "B", (8.0, 8.0): "A", (30.0, 30.0): None}


def _wl(spark, rows):
    return spark.createDataFrame(rows, "id string, location string, frequency long, lat double, lon double, class string, "
                                       "type string, importance double, country string, continent string, confidence double, doc_id long")


def test_condense_modes(spark):
    rows = [("f1", n, 1, 1.0, 2.0, "place", "city", 0.5, "C", "K", c, 1) for n, c in
            [("b", 1.0), ("a", 0.0), ("b", 1.0), ("a", 1.0), ("c", 0.0)]]
    rows.append(("f2", "a", 4, 1.0, 2.0, "place", "city", None, "C", "K", 1.0, 2))
    wl = _wl(spark, rows)
    by_coords = {r.id: r for r in W.condense(wl, "coords").collect()}
    assert by_coords["f1"].location == "a"  # tie between a and b: lowest name
    assert by_coords["f1"].frequency == 5
    by_name = {(r.id, r.location): r for r in W.condense(wl, "name").collect()}
    assert by_name[("f2", "a")].importance is None  # strict mean
    assert by_name[("f1", "a")].confidence == pytest.approx(2 / 3)
    assert W.condense(wl, "name").columns == WHITELIST_COLUMNS
    with pytest.raises(ValueError):
        W.condense(wl, "other")


def test_blacklist_after_confidence_keeps_centroid(spark):
    rows = [(1, "A", 5, 50.0, 8.0), (1, "B", 5, 50.1, 8.1), (1, "C", 1, 50.2, 8.2), (1, "Far", 1, -30.0, 100.0)]
    df = spark.createDataFrame([r + ("place", "city", 0.1) for r in rows], GEO)
    bl = spark.createDataFrame([("A", 0.0, 0.0)], "location string, lat double, lon double")
    scored = C.cluster_confidence(df)
    kept = FL.remove_blacklisted(scored, bl)
    assert sorted(r.query for r in kept.collect()) == ["B", "C", "Far"]
    c = {r.query: r.c_lat for r in kept.collect()}
    assert c["B"] == pytest.approx((250 + 250.5 + 50.2 - 30) / 12)  # A still pulled the centroid
    rep = FL.blacklist_report(scored, bl).collect()
    assert [(r.doc_id, r.removed) for r in rep] == [(1, "A")]


def test_empty_corpus(spark):
    df = spark.createDataFrame([], GEO)
    out = C.cluster_confidence(df)
    assert out.count() == 0 and "confidence" in out.columns


def test_confidence_independent_of_arrow_batch_size(spark):
    rng = np.random.default_rng(7)
    rows = []
    for doc in range(12):
        for j in range(int(rng.integers(1, 9))):
            rows.append((doc, f"p{j}", int(rng.integers(1, 5)), float(rng.uniform(-60, 60)), float(rng.uniform(-170, 170)),
                         "place", "city", 0.5))
    df = spark.createDataFrame(rows, GEO)
    base = sorted(tuple(r) for r in C.cluster_confidence(df).select("doc_id", "query", "confidence").collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        small = sorted(tuple(r) for r in C.cluster_confidence(df).select("doc_id", "query", "confidence").collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert small == base
    # and equal to the per-document cut computed directly
    pdf = C.centroid_distance(df).toPandas()
    for doc, g in pdf.groupby("doc_id"):
        vals = g.groupby("distance_km").size()
        cut = C.choose_cut(vals.index.to_numpy(float), vals.to_numpy(float))
        want = {q: (1.0 if dk <= cut else 0.0) for q, dk in zip(g["query"], g["distance_km"])}
        assert {(q, c) for dd, q, c in base if dd == doc} == set(want.items())
