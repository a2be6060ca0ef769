import numpy as np
import pytest

from docgeo.llm import ann, queries
from tests.conftest import SF001


def brute(rows, k=20):
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        score = (x * x[q]).sum(axis=1)
        others = np.flatnonzero(ids != ids[q])
        best = others[np.lexsort((ids[others], -score[others]))][:k]
        out[int(ids[q])] = [(int(ids[i]), score[i]) for i in best]
    return out


def by_query(out):
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(got.setdefault(r["query_id"], [])) + 1
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    return got


def test_odd_vectors_are_exact_when_all_are_reranked(spark):
    rows = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (40, None), (60, [0.0, 0.0]), (80, [1.0, float("nan")]), (100, [1.0, None]), (3, [3.0, -1.0]), (3, [3.0, -1.0]), (120, [float("inf"), 1.0])]
    rows += [(None, [1.0, 1.0]), (-20, [5.0, 5.0]), (7, [1.0, 2.0])] + [(1000 + i, [1.0, 2.0]) for i in range(60)] + [(2000 + i, [float(i), 1.0]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "vec_id as rep", "vec_id as v", "embedding as near", "vec_id as shard")
    got = by_query(ann.nearest(df, lambda c: c % 20 == 0, params=ann.PermutationIndex(rerank=1.0)))
    assert got == {q: [(i, pytest.approx(s)) for i, s in best] for q, best in brute(rows).items()}


def test_another_length_takes_no_part(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0, 1.0])], "vec_id long, embedding array<float>")
    assert by_query(ann.nearest(df, lambda c: c % 20 == 0)) == {0: [(1, 1.0)]}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(none, lambda c: c % 20 == 0).collect() == []
    assert ann.nearest(spark.createDataFrame([(1, [1.0])], none.schema), lambda c: c % 20 == 0).collect() == []


def recall(got, want):
    assert got.keys() == want.keys() and all(len(got[q]) == len(want[q]) for q in want)
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


@pytest.mark.parametrize("shard", [8192, 150])
def test_recall(spark, shard):
    rng = np.random.default_rng(0)
    rows = [(i, (rng.normal(size=24) * rng.uniform(0.5, 2)).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got, want = by_query(ann.nearest(df, lambda c: c % 20 == 0, params=ann.PermutationIndex(shard=shard))), brute(rows)
    assert recall(got, want) >= 0.9
    x = {i: np.array(v) for i, v in rows}
    assert all(abs(s - x[q] @ x[i]) < 1e-9 for q in got for i, s in got[q])
    assert all(got[q] == sorted(got[q], key=lambda r: (-r[1], r[0])) for q in got)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_query(spark, sf):
    """The registered query, whose result comes through the index at every size."""
    sf = SF001.replace("sf0.001", sf)
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert recall(by_query(queries.QUERIES["op1_ann"](spark, sf)), brute(rows)) >= 0.9


def test_what_a_query_reads_and_reranks():
    """Structured vectors: clusters. Few postings, few reranked, nearly all neighbours."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(200, 32))
    v = (centres[rng.integers(0, 200, 20_000)] + 0.3 * rng.normal(size=(20_000, 32))).astype(np.float64)
    v /= np.linalg.norm(v, axis=1)[:, None]
    pivots = v[rng.permutation(len(v))[:1024]]
    near = np.argsort(-(v @ pivots.T), axis=1, kind="stable")[:, :32]
    shard = ann.Shard(v, near, 1024, 16)
    hits, read = [], []
    for i in range(0, 2000, 20):
        best, score = shard.search(v[i], near[i, :16], 400, 21)
        want = set(np.argsort(-(v @ v[i]), kind="stable")[:21].tolist())
        hits.append(len(want & set(best.tolist())) / 21)
        read.append(shard.postings(near[i, :16]))
    assert np.mean(hits) >= 0.9 and np.mean(read) < len(v)
