import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from docgeo.llm import queries
from docgeo.llm import toxicity as T


def cosines(a, b):
    """Plain cosines of two lists of {term: weight}."""
    unit = lambda v: (v, math.sqrt(sum(x * x for x in v.values())) or 1.0)
    return np.array([[sum(x * w[t] for t, x in v.items() if t in w) / (n * m) for w, m in map(unit, b)] for v, n in map(unit, a)])


@pytest.mark.parametrize("n_terms", [12, 60, 900])
def test_search_is_exact(n_terms):
    """Common terms (rows of all weights), rare ones (lists), blocks that are skipped, and equal cosines."""
    rng = np.random.default_rng(n_terms)
    draw = lambda: np.sort(rng.choice(n_terms, rng.integers(0, 9), replace=False, p=(p := 1 / np.arange(1, n_terms + 1)) / p.sum()))
    examples = [(i, int(rng.random() < 0.3), 1.0, ids.tolist(), rng.integers(1, 4, len(ids)).tolist()) for i, ids in enumerate(draw() for _ in range(700))]
    index = T.build_index(rng.uniform(1, 5, n_terms), examples)
    assert index.toxic.sum() + index.clean.sum() == 700
    ids = [draw() for _ in range(300)]
    asked = T.weighed(index.term_weight, ids, [rng.integers(1, 4, len(i)).astype(float) for i in ids])
    dense = lambda v: np.stack([np.bincount(x.ids, weights=x.weights, minlength=n_terms) for x in (v.part(i, i + 1) for i in range(len(v)))])
    full = dense(asked) @ dense(index.vectors).T
    for row, (best, score) in zip(full, index.nearest(asked), strict=True):
        want = np.sort(row[row > 1e-12])[::-1][: T.NEIGHBOURS]
        assert len(want) == len(score) and np.allclose(score, np.minimum(want, 1.0)) and np.allclose(np.minimum(row[best], 1.0), score)
        assert len(set(best.tolist())) == len(best)
        assert all(a < b for a, b, x, y in zip(best, best[1:], score, score[1:]) if x == y)


def test_query_against_a_plain_version(spark):
    """Frequencies, weights, cosines, votes and calibration of every document, computed again without the operator's code."""
    sf = "/root/testdata/sf0.001"
    out = {r["doc_id"]: r for r in queries.QUERIES["op7_toxicity"](spark, sf).collect()}
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["toxic"] is not None}
    letters = re.compile("(?:[a-z]|[^\x00-\x7f])+")
    tf = {k: Counter(letters.findall(t.lower())) for k, t in docs.items()}
    examples = [k for k in labels if k in docs and zlib.crc32(str(k).encode()) % 5]
    assert max(Counter(labels[k] for k in examples).values()) <= T.EXAMPLES  # so all of them are taken, with weight 1
    vocabulary = {t for k in examples for t in tf[k]}
    df = Counter(t for c in tf.values() for t in c)
    distinct = {(frozenset(tf[k].items()), labels[k]) for k in examples}  # copies count once
    n1 = sum(y for _, y in distinct)
    n0 = len(distinct) - n1

    def weight(t):
        a, b = (sum(1 for v, y in distinct if y == c and t in dict(v)) for c in (1, 0))
        chi2 = (a * (n0 - b) - b * (n1 - a)) ** 2 * (n1 + n0) / max((a + b) * (n1 + n0 - a - b) * n1 * n0, 1e-9)
        return (math.log((1 + len(docs)) / (1 + df[t])) + 1) * (T.LEAST_WEIGHT + chi2**2 / (chi2**2 + T.HALF_CHI2**2))

    weights = {t: weight(t) for t in vocabulary}
    vector = lambda c: {t: (1 + math.log(n)) * weights[t] for t, n in c.items() if t in weights}
    texts = list({frozenset(tf[k].items()) for k in examples})
    at = {v: i for i, v in enumerate(texts)}
    votes = np.zeros((len(texts), 2))
    for k in examples:
        votes[at[frozenset(tf[k].items())], labels[k]] += 1
    near = dict(zip(docs, cosines([vector(tf[k]) for k in docs], [vector(dict(v)) for v in texts])))
    base = votes[:, 1].sum() / votes.sum()
    close = {}

    def vote(k):
        mine = votes.copy()
        if k in examples:
            mine[at[frozenset(tf[k].items())], labels[k]] -= 1
        row = near[k]
        best = sorted((i for i in range(len(row)) if row[i] > 0), key=lambda i: -row[i])[: T.NEIGHBOURS]
        if not best:
            best = [i for i, v in enumerate(texts) if not v]
        # a tie at the last place leaves the choice to the order of the vectors
        close[k] = len([x for x in row if x > 0 and len(best) == T.NEIGHBOURS and abs(x - row[best[-1]]) < 1e-12]) > 1
        w = [1 / (1.05 - (min(row[i], 1.0) if row[i] > 0 else 1.0)) for i in best]
        toxic, total = (sum(x * y for x, y in zip(w, part)) for part in ([mine[i, 1] for i in best], [mine[i].sum() for i in best]))
        return (toxic + base) / (total + 1)

    given = np.array([vote(k) for k in examples])
    slope, shift = T.platt(given, np.array([labels[k] for k in examples], dtype=float), np.ones(len(examples)))
    clear = 0
    for k in docs:
        v = min(max(vote(k), 1e-4), 1 - 1e-4)
        if not close[k]:
            clear += 1
            assert abs(out[k]["score"] - 1 / (1 + math.exp(-(slope * math.log(v / (1 - v)) + shift)))) < 2e-5, k
    assert clear > 0.9 * len(docs)


def test_nearly_every_text_has_evidence(spark):
    out = queries.QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.01").collect()
    assert sum(not r["evidence"] for r in out) < 0.01 * len(out) and len({r["score"] for r in out}) > 0.5 * len(out)


def test_keys_that_are_no_numbers(spark):
    docs = spark.createDataFrame([(f"d{i}", "you fool" if i % 3 == 0 else f"good day {i % 4}") for i in range(40)], "doc_id string, text string")
    labels = docs.selectExpr("doc_id", "cast(text like '%fool%' as int) as toxic")
    rows = T.toxicity(docs, labels).collect()
    assert len(rows) == 40 and all((r["score"] > 0.5) == (int(r["doc_id"][1:]) % 3 == 0) for r in rows)
    assert all(e["example"].startswith("d") for r in rows for e in r["evidence"])


def test_held_out_accuracy(spark):
    out = queries.QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.1")
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())
    labels = [(r["toxic"], rows[r["doc_id"]]) for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect() if r["doc_id"] in rows]
    held = [(t, r) for t, r in labels if r["held_out"]]
    toxic, clean = [r["score"] for t, r in held if t == 1], [r["score"] for t, r in held if t == 0]
    assert np.mean([r["predicted"] == t for t, r in held]) > 0.96
    assert np.mean([a > b for a in toxic for b in clean]) > 0.93
    assert abs(np.mean([t - r["score"] for t, r in held])) < 0.03  # calibrated


def test_labels_that_are_held_out_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flipped = labels.withColumn("toxic", T.F.when(T.held_out(T.F.col("doc_id")), 1 - T.F.col("toxic")).otherwise(T.F.col("toxic")))
    once, twice = ({r["doc_id"]: r["score"] for r in T.toxicity(docs, x).collect()} for x in (labels, flipped))
    assert once == twice


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 1), (5, 0, None), (None, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    out = T.toxicity(odd_docs, labels).collect()
    assert len(out) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert T.toxicity(no_docs, labels).collect() == []
    assert all(r["score"] >= 0 for r in T.toxicity(odd_docs, labels.limit(0)).collect())
