"""One scan of the texts, the first-token index, and the consolidation by blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docgeo.functions.text import tokens
from docgeo.operators import entities as E
from docgeo.operators import language as L
from docgeo.operators import scan as S
from docgeo.plans import pipeline as P
from docgeo.plans.fixtures import Fixtures
from docgeo.plans.queries import _inputs
from tests.conftest import SF001

LEXICON = "lang string, surface string, lemma string, entity_type string"
SPANS = "doc_id long, model_rank int, pos int, len int, token string, lemma string, entity_type string"


def plan(df):
    return df._jdf.queryExecution().toString()


def greedy(rows):
    out, end = [], {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2], -r[3], r[5], r[6])):
        if r[2] >= end.get(r[:2], 0):
            out.append(r)
            end[r[:2]] = r[2] + r[3]
    return sorted(out)


@pytest.mark.parametrize("block", [1, 3, 8, 1024])
def test_consolidation_in_blocks(spark, monkeypatch, block):
    """Chains over many blocks, gaps, several spans at a place, ties, spans that reach over whole blocks."""
    monkeypatch.setattr(E, "BLOCK", block)
    rng = np.random.default_rng(block)
    rows = []
    for doc in range(12):
        p = 0
        while p < 120:
            for n in rng.choice([1, 1, 2, 3, 4], size=rng.integers(1, 4)):
                rows.append((doc, int(doc % 3 == 0) + 1, p, int(n), f"t{p}", f"l{rng.integers(3)}", str(rng.choice(["GPE", "PER"]))))
            p += int(rng.choice([1, 1, 1, 2, 2, 9])) if doc % 2 else 1
    rows = sorted(set(rows))
    got = E.consolidate(spark.createDataFrame(rows, SPANS).repartition(5), 4)
    found, want = sorted(tuple(r) for r in got.collect()), greedy(rows)
    assert [r[:4] + r[5:] for r in found] == [r[:4] + r[5:] for r in want] and got.columns == [c.split()[0] for c in SPANS.split(", ")]
    assert "Python" not in plan(got) and "Pandas" not in plan(got) and "Arrow" not in plan(got)


def test_a_long_document_spreads_over_tasks(spark):
    """A document of ten million tokens, dense chains in part: no task holds more than its blocks."""
    spans = spark.range(0, 10_000_000, 40, 8).select(
        F.lit(7).cast("long").alias("doc_id"), F.lit(1).alias("model_rank"), F.col("id").cast("int").alias("pos"), (F.col("id") % 3 + 1).cast("int").alias("len")
    )
    chain = spark.range(500_000, 520_000, 1, 4).select(F.lit(7).cast("long"), F.lit(1), F.col("id").cast("int"), F.lit(2))
    df = spans.where("pos < 500000 or pos > 520010").unionByName(chain.toDF(*spans.columns)).selectExpr("*", "'t' as token", "'l' as lemma", "'GPE' as entity_type")
    out = E.consolidate(df, 3)
    assert out.count() == spans.where("pos < 500000 or pos > 520010").count() + 10_000
    assert out.where("pos between 500000 and 519999 and pos % 2 = 1").count() == 0
    sizes = [r["count"] for r in df.groupBy("doc_id", F.floor(F.col("pos") / E.BLOCK)).count().agg(F.max("count").alias("count")).collect()]
    assert sizes[0] <= 2 * E.BLOCK


def test_hits_of_one_scan(spark):
    lexicon = spark.createDataFrame(
        [("en", "New York", "New York", "GPE"), ("en", "York", "York", "GPE"), ("de", "New York", "New York", "GPE"), ("en", "new", "Newness", "PER"), ("en", "New York Times Square", "x", "LOC"), ("fr", " !? ", "none", "GPE")],
        LEXICON,
    )
    profile = spark.createDataFrame([("the", "en"), ("in", "en"), ("in", "de"), ("new", "en")], "word string, lang string")
    docs = spark.createDataFrame([(1, "The new New York, in THE York"), (2, None), (3, ""), (4, "nothing"), (5, "In New York Times Square"), (6, "New")], "doc_id long, text string")
    hits = S.text_hits(docs, lexicon, profile)
    counts = {(r["doc_id"], r["code"]): r["n"] for r in S.profile_counts(hits).collect()}
    assert counts == {(1, "en"): 5, (1, "de"): 1, (5, "en"): 2, (5, "de"): 1, (6, "en"): 1}
    named = sorted((r["doc_id"], r["pos"], r["len"], r["lang"], r["token"]) for r in hits.where("code is null").collect())
    assert named == [
        (1, 1, 1, "en", "new"), (1, 2, 2, "de", "New York"), (1, 2, 2, "en", "New York"), (1, 3, 1, "en", "York"), (1, 6, 1, "en", "York"),
        (5, 1, 2, "de", "New York"), (5, 1, 2, "en", "New York"), (5, 1, 4, "en", "New York Times Square"), (5, 2, 1, "en", "York"),
    ]
    alone = sorted((r["doc_id"], r["pos"], r["len"], r["lang"], r["token"]) for r in S.text_hits(docs, lexicon).collect())
    assert alone == named


def test_hits_against_all_ngrams(spark):
    """The index finds what looking up every n-gram finds, and the counts are those of the detector alone."""
    fx = Fixtures(spark, SF001)
    docs, lexicon, profile = fx.corpus(), fx.multilingual_lexicon(), fx.language_profile()
    hits = S.text_hits(docs, lexicon, profile)
    grams = docs.select("doc_id", tokens("text").alias("t")).select("doc_id", F.posexplode("t").alias("pos", "a"), "t")
    grams = grams.select("doc_id", "pos", F.explode(F.array(F.col("a"), F.concat(F.col("a"), F.lit(" "), F.get("t", F.col("pos") + 1)))).alias("gram"))
    want = grams.join(S.prepare_lexicon(lexicon), "gram").select("doc_id", "pos", "len", "lang", "lemma", "entity_type")
    got = hits.where("code is null").select("doc_id", "pos", "len", "lang", "lemma", "entity_type")
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
    assert sorted(S.profile_counts(hits).collect()) == sorted(L.count_profile_words(docs, profile).select("doc_id", "code", "n").collect())


def test_texts_are_scanned_once(spark):
    fx = Fixtures(spark, SF001)
    inp = _inputs(fx)
    hits = S.text_hits(inp.docs, inp.lexicon, inp.profile)
    assert hits._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(text") == 1
    after = P.doc_locations(P.scanned(inp))  # everything after the scan: no text is read
    physical = after._jdf.queryExecution().executedPlan().toString()
    assert "text" not in "".join(line for line in physical.split("\n") if "ReadSchema" in line)


def test_centroids_hold_no_document_in_a_window(spark):
    from docgeo.operators import confidence as C

    df = spark.createDataFrame([(1, "a", 2, 1.0, 2.0)], "doc_id long, query string, frequency long, lat double, lon double")
    assert "Window" not in plan(C.cluster_confidence(df))
