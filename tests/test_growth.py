"""What leaves a task grows with what is found, not with the texts; what two branches need is shuffled once."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from docgeo.operators import confidence as C
from docgeo.operators import geocode as G
from docgeo.operators import scan as S
from docgeo.operators import whitelist as W
from docgeo.plans import fixtures as X
from docgeo.plans import pipeline as P

LEXICON = "lang string, surface string, lemma string, entity_type string"
W_LEDGER = "id string, location string, frequency long, lat double, lon double, class string, type string, importance double, country string, continent string, confidence double, doc_id long, _seq int"


@pytest.fixture()
def plain(spark):
    """Joins by shuffles, and plans as they are made: the way it is with tables too large to be broadcast."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def shuffled(df) -> int:
    """Rows that the plan's shuffles write."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()

    def total(node) -> int:
        metric = node.metrics().get("shuffleRecordsWritten")
        return (metric.get().value() if metric.isDefined() else 0) + sum(total(node.children().apply(i)) for i in range(node.children().size()))

    return total(plan)


def inputs(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("the word und " * 200 + "New York in Bonn").alias("text"))
    lexicon = spark.createDataFrame([("en", "New York", "New York", "GPE"), ("en", "Bonn", "Bonn", "GPE"), ("de", "Bonn", "Bonn", "LOC")], LEXICON)
    profile = spark.createDataFrame([("the", "en"), ("in", "en"), ("in", "de")], "word string, lang string")
    return docs, lexicon, profile


@pytest.mark.parametrize("profiled", [True, False])
def test_tokens_stay_in_their_task(plain, profiled):
    docs, lexicon, profile = inputs(plain)
    hits = S.text_hits(docs, lexicon, profile if profiled else None)
    rows = hits.collect()
    assert sum(r["lang"] is not None for r in rows) == 50 * 3
    if profiled:
        assert {(r["code"], r["n"]) for r in rows if r["code"]} == {("en", 201), ("de", 1)}
    assert shuffled(hits) < 1000  # of 30,200 tokens


def test_a_full_filter_misses_nothing(plain, monkeypatch):
    """With a bit for every other name or so, runs that are no names pass, and the lexicon sorts them out."""
    docs, lexicon, profile = inputs(plain)
    want = sorted(map(str, S.text_hits(docs, lexicon, profile).collect()))
    monkeypatch.setattr(S, "FILTER_BITS", 64)
    more = lexicon.unionByName(plain.range(300).select(F.lit("en").alias("lang"), *[F.concat(F.lit("x"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias(c) for c in ("surface", "lemma")], F.lit("GPE").alias("entity_type")))
    assert sorted(map(str, S.text_hits(docs, more, profile).collect())) == want


def test_hits_are_shuffled_once_to_be_consolidated(plain):
    docs, lexicon, profile = inputs(plain)
    inp = P.Inputs(docs=docs, lexicon=lexicon, cache=None, profile=profile)
    assert "ReusedExchange" in P.consolidated(inp)._jdf.queryExecution().executedPlan().toString()


def test_documents_are_clustered_together():
    rng = np.random.default_rng(5)
    rows = []
    for doc in range(300):
        n = int(rng.choice([1, 2, 3, 4, 5, 7, 20, 64, 65, 90]))
        d = np.unique(np.round(rng.exponential(900, n), 6)) if doc % 2 else np.sort(rng.choice(n + 4, n, replace=False)).astype(float)
        rows += [(doc, x, float(rng.integers(1, 4 if doc % 3 else 2))) for x in d]
    pdf = pd.DataFrame(rows, columns=["doc_id", "distance_km", "m"])
    want = {k: C.choose_cut(g["distance_km"].to_numpy(), g["m"].to_numpy()) for k, g in pdf.groupby("doc_id")}
    got = C._cuts_of(pdf, C.MAX_K, C.GAIN)
    assert dict(zip(got["doc_id"], got["cut"])) == want
    together = [g for _, g in pdf.groupby("doc_id") if len(g) == 20]
    cuts = C.choose_cuts(np.array([g["distance_km"] for g in together]), np.array([g["m"] for g in together]))
    assert list(cuts) == [want[g["doc_id"].iloc[0]] for g in together]


def test_names_in_two_documents(plain):
    texts = [(1, "en", "Alpha Beta Gamma xDelta, Alpha"), (2, None, "Alpha  Beta\nGamma"), (2, "de", "Single Single Äpfel"), (None, "fr", "Beta Äpfel"), (3, "en", None), (3, "en", "Äpfel ABeta Gamma"), (4, "en", "")]
    docs = plain.createDataFrame(texts, "doc_id long, lang string, text string")
    seen = set()
    for doc, lang, text in texts:
        seen |= {(1, w, lang, doc) for w in re.findall(r"[A-ZÄ][a-zä]{3,}", text or "")}
        toks = re.findall(r"[^\W\d_]+", text or "")
        seen |= {(2, f"{a} {b}", lang, doc) for a, b in zip(toks, toks[1:]) if all(re.fullmatch(r"[A-ZÄ][a-zä]{3,}", x) for x in (a, b))}
    of = {}
    for n, w, _, doc in seen:
        of.setdefault((n, w), set()).update({doc} - {None})
    want = {(n, w, lang) for n, w, lang, _ in seen if len(of[n, w]) >= 2}
    got = [(r["n_tokens"], r["w"], r["lang"]) for r in X._names(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and (2, "Beta Gamma", None) in want
    many = plain.range(0, 400, 1, 2).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("Alpha Beta Gamma").alias("text"))
    assert shuffled(X._names(many)) <= 5 * 4 + 5  # by name and task, not by document


def test_hits_are_dealt_once_by_document(plain):
    """From the hits to the names of a document nothing is dealt by another key."""
    docs, lexicon, profile = inputs(plain)
    inp = P.scanned(P.Inputs(docs=docs, lexicon=lexicon, cache=None, profile=profile))
    names = P.lookup_names(inp)
    plan = names._jdf.queryExecution().executedPlan().toString()
    keys = {re.sub(r"#\d+L?", "", k) for k in re.findall(r"hashpartitioning\((.*?), \d+\)", plan)}
    assert keys == {"doc_id", "code"}  # code: the list of languages
    assert sorted(map(tuple, names.collect())) == sorted((d, n, 1) for d in range(50) for n in ("Bonn", "New York"))


def test_braces_go_before_names_are_counted(spark):
    docs = spark.createDataFrame([(1, "Bonn und Rom und Ulm"), (1, "Rom"), (2, "Ulm Bonn")], "doc_id long, text string")
    listed = [("de", "Bonn", "{Rom}", "GPE"), ("de", "Rom", "Rom", "LOC"), ("de", "Ulm", "{}{", "GPE")]
    profile = spark.createDataFrame([("und", "de")], "word string, lang string")
    inp = P.Inputs(docs=docs, lexicon=spark.createDataFrame(listed, LEXICON), cache=None, profile=profile)
    want = sorted(map(tuple, G.strip_name_braces(P.doc_locations(inp)).collect()))
    assert sorted(map(tuple, P.lookup_names(inp).collect())) == want and want


def test_the_filter_grows_with_the_names(plain, monkeypatch):
    monkeypatch.setattr(S, "FILTER_BITS", 1 << 12)

    def words(letter: str, n: int):
        return plain.range(n).select(F.concat(F.lit(letter), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("w"))

    lexicon = words("N", 300).select(F.lit("en").alias("lang"), F.col("w").alias("surface"), F.col("w").alias("lemma"), F.lit("GPE").alias("entity_type"))
    docs = words("x", 20_000).select(F.lit(1).cast("long").alias("doc_id"), F.col("w").alias("text"))
    assert S.text_hits(docs, lexicon).count() == 0
    assert shuffled(S.text_hits(docs, lexicon)) < 1200  # 300 names, and few of 20,000 words


def test_first_rows_keep_one_order(plain):
    ledger = plain.createDataFrame([], W_LEDGER)
    for mode in ("name", "coords"):
        plan = W.condense(ledger, mode)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("min_by(") == 1
