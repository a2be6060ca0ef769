import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docgeo.llm import langid, queries
from tests.conftest import SF001

LANGS = ("en", "de")


@pytest.fixture(scope="module")
def model(spark):
    return langid.train(spark.read.parquet(f"{SF001}/documents.parquet"))


def test_fusion_against_brute_force(spark):
    """The whole sum of evidence, row by row, in plain Python."""
    rng = np.random.default_rng(0)
    model = np.log(rng.dirichlet(np.ones(langid.BUCKETS) * 0.05, 3).T + 1e-9).astype(np.float32)
    words = ["aa", "bb", "cc", "dd", "ee"]
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(words, rng.integers(0, 4)))
        rows.append((i, text or None, [None, "en", "de"][i % 3], [None, "com", "de"][i % 4 % 3], [None, "a.x.com", "b.x.com", "c.org"][i % 4], [None, "x.com", "x.com", "c.org"][i % 4]))
    df = spark.createDataFrame(rows, "id long, text string, declared string, suffix string, host string, domain string")
    got = {r["id"]: r for r in langid.identify(df, model, ["id"], languages=LANGS).collect()}
    reads, owns = {}, {}
    for r in rows:
        b = langid.trigrams(r[1] or "")
        reads[r[0]] = model[b].sum(axis=0, dtype=np.float64) / langid.OVERLAP if len(b) else None
        if len(b):
            e = np.exp(reads[r[0]] - reads[r[0]].max())
            owns[r[0]] = np.round(e / e.sum() * 1e6) / 1e6
        else:
            owns[r[0]] = np.zeros(3)
    has = {i: float(reads[i] is not None) for i in reads}
    corpus = (sum(owns.values()) + 1) / (sum(has.values()) + 3)
    for r in rows:
        if reads[r[0]] is None:
            assert (got[r[0]]["lang"], got[r[0]]["confidence"], got[r[0]]["accepted"]) == ("und", 1.0, False)
            continue

        def smoothed(column, above, weight, r=r):
            same = [x[0] for x in rows if r[column] is not None and x[column] == r[column] and x[0] != r[0]]
            return (sum((owns[i] for i in same), np.zeros(3)) + weight * above) / (sum(has[i] for i in same) + weight)

        host = smoothed(4, smoothed(5, corpus, langid.DOMAIN_ROWS), langid.HOST_ROWS)
        score = reads[r[0]] + np.log(host)
        for column in (2, 3):
            if r[column] is not None:
                score = score + np.log(smoothed(column, corpus, langid.VALUE_ROWS) / corpus)
        p = np.exp(score - score.max())
        p /= p.sum()
        assert got[r[0]]["confidence"] == pytest.approx(p.max(), abs=2e-6)
        assert p[[*LANGS, "und"].index(got[r[0]]["lang"])] == pytest.approx(p.max(), abs=2e-6)


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id >= 200")  # beyond the training rows
    evidence = langid.document_evidence(F.col("text"), F.col("source"))
    out = langid.identify(docs.select("doc_id", "lang", *[c.alias(k) for k, c in evidence.items()]).withColumnRenamed("lang", "truth"), model, ["doc_id", "truth"])
    n, right, kept = out.agg(F.count("*"), F.sum((F.col("lang") == F.col("truth")).cast("int")), F.sum(F.col("accepted").cast("int"))).first()
    assert right / n > 0.99 and kept / n > 0.99


def test_pages_use_all_evidence(spark):
    out = queries.QUERIES["op4_language_id"](spark, SF001)
    pages = spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("truth"))
    joined = out.filter("page_id is not null").drop("doc_id").join(pages, "page_id")
    assert joined.count() == pages.count()
    assert joined.filter("lang <> truth").count() <= 0.05 * pages.count()


def test_evidence_of_a_page(spark):
    html = '<!DOCTYPE html><HTML class="a" lang=\'de-AT\'><script>var x="<p>";</script><p>Text &amp; mehr</p><!-- <b>no</b> --></html>'
    rows = [("https://user@www.beispiel.co.at:80/fr/seite?x=1", html), ("http://h/abc", "<p>x</p>"), (None, None), ("no address", "")]
    df = spark.createDataFrame(rows, "url string, html string")
    got = df.select(*[c.alias(k) for k, c in langid.page_evidence(F.col("url"), F.col("html")).items()]).collect()
    assert (got[0]["declared"], got[0]["suffix"], got[0]["host"], got[0]["domain"]) == ("de", "at/fr", "www.beispiel.co.at", "co.at")
    assert got[0]["text"].split() == ["Text", "mehr"]
    assert (got[1]["declared"], got[1]["suffix"], got[1]["host"], got[1]["domain"]) == (None, None, "h", None)
    assert tuple(got[2]) == (None,) * 5 and got[3]["host"] is None


def test_unknown_script_and_noise_are_rejected(spark, model, odd_docs, no_docs):
    texts = ["Это совсем другой язык и другая письменность, которой модель не видела", "12 345 !!! ???", "This is the text and it is of the usual kind with the words"]
    docs = spark.createDataFrame([(i, t, None, "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    assert [r["doc_id"] for r in langid.keep_known_languages(docs, model).collect()] == [2]
    left = langid.keep_known_languages(odd_docs, model)
    assert left.columns == odd_docs.columns
    ids = {r["doc_id"] for r in left.collect()}
    assert {4, 5, 6, 7} <= ids and not {1, 2, 3} & ids
    assert langid.keep_known_languages(no_docs, model).collect() == []
    assert math.isclose(math.exp(langid.train(no_docs)[0, 0]), 1 / langid.BUCKETS, rel_tol=1e-4)


def test_very_long_text(spark, model):
    assert len(langid.trigrams("ab " * 300000)) > langid.BUCKETS
    docs = spark.createDataFrame([(1, "the and of with " * 100000, "s")], "doc_id long, text string, source string")
    assert langid.keep_known_languages(docs, model).count() == 1
