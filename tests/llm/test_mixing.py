import numpy as np
import pytest
from pyspark.sql import functions as F

from docgeo.llm import mixing
from docgeo.llm.mixing import Mix
from tests.conftest import SF001


def raked(rows, mix, rounds=500):
    """Brute force: weights of (source, lang, topic) cells by plain iterative fitting in numpy."""
    langs = [*[n for n in mix.languages if n != "other"], "other"]
    topics = [*[n for n in mix.topics if n != "other"], "other"]
    sources = sorted({r["source"] for r in rows if r["tokens"]})
    w = np.zeros((len(sources), len(langs), len(topics)))
    for r in rows:
        if r["tokens"]:
            at = [names.index(r[c]) if r[c] in names else len(names) - 1 for c, names in (("lang", langs), ("topic", topics))]
            w[sources.index(r["source"]), at[0], at[1]] += r["tokens"]

    def target(wanted, names, found):
        own = found / found.sum()
        free = np.array([n not in wanted for n in names])
        listed = np.array([wanted.get(n, 0.0) if f > 0 else 0.0 for n, f in zip(names, found, strict=True)])
        share = np.where(free, own, 0)
        return share + listed / listed.sum() * (1 - share.sum())

    power = w.sum(axis=(1, 2)) ** mix.source_power
    goals = power / power.sum(), target(mix.languages, langs, w.sum(axis=(0, 2))), target(mix.topics, topics, w.sum(axis=(0, 1)))
    x = w / w.sum()
    for _ in range(rounds):
        for axis, goal in enumerate(goals):
            have = x.sum(axis=tuple(i for i in range(3) if i != axis))
            factor = np.divide(goal, have, out=np.zeros_like(goal), where=have > 0)
            x = x * factor.reshape([-1 if i == axis else 1 for i in range(3)])
    ratio = np.divide(x, w, out=np.zeros_like(x), where=w > 0)
    scale, budget = 0.0, mix.keep * w.sum()
    low, high = 0.0, 1e12
    for _ in range(200):
        scale = (low + high) / 2
        low, high = (scale, high) if (np.minimum(1, ratio * scale) * w).sum() < budget else (low, scale)
    return {(s, a, b): min(1.0, ratio[i, j, k] * scale) for i, s in enumerate(sources) for j, a in enumerate(langs) for k, b in enumerate(topics) if w[i, j, k]}


def test_probabilities_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    mix = Mix(tolerance=1e-10, rounds=300)
    rows = mixing.labelled(docs, [docs["doc_id"]])
    out = mixing.sample(rows, F.col("doc_id"), mix).collect()
    want = raked(out, mix)
    assert len(out) == docs.count()
    for r in out:
        key = (r["source"], r["lang"] if r["lang"] in mix.languages else "other", r["topic"])
        assert r["probability"] == pytest.approx(want[key] if r["tokens"] else 0.0, abs=1e-6)
    assert sum(r["probability"] * r["tokens"] for r in out) == pytest.approx(0.6 * sum(r["tokens"] for r in out), rel=1e-4)


def test_draw_follows_the_probabilities(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "concat_ws(' ', sequence(1, 30)) as text", "if(id % 4 = 0, 'a', 'b') as source", "if(id % 2 = 0, 'en', 'de') as lang")
    mix = Mix(languages={"en": 0.5, "de": 0.5}, topics={"prose": 1.0}, source_power=0.0, keep=0.4)
    left = mixing.draw(docs, mix)
    n = {(r["source"], r["lang"]): r["count"] for r in left.groupBy("source", "lang").count().collect()}
    # a holds a quarter of the documents, b three; half of the weight each: 800 of 1000 and 800 of 3000
    assert left.columns == docs.columns
    assert n[("a", "en")] == pytest.approx(800, abs=60) and sum(n.values()) == pytest.approx(1600, abs=120)
    assert [r["doc_id"] for r in mixing.draw(docs.repartition(7), mix).orderBy("doc_id").collect()] == [r["doc_id"] for r in left.orderBy("doc_id").collect()]


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    rows = mixing.labelled(odd_docs, [odd_docs["doc_id"]])
    out = mixing.sample(rows, F.col("doc_id"), Mix(languages={"en": 1.0})).collect()
    assert len(out) == odd_docs.count()
    assert all(r["probability"] == 0 and not r["sampled"] for r in out if not r["tokens"])
    left = mixing.draw(odd_docs, Mix(keep=1.0))
    assert left.columns == odd_docs.columns
    assert mixing.draw(no_docs, Mix()).collect() == []
    only = no_docs.sparkSession.createDataFrame([(1, "", None, None)], no_docs.schema)
    assert mixing.draw(only, Mix()).collect() == []


def test_what_the_fit_reached_is_told(spark):
    """Targets that can be met, and ones that can't: a source of one topic that both are to fill."""
    rows = [(f"s{i % 3}", "en" if i % 2 else "de", "prose" if i % 5 else "table", 10 + i % 7) for i in range(300)]
    df = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long").withColumn("id", F.monotonically_increasing_id())
    out = mixing.sample(df, F.col("id"), Mix()).select("residual", "rounds").distinct().collect()
    assert len(out) == 1 and out[0]["residual"] < Mix().tolerance and out[0]["rounds"] >= 1
    apart = spark.createDataFrame([("a", "en", "prose", 100), ("b", "de", "table", 100)], "source string, lang string, topic string, tokens long").withColumn("id", F.monotonically_increasing_id())
    bad = mixing.sample(apart, F.col("id"), Mix(languages={"en": 0.9, "de": 0.1}, topics={"prose": 0.1, "table": 0.9})).first()
    assert bad["residual"] > 0.1 and bad["rounds"] > mixing.PATIENCE
