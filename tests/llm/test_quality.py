import random
import re
from collections import Counter

from pyspark.sql import functions as F

from docgeo.llm import quality as Q
from docgeo.llm.common import written
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_base_counts_against_brute_force(spark, odd_docs):
    rnd = random.Random(1)
    extra = ["a " * 30, "\n\n x\n x\nx\n", " ".join(rnd.choice("ab") for _ in range(600)), "a b c d e f g h\na b c d e f g h", "\x0b\x0cé𝄞\r\n|<>", "one\ttwo", "1 2 3 4 5 6 7 8 1 2 3 4 5 6 7 8 9"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(odd_docs.select((odd_docs["doc_id"] + 10**6).alias("doc_id"), "text")).unionByName(
        spark.createDataFrame([(2 * 10**6 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    )
    got = sorted((tuple(r) for r in Q.quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()), key=str)
    rows = [(r["doc_id"], *counts(r["text"])) for r in docs.collect()]
    want = sorted(((*r, r[1] < 20 or 100 * r[5] > 30 * r[1]) for r in rows), key=str)
    assert [r[:7] for r in got] == want
    assert not any(r[7] for r in got if r[6])


def test_cascade_keeps_what_no_rule_rejects(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = Q.quality(docs)
    one_by_one = written(Q.base_counts(docs.select("doc_id", "text")), "test-counts")
    rejected = F.lit(False)
    for rule in Q.default_rules():
        rejected = rejected | rule.rejects
    want = {r["doc_id"] for r in one_by_one.filter(~Q.base_failed() & ~rejected).select("doc_id").collect()}
    assert {r["doc_id"] for r in out.filter("kept").collect()} == want
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = out.join(labels, "doc_id").filter("quality = 1 and not base_failed")
    assert good.filter("not kept").count() == 0  # clean documents are left alone
    bad = out.join(labels, "doc_id").filter("quality = 0")
    assert bad.filter("not kept").count() > 0.9 * bad.count()


def test_order_is_by_rejections_per_second(spark, monkeypatch):
    sample = spark.range(100).selectExpr("id", "cast(id as string) as text")
    rules = [Q.Rule("none", F.lit(False)), Q.Rule("most", F.col("id") < 90), Q.Rule("some", F.col("id") < 10)]
    clock = iter(range(10**6))
    monkeypatch.setattr(Q.time, "perf_counter", lambda: next(clock) * 1.0)  # all jobs take equally long
    assert [r.name for r in Q.cascade_order(sample, rules)] == ["most", "some", "none"]


def test_words_in_runs_count_each(spark):
    """A long run of one word weighs as many words as it has."""
    rule = next(r for r in Q.default_rules() if r.name == "word_runs")
    other = " ".join(f"w{i}" for i in range(400))
    texts = ["la " * 100 + other, "la " * 70 + other, "so so " + other, "a a a b b b c c c x y", ("la " * 100_000) + other]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    df = df.withColumn("n_words", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")).withColumn("word_chars", F.lit(0))
    assert [r["x"] for r in df.orderBy("id").select(rule.rejects.alias("x")).collect()] == [True, False, False, True, True]


def test_empty_table(no_docs):
    assert Q.quality(no_docs).collect() == []


def test_no_python_in_the_plan(spark):
    plan = Q.quality(spark.read.parquet(f"{SF001}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
