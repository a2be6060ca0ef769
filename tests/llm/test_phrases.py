import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from docgeo.llm import phrases
from docgeo.llm.queries import ORACLE_SQL, op12_collocations
from tests.conftest import SF001

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, max_words=3, min_count=10, absorb=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, max_words + 1):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        gone = set()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    q = p[i : i + m]
                    if 100 * a >= absorb * found[q]:
                        gone.add(q)
        scored = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def results(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.fixture(scope="module")
def some_docs(spark):
    words = ["The", "new", "york", "times", "of", "a", "é", "x\x01y", "|", "ß", "to", "be"]
    rows = []
    for i in range(120):
        text = " ".join(words[(i * 7 + j * j) % len(words)] + (".,\n;! ?"[j % 7] if j % 5 == i % 5 else "") for j in range(40))
        rows.append((["en", "de", None][i % 3], text + " New  York\tTimes new york new york"))
    rows += [("en", None), ("en", ""), ("fr", "nothing here"), ("en", " ".join(["la"] * 50))]
    return spark.createDataFrame(rows, "lang string, text string")


@pytest.mark.parametrize("budget", [phrases.BUDGET, 500, 20])
def test_against_brute_force(some_docs, budget):
    """Small budgets extend prefixes to two and three words and deal them to many groups."""
    rows = [(r["lang"], r["text"]) for r in some_docs.collect()]
    assert results(phrases.collocations(some_docs, budget=budget)) == brute(rows)


def test_longer_phrases_and_small_chunks(some_docs, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 64)
    monkeypatch.setattr(phrases, "SEGMENT", 100)
    rows = [(r["lang"], r["text"]) for r in some_docs.collect()]
    out = phrases.collocations(some_docs, max_words=5, min_count=4, absorb_percent=70, top=30, budget=100)
    assert results(out) == brute(rows, 5, 4, 70, 30)


def test_a_chunk_inside_a_text(monkeypatch):
    a = np.array([3, 1, 2, 0, 5, 5, 5, 0])
    first = [c.tolist() for c in phrases._following(a, 3)]
    assert first == [[3, 1, 2, 0, 5, 5, 5, 0], [1, 2, 0, 0, 5, 5, 0, 0], [2, 0, 0, 0, 5, 0, 0, 0]]


def test_sorted_runs_of_many_columns():
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 3, 500) + (1 << 40) * rng.integers(0, 2, 500) for _ in range(3)]
    weights = rng.integers(1, 9, 500)
    want = defaultdict(int)
    for *row, w in zip(*(c.tolist() for c in columns), weights.tolist()):
        want[tuple(row)] += w
    got, total = phrases.sorted_runs(columns, weights)
    assert list(zip(zip(*(c.tolist() for c in got)), total.tolist())) == sorted(want.items())


def test_large_counts(spark):
    a, left, right = 4_000_000_000_000_000, 5_000_000_000_000_000, 6_000_000_000_000_001
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(phrases._exact_score(*map(phrases.F.col, "alr"))).first()[0] == 10**6 * a * a // (left * right)


def test_odd_rows(odd_docs):
    rows = [(r["lang"], r["text"]) for r in odd_docs.select("lang", "text").collect()]
    assert results(phrases.collocations(odd_docs, min_count=2)) == brute(rows, min_count=2)


def test_empty(no_docs):
    out = phrases.collocations(no_docs)
    assert out.columns == COLUMNS and out.count() == 0


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE_SQL['op12_collocations']})").fetchall()
    assert results(op12_collocations(spark, SF001)) == sorted(want)
