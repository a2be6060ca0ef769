import random
import re

import duckdb
import pytest

from docgeo.llm import substrings
from docgeo.llm.queries import ORACLE_SQL, op11_substring_dedup
from tests.conftest import SF001


def brute(rows, window):
    """[(key, n_words, n_removed, kept)] in the order of the rows."""
    first, texts = {}, []
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        texts.append((key, words))
        if key is not None:
            for s in range(len(words) - window + 1):
                w = tuple(words[s : s + window])
                first[w] = min(first.get(w, key), key)
    out = []
    for key, words in texts:
        gone = set()
        for s in range(len(words) - window + 1):
            if key is not None and first[tuple(words[s : s + window])] < key:
                gone.update(range(s, s + window))
        out.append((key, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def results(df):
    return [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()]


def order(rows):
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    word = lambda n: f"w{rng.randrange(n)}"
    passages = [[word(40) for _ in range(n)] for n in (8, 12, 30, 200)]
    rows = []
    for i in range(90):
        words = [word(12 if i % 3 else 400) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            p, at = rng.choice(passages), rng.randrange(len(words) + 1)
            s = rng.randrange(len(p) // 2)
            words[at:at] = p[s : s + rng.randrange(4, len(p))]
        rows.append((rng.randrange(70), " ".join(words)))
    rows += [(200 + i, "na " * n) for i, n in enumerate((7, 9, 8, 100, 100))]  # runs of one word
    rows += [(300 + i, "da di du " * n) for i, n in enumerate((3, 30, 40))] + [(310, "x da di du da di du da di du y")]
    rows += [(400, rows[0][1]), (401, rows[0][1].replace(" ", "\n")), (401, rows[0][1]), (None, rows[0][1]), (None, None), (402, None), (403, "")]
    return rows


@pytest.mark.parametrize("window", [8, 10])
def test_against_brute_force(spark, texts, window):
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert order(results(substrings.without_repeats(df, window))) == order(brute(texts, window))


def test_long_texts_in_blocks(spark, texts, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_WORDS", 16)
    rows = texts[::2]
    found = []
    for part in (rows[:30], rows[30:]):
        listed = [substrings._words(t) for _, t in part]
        for text, start, symbols, _, _ in substrings._compressed(listed, 10):
            found += [(tuple(listed[t][s : s + 10]), x) for t, s, x in zip(text.tolist(), start.tolist(), symbols.tolist())]
    assert len(found) == sum(max(0, len(substrings._words(t)) - 9) for _, t in rows)
    assert len(set(found)) == len({w for w, _ in found})  # equal windows, equal symbols, whatever stands around them


def test_spans(spark):
    a = " ".join(f"a{i}" for i in range(20))
    df = spark.createDataFrame([(1, a), (2, f"x {a} y"), (3, "z " + a[: a.index("a12") - 1] + " z")], "doc_id long, text string")
    out = {r["doc_id"]: [tuple(s) for s in r["spans"] or []] for r in substrings.without_repeats(df, 10).collect()}
    assert out == {1: [], 2: [(1, 21)], 3: [(1, 13)]}


def test_odd_rows(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    assert order(results(substrings.without_repeats(odd_docs, 5))) == order(brute(rows, 5))


def test_empty(no_docs):
    assert results(substrings.without_repeats(no_docs)) == []


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    want = con.execute(f"SELECT doc_id, n_words, n_removed, kept_sha256 FROM ({ORACLE_SQL['op11_substring_dedup']})").fetchall()
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in op11_substring_dedup(spark, SF001).collect()]
    assert order(got) == order(want) and any(r[2] for r in got)
