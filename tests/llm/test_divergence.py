import re
from collections import Counter, defaultdict
from functools import cache

import duckdb
import pytest

from docgeo.llm import divergence
from docgeo.llm.queries import ORACLE_SQL, op13_divergence
from tests.conftest import SF001


def brute(rows, min_docs, top):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = [t.translate(lower) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        count[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in sources:
            whole.update(count[lang, s])

        @cache
        def shares(s):
            c = whole if s is None else count[lang, s]
            n = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // n for t in kept}

        for s in sources:
            p, q = shares(s), shares(None)
            pairs = [(sum((p[t] - shares(o)[t]) ** 2 // (p[t] + shares(o)[t]) for t in kept), o) for o in sources if o != s]
            words = [((p[t] - q[t]) ** 2 // (p[t] + q[t]), t) for t in kept if count[lang, s][t] and p[t] > q[t]]
            for part, scored in (("pair", pairs), ("term", words)):
                for rank, (value, item) in enumerate(sorted(scored, key=lambda x: (-x[0], x[1].encode())), 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item, value, rank))
        shares.cache_clear()
    return out


def results(df):
    rows = [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def some_docs(spark):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for i in range(160):
        text = " ".join(words[(i * i + j * (i % 7 + 1)) % (40 + 260 * (i % 3 == 0))] for j in range(60))
        rows.append((i, text + " Öl ÖL Été", ["en", "de", None][i % 3], f"s{i % 9}" if i % 11 else None))
    rows += [(900, "", "en", "quiet"), (901, None, "xx", "alone"), (902, "12 34", "yy", "a"), (903, "12", "yy", "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("bits", [64, 5])
def test_against_brute_force(some_docs, bits):
    rows = [(r["lang"], r["source"], r["text"]) for r in some_docs.collect()]
    assert results(divergence.divergence(some_docs, bits=bits)) == brute(rows, 10, 10)


def test_blocks_and_buckets(some_docs, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 2)
    monkeypatch.setattr(divergence, "BUCKET_TERMS", 7)
    monkeypatch.setattr(divergence, "ENTRIES", 50)
    rows = [(r["lang"], r["source"], r["text"]) for r in some_docs.collect()]
    assert results(divergence.divergence(some_docs, min_docs=5, top=3)) == brute(rows, 5, 3)


def test_odd_rows(odd_docs):
    rows = [(r["lang"], r["source"], r["text"]) for r in odd_docs.collect()]
    assert results(divergence.divergence(odd_docs, min_docs=1)) == brute(rows, 1, 10)


def test_empty(no_docs):
    out = divergence.divergence(no_docs)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"] and out.count() == 0


def test_large_counts(spark):
    n = 9_000_000_000_000_000
    df = spark.createDataFrame([(n, n + 7, 5)], "c long, n long, v long").select(divergence.share(*map(divergence.F.col, "cnv")).alias("p"))
    assert df.first()["p"] == 1 + 10**9 * (n + 2) // (n + 7 + 10)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    want = set(con.execute(f"SELECT lang, source, part, item, value, rank FROM ({ORACLE_SQL['op13_divergence']})").fetchall())
    assert results(op13_divergence(spark, SF001)) == want
