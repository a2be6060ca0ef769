import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from docgeo.llm import queries, secrets
from tests.conftest import SF001

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


EXTRA = [
    "é𝄞 token='abc' 𝄞 password : \"s3cr3t!x api_key=token: abcdefgh",
    "AKIA" + "A" * 16 + "AKIA1 AKIA12 AKIAAKIA" + "Z9" * 8,
    "deadbeef" * 3 + " 𝄞𝄞 " + "deadbeef" * 4,
    "\n".join(f"token = abcdef{i}" for i in range(900)),
    "TOKEN=tokenx:abcdefg secret=secret=secret passwd\"='a.b.c.d'",
    "token" * 300,
]


def test_base_spans_against_brute_force(spark, odd_docs):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text")).unionByName(
        spark.createDataFrame(list(enumerate(EXTRA, 10**6)), "doc_id long, text string")
    )
    got = sorted(((r["doc_id"], [tuple(x) for x in r["spans"] if x["rank"] < 3]) for r in secrets.find_secrets(docs).collect()), key=str)
    assert got == sorted(((r["doc_id"], base(r["text"])) for r in docs.collect()), key=str)


def test_query_digest(spark):
    out = {r["doc_id"]: r for r in queries.QUERIES["op9_secrets"](spark, SF001).collect()}
    for r in spark.read.parquet(f"{SF001}/documents.parquet").collect():
        spans = base(r["text"])
        listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
        got = out[r["doc_id"]]
        assert got["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [got["n_assign"], got["n_access"], got["n_hex"]] == [sum(x[3] == k for x in spans) for k in ("assign", "access", "hex")]
        assert set(filter(None, listed.split(","))) <= set(got["spans"].split(","))


def test_random_strings_are_found_and_words_are_not(spark):
    rnd = random.Random(2)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = ["the", "thing", "and", "ering", "tion", "with", "under", "standing", "national", "ist"]
    rows = []
    for i in range(60):
        rows.append((i, "key " + "".join(rnd.choice(alphabet) for _ in range(44)) + " end"))
        rows.append((100 + i, "see " + "".join(rnd.choice(words) for _ in range(9)) + " for more"))
        rows.append((200 + i, "x" * (30 + i) + " " + "-" * 40 + " " + "ab" * 20))
    out = {r["doc_id"]: [x for x in r["spans"] if x["kind"] == "random"] for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = [i for i in range(60) if [(x["start"], x["end"]) for x in out[i]] == [(4, 48)]]
    assert len(found) >= 55
    assert not any(out[i] for i in out if i >= 100)


@pytest.mark.parametrize("encoding", ["hex", "base32", "base62", "base64"])
@pytest.mark.parametrize("size", [20, 32, 40])
def test_short_random_strings_without_natural_neighbours(spark, encoding, size):
    rnd = random.Random(size)
    alphabet = secrets.ENCODINGS[encoding][1].upper() if encoding == "hex" else secrets.ENCODINGS[encoding][1]
    prose = ["the", "committee", "approved", "its", "annual", "budget", "after", "long", "debate", "and", "12", "members", "voted"]
    rows = [(i, "the key " + "".join(rnd.choice(alphabet) for _ in range(size)) + " " + " ".join(rnd.choice(prose) for _ in range(40))) for i in range(100)]
    out = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum([(x["start"], x["end"]) for x in r["spans"]] == [(8, 8 + size)] for r in out) >= 90


def test_battery_against_plain_formulas(spark):
    tokens = ["0123456789abcdef0123456789abcdef", "Zm9vYmFyYmF6cXV4Zm9vYmFyYmF6", "AAAAAAAAAAAAAAAAAAAAAAAA", "3141592653589793238462643383"]
    got = {r["token"]: r for r in secrets.battery(spark.createDataFrame([(t,) for t in tokens], "token string")).collect()}
    for t in tokens:
        r = got[t]
        _, alphabet = secrets.ENCODINGS[r["encoding"]]
        x = [alphabet.index(c) for c in (t.lower() if r["encoding"] == "hex" else t)]
        n, m = len(x), len(alphabet)
        chi2 = sum(x.count(k) ** 2 for k in range(m)) * m / n - n
        assert r["chi2"] == pytest.approx(chi2)
        high = [k * 2 >= m for k in x]
        expect = 2 * sum(high) * (n - sum(high)) / n + 1
        spread = (expect - 1) * (expect - 2) / (n - 1)
        runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
        mean = sum(x) / n
        var = sum((k - mean) ** 2 for k in x)
        z = [
            (chi2 - (m - 1)) / math.sqrt(2 * (m - 1) * (n - 1) / n),
            abs(runs - expect) / math.sqrt(spread) if spread > 0 else 40.0,
            abs(sum((a - mean) * (b - mean) for a, b in zip(x, x[1:], strict=False)) / var + 1 / n) * math.sqrt(n) if var > 0 else 40.0,
        ]
        p = [math.erfc(z[0] / math.sqrt(2)) / 2, math.erfc(z[1] / math.sqrt(2)), math.erfc(z[2] / math.sqrt(2))]
        f = -sum(math.log(max(q, 1e-300)) for q in p)
        assert r["p_random"] == pytest.approx(math.exp(-f) * (1 + f + f * f / 2), rel=1e-4, abs=1e-250)


def test_starts_over_many_matches(spark):
    df = spark.range(1).select(secrets.starts(F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda x: x * 0 + 3), F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda x: x * 0 + 2)).alias("s"))
    assert df.first()["s"] == [3 + 5 * i for i in range(1000)]


def test_empty_table_and_plan(spark, no_docs):
    assert secrets.find_secrets(no_docs).collect() == []
    plan = queries.QUERIES["op9_secrets"](spark, SF001)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
