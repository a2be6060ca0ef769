import base64
import hashlib

import pytest

from docgeo.llm import queries, warc
from tests.conftest import SF001

FAKE = "\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def expected(rows, least):
    last = {}
    for page, html in rows:
        if page is not None:
            last[html or ""] = max(last.get(html or "", page), page)
    out = []
    for page, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = len(data) >= least and last.get(html or "", page) != page
        out.append((page, len(data), digest, "revisit" if again else "response", last[html or ""] if again else None))
    return sorted(out, key=str)


def tricky_pages():
    rows = []
    for i in range(120):
        html = "x" * (i * 37 % 300) + FAKE * (i % 4 if i % 3 == 0 else 0)
        if i % 7 == 0:
            html += "\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 100000\r\n\r\n"
        if i % 11 == 0:
            html = "same payload \r\nWARC/1.1\r\n"
        if i % 13 == 0:
            html = None
        if i % 17 == 0:
            html = "\r\n\r\nWARC/1." + "é𝄞" * i
        rows.append((None if i % 29 == 0 else i, None if i % 5 == 0 else f"http://x/\r\nWARC/1.0 {i}", html))
    return rows + rows[:6]


@pytest.mark.parametrize(("split", "least"), [("128m", 0), ("2000", 30)])
def test_magic_in_payloads_and_splits(spark, tmpdir_path, split, least):
    rows = tricky_pages()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).selectExpr("*", "page_id as key", "url as digest", "html as body", "page_id as `of`")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        path = f"{tmpdir_path}/w"
        warc.write_archives(pages, path, least_bytes=least)
        got = warc.read_archives(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    number = lambda x: int(x[10:-1]) if x and x[10:-1] else None
    found = sorted(((number(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["type"], number(r["refers_to"])) for r in got), key=str)
    assert found == expected([(p, h) for p, _, h in rows], least)


def test_query(spark):
    rows = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()]
    got = queries.QUERIES["op8_warc"](spark, SF001)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows, 0)


def test_broken_length_ends_a_chain(spark, tmpdir_path):
    record = lambda i, size=None: f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {3 if size is None else size}\r\n\r\nabc\r\n\r\n"
    for name, text in {"a": record(1) + record(2, 1) + record(3), "b": record(4) + record(5, 900), "c": "no archive"}.items():
        with open(f"{tmpdir_path}/{name}.warc", "w", newline="") as f:
            f.write(text)
    got = {r["record_id"]: r["payload_digest"] for r in warc.read_archives(spark, tmpdir_path).collect()}
    assert set(got) == {f"<urn:page:{i}>" for i in (1, 2, 4, 5)}  # 3 follows a wrong length; 5 is cut short
    assert got["<urn:page:5>"] is None and got["<urn:page:1>"] is not None


def test_empty_table(spark, tmpdir_path):
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmpdir_path}/w")
    assert warc.read_archives(spark, f"{tmpdir_path}/w").collect() == []
