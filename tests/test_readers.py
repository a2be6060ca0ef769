"""Folder readers: ids without collisions, one bad file fails alone, quarantine."""

import os

import pytest
from pyspark.sql import functions as F

from docgeo.sources import corpus


@pytest.fixture()
def folder(tmpdir_path):
    for i in range(12):
        os.makedirs(f"{tmpdir_path}/in/d{i % 2}", exist_ok=True)
        with open(f"{tmpdir_path}/in/d{i % 2}/f{i}.bin", "wb") as f:
            f.write(b"\xff\xfe" if i == 3 else b"" if i == 4 else f"text {i}".encode() * (100 if i == 5 else 1))  # f4: Spark's file sources skip files of no bytes
    return f"{tmpdir_path}/in"


def extractor():
    """Made here, so that it travels to the workers by value."""

    def read(content):
        if content == b"text 7":
            return None
        if content == b"text 8":
            raise KeyError("page tree")
        return content.decode("utf-8")

    return read


def test_one_bad_file_fails_alone(spark, folder):
    found = {r["file_name"]: r for r in corpus.extract_files(spark, f"{folder}/*", extractor(), max_bytes=300).collect()}
    assert len(found) == 11 and len({r["doc_id"] for r in found.values()}) == 11 and "f4.bin" not in found
    status = {name: r["status"] for name, r in found.items()}
    assert {n for n, s in status.items() if s == "failed"} == {"f3.bin", "f7.bin", "f8.bin"}
    assert {n for n, s in status.items() if s == "too large"} == {"f5.bin"}
    assert found["f8.bin"]["error"].startswith("KeyError") and "NoneType" in found["f7.bin"]["error"] and found["f8.bin"]["text"] is None
    assert found["f0.bin"]["text"] == "text 0" and found["f0.bin"]["error"] is None


def test_quarantine(spark, folder, tmpdir_path):
    out = corpus.read_binary_files(spark, f"{folder}/*", extractor(), glob="f[0-8].bin", quarantine=f"{tmpdir_path}/bad")
    assert out.columns == ["doc_id", "file_name", "text"]
    assert sorted(r["file_name"] for r in out.collect()) == [f"f{i}.bin" for i in (0, 1, 2, 5, 6)]
    assert sorted(r["file_name"] for r in spark.read.parquet(f"{tmpdir_path}/bad").collect()) == ["f3.bin", "f7.bin", "f8.bin"]


def test_readers_agree_on_ids(spark, folder):
    text = {r["file_name"]: r["doc_id"] for r in corpus.read_text_files(spark, f"{folder}/*").collect()}
    assert len(text) == 11 and len(set(text.values())) == 11 and min(text.values()) >= 0
    prefixed = corpus.read_text_files(spark, f"{folder}/*", prefix=f"file:{folder}").collect()
    assert {r["file_name"] for r in prefixed} == {f"d{i % 2}/f{i}.bin" for i in range(12) if i != 4}
    binary = corpus.read_binary_files(spark, f"{folder}/*", lambda b: b.decode("latin-1"))
    assert {r["file_name"] for r in binary.collect()} == set(text)


def narrow(path, attempt):
    """Three ids in the first attempt, then a few more."""
    return F.pmod(F.xxhash64(path, F.lit(attempt)), F.lit(3 + 40 * attempt))


def test_no_two_paths_share_an_id(spark):
    paths = spark.createDataFrame([(f"p{i}",) for i in range(50)] + [("p1",)], "path string")
    out = corpus.with_ids(paths.distinct(), paths, None, id_of=narrow).collect()
    assert len(out) == 50 and len({r["doc_id"] for r in out}) == 50
    again = corpus.with_ids(paths.distinct().repartition(7), paths, None, id_of=narrow).collect()
    assert {(r["file_name"], r["doc_id"]) for r in again} == {(r["file_name"], r["doc_id"]) for r in out}


def test_known_ids_stay(spark):
    first = spark.createDataFrame([(f"p{i}",) for i in range(20, 40)], "path string")
    ids = {r["file_name"]: r["doc_id"] for r in corpus.with_ids(first, first, None, id_of=narrow).collect()}
    known = spark.createDataFrame(list(ids.items()), "path string, doc_id long")
    later = spark.createDataFrame([(f"p{i}",) for i in range(45)], "path string")
    out = {r["file_name"]: r["doc_id"] for r in corpus.with_ids(later, later, None, known, id_of=narrow).collect()}
    assert len(set(out.values())) == 45 and all(out[p] == n for p, n in ids.items())


def test_a_table_of_one_split_is_dealt_out(spark, tmpdir_path):
    spark.range(1000).coalesce(1).write.parquet(f"{tmpdir_path}/one")
    one = spark.read.parquet(f"{tmpdir_path}/one")
    dealt = corpus.dealt_out(one)
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and dealt.count() == 1000
    many = spark.range(0, 10000, 1, 64)
    assert corpus.dealt_out(many) is many
