import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docgeo.llm import bpe, queries
from docgeo.llm.bpe import PairIndexBpe
from tests.conftest import SF001

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as f:
        return PairIndexBpe(f.read())


def packed(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def test_every_character_as_the_library(library, own):
    for low in range(0, 0x30000, 0x4000):
        texts = [f"a{chr(c)}b {chr(c)} {chr(c) * 2}x\n{chr(c)} 1{chr(c)}" for c in range(low, low + 0x4000) if not 0xD800 <= c < 0xE000]
        assert own.encode(texts) == [packed(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("few", [1, 10**9])
def test_merges_as_the_library(library, own, monkeypatch, few):
    monkeypatch.setattr(bpe, "VECTOR_FROM", few)  # all pairs at once, or one position at a time
    own.number.clear(), own.packed.clear()
    texts = ["", "aaaaaaaaaaaaaaa aaaa", " \n\n  it's we'll I'd", "<|endoftext|>x<|endoftext|>", "abcabcabcab" * 50, "lowercaseUPPERCASE" * 20, " " * 70, "é" * 400]
    got = own.encode(texts)
    assert got == [packed(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [own.decode(g) for g in got] == texts


def test_query_against_the_library(spark, library):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op5_bpe"](spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        r = rows[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    out = bpe.bpe_encode_decode(odd_docs, PATH).collect()
    assert sorted((r["decoded"] for r in out)) == sorted((r["text"] or "") for r in odd_docs.select("text").collect())
    assert bpe.bpe_encode_decode(no_docs, PATH).collect() == []
