import re

import numpy as np
import pytest
import xxhash

from docgeo.llm import simhash
from docgeo.llm.components import components


def brute_fingerprint(text, k):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(codes, radius):
    """codes: {row: (key, fingerprint)} -> {row: smallest key reachable}."""
    rows = list(codes)
    label = {r: r for r in rows}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(rows):
        for b in rows[:i]:
            if bin(codes[a][1] ^ codes[b][1]).count("1") <= radius:
                label[root(a)] = root(b)
    least = {}
    for r in rows:
        if codes[r][0] is not None:
            least[root(r)] = min(least.get(root(r), codes[r][0]), codes[r][0])
    return {r: least.get(root(r)) for r in rows}


@pytest.mark.parametrize(("shard", "blocks"), [(8192, None), (5, None), (8192, 7)])
def test_components_of_fingerprints(spark, monkeypatch, shard, blocks):
    monkeypatch.setattr(simhash, "SHARD", shard)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 40)
    monkeypatch.setattr(simhash, "FRONTIER", 16)
    rng = np.random.default_rng(1)
    codes = []
    for _ in range(12):
        code = int(rng.integers(0, 2**63))
        for _ in range(8):  # chains: each a few bits from the one before
            codes.append(code)
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                code ^= 1 << int(bit)
    codes += [0, 1, 2**63, 2**64 - 1]
    codes = list(dict.fromkeys(c % 2**64 for c in codes))
    fps = spark.createDataFrame([(int(np.uint64(c).view(np.int64)),) for c in codes], "fp long")
    linked = {r["node"]: r["root"] for r in components(simhash.fingerprint_links(fps, 4, blocks), "a", "b").collect()}
    signed = {c: int(np.uint64(c).view(np.int64)) for c in codes}
    want = brute_classes({c: (signed[c], c) for c in codes}, 4)
    assert {c: linked.get(signed[c], signed[c]) for c in codes} == want


def test_documents_against_brute_force(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(
        odd_docs.select((odd_docs["doc_id"] + 10**6).alias("doc_id"), "text")
    )
    texts = docs.collect()
    codes = {i: (r["doc_id"], brute_fingerprint(r["text"], 4)) for i, r in enumerate(texts)}
    want = brute_classes(codes, 4)
    got = sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.simhash_classes(docs).collect()), key=str)
    assert got == sorted(((codes[i][0], codes[i][1], want[i]) for i in codes), key=str)


def test_one_of_each_group_stays(spark, odd_docs, no_docs):
    left = simhash.drop_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    # 1, 2 and 3 have no words; 4 (two rows) and 5 are copies; 6 and 7 differ in a word; rows without key stay
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(["1", "4", "4", "6", "8", "9", "None", "None"])
    assert simhash.drop_near_duplicates(no_docs).collect() == []
    assert simhash.simhash_classes(no_docs).collect() == []


def test_long_path_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    assert {r["node"]: r["root"] for r in components(edges, "a", "b").collect()} == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500}
