import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from docgeo.llm import langid, linededup, mixing, simhash
from docgeo.llm.common import written
from tests.conftest import SF001
from tests.llm.test_linededup import brute as brute_lines
from tests.llm.test_simhash import brute_classes, brute_fingerprint


def test_each_stage_against_its_input(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").drop("n_chars")
    # short texts, so that the brute-force versions stay quick; a foreign one, a copy, and a repeated line
    docs = docs.withColumn("text", linededup.F.substring("text", 1, 400))
    more = [(10**6, "Это другой язык и другая письменность", "ru", "src1"), (10**6 + 1, docs.filter("doc_id = 1").first()["text"], "en", "src2")]
    docs = written(docs.unionByName(spark.createDataFrame(more, docs.schema)), "test-docs")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = written(stage(spark, docs, SF001), f"test-{name}")
        after = out.collect()
        if name == "language":
            assert out.columns == docs.columns
            kept = {r["doc_id"] for r in after}
            assert 10**6 not in kept and len(kept) >= 0.98 * (len(before) - 1)
        elif name == "lines":
            want = brute_lines([(r["doc_id"], r["text"]) for r in before], 2, 16)
            gone = {(d, i) for d, i, _, _, first in want if not first}
            texts = {}
            for r in before:
                lines = [x for i, x in enumerate(r["text"].split("\n")) if (r["doc_id"], i) not in gone]
                if len(lines) == len(r["text"].split("\n")) or "".join(lines).strip():
                    texts[r["doc_id"]] = "\n".join(lines)
            assert {r["doc_id"]: r["text"] for r in after} == texts
        elif name == "simhash":
            codes = {r["doc_id"]: (r["doc_id"], brute_fingerprint(r["text"], 4)) for r in before}
            assert {r["doc_id"] for r in after} == {d for d, c in brute_classes(codes, 4).items() if c == d}
        elif name == "mixing":
            rows = mixing.labelled(docs, [mixing.F.xxhash64("doc_id", "text").alias("row"), docs["doc_id"]])
            sampled = mixing.sample(rows, mixing.F.col("row"), mixing.Mix()).filter("sampled")
            assert {r["doc_id"] for r in after} == {r["doc_id"] for r in sampled.collect()} and out.columns == docs.columns
        else:
            library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            texts = {r["doc_id"]: r["text"] for r in before}
            for r in after:
                ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
                assert bytes(r["token_ids"]) == b"".join(i.to_bytes(4, "little") for i in ids) and r["decoded"] == texts[r["doc_id"]]
            assert len(after) == len(before)
        docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "simhash", "mixing", "bpe"]
    assert langid and simhash
