"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docgeo.llm import bpe, langid, linededup, mixing, simhash
from docgeo.llm.common import table, written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Only documents in a known language stay."""
    return langid.keep_known_languages(docs, langid.train(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line of the corpus, up to two edits, go; so do documents of nothing else."""
    return linededup.drop_duplicate_lines(docs, edits=2, min_chars=16)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.drop_near_duplicates(docs, shingle=4, radius=4)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the target shares of sources, languages and topics."""
    return mixing.draw(docs, mixing.Mix())


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE ids and decoded text of every document that is left."""
    return bpe.bpe_encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", language_stage), ("lines", line_stage), ("simhash", simhash_stage), ("mixing", mixing_stage), ("bpe", bpe_stage)]

# The stages use trained models, fingerprints and a tokeniser file, which SQL cannot express: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
