"""Language detection (mixed languages per document) and the choice of lexicons ("models") per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docgeo.functions.text import tokens

# Fixed values of the workflow: threshold for using a further language model, default language.
THRESHOLD = 0.3
DEFAULT_LANGUAGE = "de"


def count_profile_words(docs: DataFrame, profile: DataFrame) -> DataFrame:
    """(doc_id, code, n): tokens of a document, in lower case, that the profile lists for a language.

    Counting happens per document partition (partial aggregate) before anything is shuffled, so a very long document
    or a very common word does not skew the shuffle. ``scan.text_hits`` counts the same along with the lexicon hits.
    """
    words = docs.select("doc_id", F.explode(tokens("text")).alias("token")).select("doc_id", F.lower("token").alias("word"))
    listed = F.broadcast(profile.select("word", F.col("lang").alias("code")).distinct())
    return words.join(listed, "word").groupBy("doc_id", "code").agg(F.count(F.lit(1)).alias("n"))


def proportions(counts: DataFrame) -> DataFrame:
    """(doc_id, code, proportion, rank) from (doc_id, code, n): at most one row per profile language and document."""
    w = Window.partitionBy("doc_id")
    ranked = Window.partitionBy("doc_id").orderBy(F.desc("proportion"), F.asc("code"))
    return (
        counts.withColumn("proportion", F.col("n") / F.sum("n").over(w))
        .withColumn("rank", F.row_number().over(ranked))
        .select("doc_id", "code", "proportion", "rank")
    )


def detect_languages(docs: DataFrame, profile: DataFrame) -> DataFrame:
    """(doc_id, code, proportion, rank): share of each language among a document's profile-word hits.

    Tokens are letter runs in lower case; each token counts once for every language whose profile lists it. Documents
    without a hit get no rows.
    """
    return proportions(count_profile_words(docs, profile))


def relevant_languages(
    docs: DataFrame,
    doc_language: DataFrame,
    supported: Sequence[str] | DataFrame,
    threshold: float = THRESHOLD,
    default: str = DEFAULT_LANGUAGE,
) -> DataFrame:
    """(doc_id, code, model_rank): languages with ``proportion >= threshold`` that have a lexicon, by proportion
    (then code); a document where none qualifies gets ``default`` with rank 1."""
    if isinstance(supported, DataFrame):
        sup = supported.select(F.col(supported.columns[0]).alias("code")).distinct()
        kept = doc_language.where(F.col("proportion") >= threshold).join(F.broadcast(sup), "code", "left_semi")
    else:
        kept = doc_language.where((F.col("proportion") >= threshold) & F.col("code").isin(list(supported)))
    ranked = kept.withColumn(
        "model_rank",
        F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("proportion"), F.asc("code"))),
    ).select("doc_id", "code", "model_rank")
    # one left join from the document ids (a two-column scan) fills in the default: detection runs once
    return docs.select("doc_id").join(ranked, "doc_id", "left").select(
        "doc_id",
        F.coalesce(F.col("code"), F.lit(default)).alias("code"),
        F.coalesce(F.col("model_rank"), F.lit(1)).alias("model_rank"),
    )


def given_language(docs: DataFrame, code: str | None = None, column: str = "lang") -> DataFrame:
    """Single language per document: the literal ``code`` or the document's own ``column``; rank 1."""
    lang = F.lit(code) if code is not None else F.col(column)
    return docs.select("doc_id", lang.alias("code"), F.lit(1).alias("model_rank"))
