"""Place-name extraction: lexicon tagging, entity consolidation, tag filter, model combination, clean-up, counts.

The workflow's named-entity tagger is re-aimed as matching a per-language lexicon of names (the extraction step
is described as a whitelist comparison). A lexicon row is (lang, surface, lemma, entity_type); a surface may
span several tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgeo.functions.text import WORD_PATTERN, clean_name, newline_to_blank
from docgeo.operators.scan import candidates, longest_entry, packed_hits, prepare_lexicon, text_hits  # noqa: F401

# Entity tags the workflow keeps as places.
PLACE_TAGS = ("LOC", "GPE")

KEY = ["doc_id", "model_rank"]

# Token positions that one group of the consolidation covers.
BLOCK = 1024


def tag_entities(
    docs: DataFrame,
    languages: DataFrame,
    lexicon: DataFrame,
    max_n: int | None = None,
    pattern: str = WORD_PATTERN,
) -> DataFrame:
    """Entity candidates (doc_id, model_rank, pos, len, token, lemma, entity_type).

    Every run of tokens that the lexicon lists for a language chosen for the document (``languages``: doc_id, code,
    model_rank). Only the hits are shuffled, to meet the per-document language choice.
    """
    return candidates(packed_hits(docs, lexicon, None, max_n, pattern), languages)


def consolidate(candidates: DataFrame, max_n: int) -> DataFrame:
    """Leftmost-longest choice among overlapping candidate spans, per document and model.

    Scanning left to right, a span is kept when it starts at or after the end of the last kept span; among spans
    with one start the longest wins, then the lowest lemma and type. ``max_n``: length of the longest span.

    A document is cut into blocks of ``BLOCK`` positions, each a group of its own, so no group holds a long document. The scan of a block depends on the ones before it only by how far the last kept span reaches into it, less than
    ``max_n`` positions. Blocks with a span that sticks out (few) tell that for every reach they may meet themselves, and
    one small fold per document strings these answers together. Column expressions only.

    The answers meet the blocks by document: candidates that lie together by ``doc_id`` (those of ``scan.candidates``) are
    not shuffled again, and what comes out still lies together by ``doc_id``.
    """
    size, reach = max(BLOCK, max_n), max(1, max_n)
    rest = [c for c in candidates.columns if c not in (*KEY, "pos", "len", "lemma", "entity_type")]
    span = F.struct("pos", (-F.col("len")).alias("back"), "lemma", "entity_type", *rest)
    # never NULL: a join on it adds no filter, so that both branches below read the same shuffle
    block = F.coalesce(F.floor(F.col("pos") / size).cast("int"), F.lit(0)).alias("block")
    blocks = candidates.groupBy(*KEY, block).agg(F.sort_array(F.collect_list(span)).alias("spans"))
    spans, start = F.col("spans"), F.col("block") * F.lit(size)
    edge = start + size

    def end(s: Column) -> Column:
        return s["pos"] - s["back"]

    def last_end(begin: Column) -> Column:
        return F.aggregate(spans, begin, lambda e, s: F.when(s["pos"] >= e, end(s)).otherwise(e))

    sticks_out = blocks.where(F.array_max(F.transform(spans, end)) > edge)
    answers = F.transform(F.sequence(F.lit(0), F.lit(reach - 1)), lambda o: F.greatest(F.lit(0), last_end(start + o) - edge))
    chain = sticks_out.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("block", answers.alias("answers")))).alias("chain"))
    nothing = F.array().cast("array<struct<block:int,into:int>>")

    def string(done: Column, x: Column) -> Column:
        into = F.when(x["block"] == done["block"] + 1, done["into"]).otherwise(F.lit(0))
        out = x["answers"][into]
        return F.struct(x["block"].alias("block"), out.alias("into"), F.concat(done["all"], F.array(F.struct((x["block"] + 1).alias("block"), out.alias("into")))).alias("all"))

    strung = F.aggregate("chain", F.struct(F.lit(-2).alias("block"), F.lit(0).alias("into"), nothing.alias("all")), string)["all"]
    # of a document, and so with its rank and block beside it
    entered = chain.select("doc_id", F.struct("model_rank", strung.alias("all")).alias("x")).groupBy("doc_id").agg(F.collect_list("x").alias("entered"))

    kind = {f.name: f.dataType.simpleString() for f in candidates.schema}
    names = ["pos", "back", "lemma", "entity_type", *rest]
    none = F.array().cast("array<struct<" + ",".join(f"{c}:{kind['len' if c == 'back' else c]}" for c in names) + ">>")

    def keep(done: Column, s: Column) -> Column:
        kept = F.struct(end(s).alias("end"), F.concat(done["kept"], F.array(s)).alias("kept"))
        return F.when(s["pos"] >= done["end"], kept).otherwise(done)

    of_rank = F.filter("entered", lambda x: x["model_rank"] == F.col("model_rank"))
    into = F.aggregate(
        F.flatten(F.transform(of_rank, lambda x: x["all"])),
        F.lit(0),
        lambda done, x: F.when(x["block"] == F.col("block"), x["into"]).otherwise(done),
    )
    begin = start + F.coalesce(into, F.lit(0))
    kept = F.aggregate(spans, F.struct(begin.alias("end"), none.alias("kept")), keep)["kept"]
    out = blocks.join(entered, "doc_id", "left").select(*KEY, F.explode(kept).alias("s"))
    return out.select(*[F.col(c) if c in KEY else (-F.col("s.back")).alias("len") if c == "len" else F.col(f"s.{c}") for c in candidates.columns])


def keep_tags(mentions: DataFrame, tags: Sequence[str] = PLACE_TAGS) -> DataFrame:
    return mentions.where(F.col("entity_type").isin(list(tags)))


def combine_models(mentions: DataFrame) -> DataFrame:
    """Keep a later model's mentions only for tokens no earlier model found in that document (cumulative).

    Equals repeated anti joins against the tokens of all earlier models: a row survives iff its model_rank is
    the smallest rank that produced its token. A window holds a token of one document; mentions that lie together by
    ``doc_id`` are not shuffled for it. Rows without doc_id, token or rank drop out.
    """
    first = F.min("model_rank").over(Window.partitionBy("doc_id", "token"))
    whole = mentions.where(F.col("doc_id").isNotNull() & F.col("token").isNotNull())
    return whole.withColumn("_first", first).where(F.col("model_rank") == F.col("_first")).select(*mentions.columns)


def clean_names(mentions: DataFrame) -> DataFrame:
    """Newlines to blanks in token and lemma, underscores to blanks in lemma, trim, collapse blanks; drop names
    of one character or less."""
    return (
        mentions.withColumn("token", newline_to_blank("token"))
        .withColumn("lemma", clean_name("lemma"))
        .where(F.length("lemma") > 1)
    )


def name_frequencies(mentions: DataFrame) -> DataFrame:
    """doc_location (doc_id, location, frequency): mentions per lemma and document (partial + final aggregate)."""
    return mentions.groupBy("doc_id", F.col("lemma").alias("location")).agg(F.count(F.lit(1)).alias("frequency"))


def top_names(doc_location: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent names per document, ties by name (the ordering of the frequency table)."""
    w = Window.partitionBy("doc_id").orderBy(F.desc("frequency"), F.asc("location"))
    return doc_location.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def extract_locations(
    docs: DataFrame,
    languages: DataFrame,
    lexicon: DataFrame,
    tags: Sequence[str] = PLACE_TAGS,
    max_n: int | None = None,
) -> DataFrame:
    """Whole extraction step: tag, consolidate, keep place tags, combine models, clean, count."""
    if max_n is None:
        max_n = longest_entry(lexicon)
    mentions = consolidate(tag_entities(docs, languages, lexicon, max_n), max_n)
    return name_frequencies(clean_names(combine_models(keep_tags(mentions, tags))))
