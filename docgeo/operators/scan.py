"""One scan of the texts for everything that is looked up in them: language profile words and lexicon names.

A text is tokenised once. Profile words are counted in the row of their text. Its token runs meet a filter of bounded
size, a few bits per name; only runs that pass it (all names, and others by chance) leave
their task to meet the lexicon itself, and only runs of a length that occurs are built.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgeo.functions.text import WORD_PATTERN, tokens

# Bits of the filter of names: a megabyte, or as many as MOST times that if there are more names than so many bits to each.
# Yet more names make it let through more that is none; nothing is ever missed.
FILTER_BITS = 1 << 23
NAME_BITS = 32
MOST = 4
# A name sets so many bits of one number of the filter: a run that is none seldom finds them all set.
PLACES = 3

FOUND = "array<struct<code:string,n:bigint,pos:int,len:int,gram:string>>"
HIT_COLUMNS = ["doc_id", "code", "n", "lang", "pos", "len", "token", "lemma", "entity_type"]


def prepare_lexicon(lexicon: DataFrame, pattern: str = WORD_PATTERN) -> DataFrame:
    """Lexicon keyed the way the tagger sees text: surface re-tokenised and joined by one blank."""
    toks = tokens("surface", pattern)
    return lexicon.select(
        "lang",
        F.array_join(toks, " ").alias("gram"),
        F.size(toks).alias("len"),
        F.element_at(toks, 1).alias("first"),
        "lemma",
        "entity_type",
    ).where(F.col("len") > 0)


def longest_entry(lexicon: DataFrame, pattern: str = WORD_PATTERN) -> int:
    """Number of tokens of the longest lexicon surface (one small job)."""
    row = prepare_lexicon(lexicon, pattern).agg(F.max("len")).first()
    return int(row[0] or 1)


def filter_bits(names: int) -> int:
    """Bits of the filter for so many names: a power of two between ``FILTER_BITS`` and ``MOST`` times that."""
    bits = FILTER_BITS
    while bits < min(names * NAME_BITS, FILTER_BITS * MOST):
        bits *= 2
    return bits


def _at(key: Column, n_bits: int) -> Column:
    return F.pmod(key, F.lit(n_bits // 64))


def _mask(key: Column) -> Column:
    """The bits that a key sets in its number, from those bits of the key that ``_at`` leaves."""
    places = [F.shiftrightunsigned(key, 40 + 6 * i) % 64 for i in range(PLACES)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("long"), p.cast("int")) for p in places])


def name_filter(prepared: DataFrame, n_bits: int) -> DataFrame:
    """One row with ``bits``, an array of ``n_bits`` / 64 numbers: bits are set for the hash of every name, and for that of
    its first token and length, so that runs that cannot be a name are not even built."""
    keys = prepared.select(F.explode(F.array(F.xxhash64("gram"), F.xxhash64("first", "len"))).alias("key"))
    words = keys.select(_at(F.col("key"), n_bits).alias("at"), _mask(F.col("key")).alias("bits"))
    empty = prepared.sparkSession.range(n_bits // 64).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("bits"))
    full = empty.unionByName(words).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    return full.agg(F.array_sort(F.collect_list(F.struct("at", "bits"))).alias("a")).select(F.col("a.bits").alias("bits"))


def _gram(n: int) -> Column:
    """The ``n`` tokens from here on, joined by blanks; NULL where the text has fewer."""
    if n == 1:
        return F.col("z.t0")
    return F.concat(F.col("z.t0"), *[c for k in range(1, n) for c in (F.lit(" "), F.col(f"z.t{k}"))])


def _profile_tokens(profile: DataFrame) -> dict[str, list[str]]:
    """Words by language; the profile is short by nature (some dozens of words a language)."""
    words: dict[str, list[str]] = {}
    for r in profile.select("lang", "word").where("lang is not null and word is not null").distinct().collect():
        words.setdefault(r["lang"], []).append(r["word"])
    return words


def _counted(toks: Column, words: dict[str, list[str]]) -> Column:
    """Rows of ``text_hits`` with the counts of a text, from its tokens in lower case that any language lists."""

    def number(listed: list[str]) -> Column:
        return F.size(F.filter(toks, lambda t: t.isin(listed))).cast("long")

    nothing = F.lit(None).cast("int")
    # counts have no name: a key that no name has (it starts with a blank) spreads such rows over a join's tasks
    key = F.concat(F.lit(" "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = [F.struct(F.lit(c).alias("code"), number(words[c]).alias("n"), nothing.alias("pos"), nothing.alias("len"), key.alias("gram")) for c in sorted(words)]
    return F.filter(F.array(*rows), lambda r: r["n"] > 0)


def token_windows(docs: DataFrame, max_n: int, pattern: str = WORD_PATTERN, words: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc_id, counted, pos, z): one row per token with the ``max_n`` tokens from there on as z.t0, z.t1, ..., and the
    profile words of the whole text in ``counted`` (``_counted``).

    The token array is zipped with its shifted copies and exploded; rows stay in the scan's partitions.
    """
    toks, words = F.col("toks"), words or {}
    shifted = [F.slice(toks, k + 1, F.greatest(F.size(toks) - k, F.lit(0))).alias(f"t{k}") for k in range(max_n)]
    listed = sorted({w for some in words.values() for w in some})
    low = F.transform(F.filter(toks, lambda t: F.lower(t).isin(listed)), F.lower) if words else toks
    counted = _counted(F.col("low"), words) if words else F.array().cast(FOUND)
    z = docs.select("doc_id", tokens("text", pattern).alias("toks")).select("doc_id", "toks", low.alias("low"))
    z = z.select("doc_id", counted.alias("counted"), *shifted)
    return z.select("doc_id", "counted", F.posexplode(F.arrays_zip(*[F.col(f"t{k}") for k in range(max_n)])).alias("pos", "z"))


def packed_hits(
    docs: DataFrame,
    lexicon: DataFrame,
    profile: DataFrame | None = None,
    max_n: int | None = None,
    pattern: str = WORD_PATTERN,
) -> DataFrame:
    """``text_hits`` with one row per run of tokens that is a name, whatever the number of languages that list it: these are in
    ``listed``, [(lang, lemma, entity_type)]. As names are shuffled so, what travels grows with the texts, not with the lexicon."""
    if max_n is None:
        max_n = longest_entry(lexicon, pattern)
    lex = prepare_lexicon(lexicon, pattern)
    n_bits = filter_bits(lex.select("gram").distinct().count())
    bits = name_filter(lex, n_bits).scalar()
    windows = token_windows(docs, max_n, pattern, None if profile is None else _profile_tokens(profile))

    def may_be(*values: Column) -> Column:
        key = F.xxhash64(*values)
        return F.get(bits, _at(key, n_bits).cast("int")).bitwiseAND(_mask(key)) == _mask(key)

    def passes(n: int) -> Column:
        return may_be(_gram(1)) if n == 1 else F.col(f"z.t{n - 1}").isNotNull() & may_be(F.col("z.t0"), F.lit(n)) & may_be(_gram(n))

    def run(n: int) -> Column:
        return F.when(passes(n), F.struct(F.lit(None).cast("string").alias("code"), F.lit(1).cast("long").alias("n"), "pos", F.lit(n).alias("len"), _gram(n).alias("gram")))

    first = (F.col("pos") == 0) & (F.size("counted") > 0)
    anything, rows = first, F.array(*[run(n) for n in range(1, max_n + 1)])
    for n in range(1, max_n + 1):
        anything = anything | passes(n)
    if profile is not None:
        rows = F.concat(rows, F.when(first, F.col("counted")).otherwise(F.array().cast(FOUND)))
    found = windows.where(anything).select("doc_id", F.explode(rows).alias("x")).where(F.col("x").isNotNull()).select("doc_id", "x.*")
    one = F.struct("lang", "lemma", "entity_type")
    named = (lex if profile is None else lex.where(F.col("lang").isNotNull())).groupBy("gram", "len").agg(F.sort_array(F.collect_list(one)).alias("listed"))
    if profile is None:
        hits = found.join(named, ["gram", "len"])
    else:
        hits = found.join(named, ["gram", "len"], "left").where(F.col("code").isNotNull() | F.col("listed").isNotNull())
        # rows of one name lie together after the join: equal ones (of a document that is there twice, say) are put together there
        hits = hits.withColumn("listed", F.array_distinct("listed")).groupBy("doc_id", "code", "pos", "len", "gram", "listed").agg(F.sum("n").alias("n"))
    return hits.select("doc_id", "code", "n", "pos", "len", F.when(F.col("code").isNull(), F.col("gram")).alias("token"), "listed")


def unpacked(hits: DataFrame) -> DataFrame:
    """The rows of ``packed_hits`` by language (``HIT_COLUMNS``)."""
    rest = [c for c in hits.columns if c != "listed"]
    return hits.select(*rest, F.explode_outer("listed").alias("x")).select(*rest, "x.*").select(*HIT_COLUMNS)


def text_hits(
    docs: DataFrame,
    lexicon: DataFrame,
    profile: DataFrame | None = None,
    max_n: int | None = None,
    pattern: str = WORD_PATTERN,
) -> DataFrame:
    """What the texts hold (``HIT_COLUMNS``), from a single scan of them:

    * lexicon hits: every run of tokens that is a name, for every language that lists it (``code`` is NULL);
    * with a ``profile``, per document and language ``code`` the number ``n`` of tokens that are profile words.

    Of a text, nothing but its counts and the runs that pass the filter of names is shuffled. A text without hits, an empty
    or a NULL one has no row.
    """
    return unpacked(packed_hits(docs, lexicon, profile, max_n, pattern))


def profile_counts(hits: DataFrame) -> DataFrame:
    """(doc_id, code, n) of ``text_hits``."""
    return hits.where(F.col("code").isNotNull()).select("doc_id", "code", "n")


def candidates(hits: DataFrame, languages: DataFrame) -> DataFrame:
    """Entity candidates (doc_id, model_rank, pos, len, token, lemma, entity_type): the lexicon hits, packed or not, in the
    languages chosen for their document (``languages``: doc_id, code, model_rank). Packed hits are always dealt by ``doc_id``,
    whatever the size of the table of languages: all that follows, up to the names of a document, needs no other shuffle."""
    chosen = languages.select("doc_id", F.col("code").alias("lang"), "model_rank")
    named = hits.where(F.col("code").isNull()).drop("code", "n")
    if "listed" in hits.columns:
        # a row for each of the document's languages, and what that language lists
        named = named.join(chosen.hint("merge"), "doc_id").select("*", F.explode(F.filter("listed", lambda x: x["lang"] == F.col("lang"))).alias("x"))
        return named.select("doc_id", "model_rank", "pos", "len", "token", "x.lemma", "x.entity_type")
    return named.join(chosen, ["doc_id", "lang"]).select("doc_id", "model_rank", "pos", "len", "token", "lemma", "entity_type")
