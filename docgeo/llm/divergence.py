"""Source divergence audit with late string materialization.

Terms are counted as fixed-width digests: what is shuffled and joined is a 64-bit number, never a term. Of each digest that
occurs often enough to matter the smallest and the largest term are compared; where they differ, several terms share the
digest, and only those are counted again by their text and split. Texts are joined back to the few rows that are reported.

The divergence of two sources sums over all kept terms of their language. Terms that neither holds all add the same amount,
so a cell of the work holds a bounded block of sources and a bounded bucket of the terms that occur in it.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgeo.llm.common import map_arrow, slices, written
from docgeo.session import ship_package

SEED = 42
UNIT = 1_000_000_000  # shares are counted in billionths

# Distinct (group, term) entries that a worker adds up before it sends them on.
ENTRIES = 1 << 19

# Sources in a block and expected terms in a bucket: a cell holds at most two blocks of sources for one bucket.
BLOCK_SOURCES = 64
BUCKET_TERMS = 4096

_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Runs of ASCII letters and non-ASCII characters as UTF-8, A-Z lower-cased."""
    return text.encode().translate(_TERM_BYTES).split()


def digest(term: bytes, bits: int = 64) -> int:
    return xxhash.xxh64_intdigest(term, SEED) & ((1 << bits) - 1)


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], list[int], list[int]]]:
    """Of rows ``group, text``: terms of each group, their occurrences and documents, a bounded number at a time."""
    count, docs = defaultdict(Counter), defaultdict(Counter)
    size = 0
    for batch in batches:
        for part in slices(batch, "text"):
            for group, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                found = terms(text)
                size -= len(count[group])
                count[group].update(found)
                docs[group].update(set(found))
                size += len(count[group])
                if size >= ENTRIES:
                    yield from ((g, list(c), list(c.values()), [docs[g][t] for t in c]) for g, c in count.items())
                    count.clear()
                    docs.clear()
                    size = 0
    yield from ((g, list(c), list(c.values()), [docs[g][t] for t in c]) for g, c in count.items())


def _digest_counts(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, found, count, docs in _counted(batches):
            columns = [pa.array(np.full(len(found), group)), _signed([digest(t, bits) for t in found]), pa.array(count, pa.int64()), pa.array(docs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["group", "digest", "count", "docs"])

    return run


def _term_counts(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, found, count, docs in _counted(batches):
            columns = [pa.array(np.full(len(found), group)), _signed([digest(t, bits) for t in found]), pa.array([t.decode() for t in found], pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(count, pa.int64()), pa.array(docs, pa.int64())], names=["group", "digest", "term", "count", "docs"])

    return run


def numbered_groups(rows: DataFrame) -> tuple[DataFrame, Column]:
    """(lang, source, group) of all groups, and the expression of ``group``: a hash that no two groups share."""
    found = written(rows.select("lang", "source").distinct(), "divergence-named")
    for seed in range(100):
        group = F.xxhash64("lang", "source", F.lit(seed))
        n, apart = found.agg(F.count("*"), F.count_distinct(group)).first()
        if n == apart:
            return found.withColumn("group", group), group
    raise RuntimeError("no seed tells the groups apart")


def _distinct_terms(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``digest, term``: each distinct term of some texts once."""
        seen: set[bytes] = set()

        def out() -> pa.RecordBatch:
            found = list(seen)
            return pa.RecordBatch.from_arrays([_signed([digest(t, bits) for t in found]), pa.array([t.decode() for t in found], pa.string())], names=["digest", "term"])

        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column(0).to_pylist():
                    seen.update(terms(text))
                    if len(seen) >= ENTRIES:
                        yield out()
                        seen.clear()
        yield out()

    return run


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (n + 2 v)), exactly: the product may pass 64 bits."""
    wide = (count + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    total = (n + 2 * v).cast("decimal(20,0)")
    return (F.lit(1) + F.call_function("div", wide, total)).cast("long")


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q))."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def block_gaps(p: np.ndarray, base: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each source i of ``left`` those of ``right`` that it meets, and the sums of their gaps over the terms (rows of ``p``),
    each less the gap of two sources without the term (``base``: their shares)."""
    for i in left.tolist():
        js = right[right > i] if i in right else right
        if len(js):
            d = p[:, [i]] - p[:, js]
            d0 = base[i] - base[js]
            s0 = np.maximum(base[i] + base[js], 1)
            yield i, js, (d * d // (p[:, [i]] + p[:, js])).sum(axis=0) - len(p) * (d0 * d0 // s0)


def _cell(key, rows: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums of gaps of the cell's pairs of sources over the terms of its bucket; bucket 0 adds what all kept terms add at least."""
    lang, low, high, bucket = (k.as_py() for k in key)
    names = groups["source"].to_pylist()
    n, v, block = (np.asarray(groups[c].to_numpy(), dtype=np.int64) for c in ("n", "v", "own"))
    base = np.array([1 + UNIT * 2 // (int(a) + 2 * int(b)) if a + 2 * b else 0 for a, b in zip(n, v, strict=True)], dtype=np.int64)
    at = {s: i for i, s in enumerate(names)}
    ids, where = np.unique(rows["term"].to_numpy(), return_inverse=True) if len(rows) else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    p = np.tile(base, (len(ids), 1))
    if len(rows):
        p[where, np.array([at[s] for s in rows["source"].to_pylist()], dtype=np.int64)] = rows["p"].to_numpy()
    everyone = np.arange(len(names))
    left, right = (everyone[block == low], everyone[block == high]) if low != high else (everyone, everyone)
    source, item, value = [], [], []
    for i, js, sums in block_gaps(p, base, left, right):
        if bucket == 0:
            d0 = base[i] - base[js]
            sums = sums + v[i] * (d0 * d0 // np.maximum(base[i] + base[js], 1))
        source += [names[i]] * len(js) + [names[j] for j in js.tolist()]
        item += [names[j] for j in js.tolist()] + [names[i]] * len(js)
        value += sums.tolist() * 2
    types = {"lang": pa.string(), "source": pa.string(), "item": pa.string(), "value": pa.int64()}
    return pa.table([pa.array(c, t) for c, t in zip(([lang] * len(source), source, item, value), types.values(), strict=True)], names=list(types))


def source_pairs(per: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for each two sources of a language, both ways.

    ``per``: lang, source, term, p of the terms that a source holds; ``groups``: lang, source, n, v of all sources. Sources are
    dealt to blocks and terms to buckets, so a cell (two blocks, one bucket) is bounded however many there are of either.
    """
    blocks = groups.groupBy("lang").agg(F.ceil(F.count("*") / BLOCK_SOURCES).cast("int").alias("blocks"), F.greatest(F.lit(1), F.ceil(F.max("v") / BUCKET_TERMS)).cast("int").alias("buckets"))

    def dealt(df: DataFrame) -> DataFrame:
        df = df.join(blocks, "lang").withColumn("own", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
        df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return df.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    cell = ["lang", "low", "high", "bucket"]
    rows = dealt(per).withColumn("bucket", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int")).select(*cell, "source", "term", "p")
    every = dealt(groups).withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1))).select(*cell, "source", "n", "v", "own")
    found = rows.groupBy(*cell).cogroup(every.groupBy(*cell)).applyInArrow(_cell, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, min_docs: int = 10, top: int = 10, bits: int = 64, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source of a language differs from the others and from the language.

    A term is kept in a language if ``min_docs`` of its rows hold it. A group (lang, source) gives a kept term the share
    1 + floor(10^9 (count + 2) / (N + 2 V)) of its N occurrences of the V kept terms; the gap of two shares is
    floor((p - q)^2 / (p + q)). Part ``pair``: each other source of the language, by the sum of gaps over all kept terms.
    Part ``term``: the ``top`` terms that the group holds and gives a larger share than its language, by their gap. Ranks go
    by falling value, ties by the item's bytes.

    Null language, source and text are empty strings; a group without terms still has its pairs (value 0 if its language
    keeps no term). Repeated rows count each time. Texts of any length are read whole. An empty table has no rows, other
    columns are not read. ``bits``: width of the digests; fewer only mean that more terms share one and are split.
    """
    spark = docs.sparkSession
    ship_package(spark)
    none = F.lit("")
    clean = [F.coalesce(docs[c].cast("string"), none).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    rows = docs.select(*clean)
    named, group = numbered_groups(rows)
    texts = rows.select(group.alias("group"), "text")
    key = ["group", "digest"]
    sums = [F.sum("count").alias("count"), F.sum("docs").alias("docs")]
    counts = written(map_arrow(texts, _digest_counts(bits), "group long, digest long, count long, docs long").groupBy(*key).agg(*sums), "divergence-counts")
    lang_of = named.select("group", "lang")
    often = counts.join(lang_of, "group").groupBy("lang", "digest").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
    often = written(often.select("digest").distinct(), "divergence-often")
    # one row per task and distinct term, of which only those that matter go on to be compared
    spelled = map_arrow(rows.select("text"), _distinct_terms(bits), "digest long, term string").join(often, "digest", "left_semi")
    names = written(spelled.groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")), "divergence-names")
    shared = names.filter(F.col("low") != F.col("high")).select("digest")
    counts = counts.join(often, "digest", "left_semi").withColumn("split", none)
    if not shared.isEmpty():
        again = map_arrow(texts, _term_counts(bits), "group long, digest long, term string, count long, docs long").join(shared, "digest", "left_semi")
        again = again.groupBy(*key, F.col("term").alias("split")).agg(*sums)
        counts = counts.join(shared, "digest", "left_anti").unionByName(again)
    counts = written(counts.join(named, "group").drop("group"), "divergence-kept-counts")
    term = ["lang", "digest", "split"]
    kept = counts.groupBy(*term).agg(F.sum("count").alias("total"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
    kept = written(kept.withColumn("term", F.monotonically_increasing_id()), "divergence-kept")
    per = written(counts.join(kept.select(*term, "term", "total"), term).select("lang", "source", "term", "count", "total"), "divergence-per")

    of_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    of_group = per.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    zero = F.lit(0).cast("long")
    groups = named.select("lang", "source").join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = written(groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n", "v", "n_lang")]), "divergence-groups")
    shares = per.join(groups, ["lang", "source"]).withColumns({"p": share(F.col("count"), F.col("n"), F.col("v")), "q": share(F.col("total"), F.col("n_lang"), F.col("v"))})

    pairs = source_pairs(shares.select("lang", "source", "term", "p"), groups.select("lang", "source", "n", "v"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # all that tie with the last rank stay until their texts settle the order
    leading = shares.filter(F.col("p") > F.col("q")).select("lang", "source", "term", gap(F.col("p"), F.col("q")).alias("value"))
    leading = leading.withColumn("place", F.rank().over(by_value)).filter(F.col("place") <= top)
    spelling = kept.join(names, "digest").select("term", F.when(F.col("split") == "", F.col("low")).otherwise(F.col("split")).alias("item"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    best = leading.join(spelling, "term").withColumns({"part": F.lit("term"), "rank": place}).filter(F.col("rank") <= top)
    return pairs.withColumns({"part": F.lit("pair"), "rank": place}).select(*columns).unionByName(best.select(*columns))
