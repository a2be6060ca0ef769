"""Phrase collocation mining by vertically partitioned, depth-truncated suffix trees.

Every word of a text starts a suffix, cut off after the longest phrase's length or at the end of its piece. Prefixes are
grouped by a memory budget: a prefix of more suffixes than a share of it is extended by its next word, and that one again,
and the prefixes that result are dealt to as many groups as the budget asks for. The subtree of a group is built on its own from
its sorted suffixes; a node's count is the sum of its leaves' totals. Scores, cuts and absorbed phrases are joins on the nodes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgeo.llm.common import map_arrow, slices, written
from docgeo.session import ship_package

# Suffixes that a group should hold at most, and prefixes that are extended at most (their digests go to all workers, 8 bytes
# each): a larger corpus gets larger groups, so that the list keeps its bound.
BUDGET = 1 << 19
EXTENDED = 1 << 20

# Words that a worker counts together, and bytes of a text that it splits at a time (cut at the end of a piece).
CHUNK = 1 << 21
SEGMENT = 1 << 22

SALTS = 64  # parts in which the leading phrases of a language are looked for

_END = b"\xff"  # not in UTF-8: marks the end of a piece, number 0 of the words
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else 0xFF if b in b".,;:!?" or 0x0A <= b <= 0x0D else b for b in range(256))


class _Numbers(dict):
    """Words numbered in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def pieces(text: str) -> Iterator[list[bytes]]:
    """Words of the text, A-Z lower-cased, with ``_END`` between pieces; a long text in several lists."""
    data, at = text.encode().translate(_BYTES), 0
    while at < len(data):
        cut = data.find(_END, at + SEGMENT)
        cut = len(data) if cut < 0 else cut + 1
        yield data[at:cut].replace(_END, b" \xff ").split()
        at = cut


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """Of rows ``lang, text``: a language, its words by number and the texts as numbers, about CHUNK words at a time."""
    numbers, parts, size = defaultdict(lambda: _Numbers({_END: 0})), defaultdict(list), 0

    def out() -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        for lang, found in parts.items():
            yield lang, list(numbers[lang]), np.concatenate(found)

    for batch in batches:
        for part in slices(batch, "text"):
            for lang, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                number = numbers[lang].__getitem__
                for words in pieces(text):
                    parts[lang].append(np.array([*map(number, words), 0], dtype=np.int64))
                    size += len(words) + 1
                    if size >= CHUNK:
                        yield from out()
                        numbers.clear()
                        parts.clear()
                        size = 0
                        number = numbers[lang].__getitem__
    yield from out()


def _digests(lang: str, words: list[bytes]) -> np.ndarray:
    salt = lang.encode() + _END
    return np.array([0, *(xxhash.xxh64_intdigest(salt + w) for w in words[1:])], dtype=np.uint64)


def _extend(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Digests of prefixes with one more word."""
    x = (prefix ^ (prefix >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _among(digests: np.ndarray, listed: np.ndarray) -> np.ndarray:
    at = np.searchsorted(listed, digests)
    found = at < len(listed)
    found[found] = listed[at[found]] == digests[found]
    return found


def _following(a: np.ndarray, n: int) -> list[np.ndarray]:
    """For each place the next ``n`` numbers, 0 from the end of the piece on."""
    out = [a]
    for d in range(1, n):
        shifted = np.concatenate([a[d:], np.zeros(min(d, len(a)), dtype=np.int64)])
        out.append(np.where(out[-1] == 0, 0, shifted))
    return out


def sorted_runs(columns: list[np.ndarray], weights: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns in order, and the sums of their weights (how many there are, without weights)."""
    base = 1 + max((int(c.max()) for c in columns if len(c)), default=0)
    if base ** len(columns) < 1 << 62:
        key = columns[0]
        for c in columns[1:]:
            key = key * base + c
        if weights is None:
            key, total = np.unique(key, return_counts=True)
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
            key, total = key[first], np.add.reduceat(weights[order], first) if len(first) else weights[:0]
        out = []
        for _ in columns:
            key, last = np.divmod(key, base)
            out.append(last)
        return out[::-1], total
    order = np.lexsort(columns[::-1])
    ordered = [c[order] for c in columns]
    first = np.flatnonzero(np.any([np.diff(c, prepend=c[:1] - 1) != 0 for c in ordered], axis=0))
    total = np.diff(np.append(first, len(order))) if weights is None else np.add.reduceat(weights[order], first)
    return [c[first] for c in ordered], total


def _prefix_counts(depth: int):
    """How often each prefix of up to ``depth`` words occurs: all of one word, longer ones if they occur twice in a chunk.

    What is left out only makes a group a little larger than its budget; no result depends on it.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, a in _chunks(batches):
            h = _digests(lang, words)
            row = _following(a, depth)
            n = np.bincount(a, minlength=len(words))
            found, levels = [h[1:]], [np.ones(len(words) - 1, dtype=np.int32)]
            counts = [n[1:]]
            at = np.flatnonzero((a > 0) & (n[a] > 1))
            d = h[a[at]]
            for level in range(2, depth + 1):
                c = row[level - 1][at]
                d, at = _extend(d[c > 0], h[c[c > 0]]), at[c > 0]
                prefixes, which, n = np.unique(d, return_inverse=True, return_counts=True)
                found.append(prefixes[n > 1])
                counts.append(n[n > 1])
                levels.append(np.full(len(found[-1]), level, dtype=np.int32))
                d, at = d[n[which] > 1], at[n[which] > 1]
            columns = [pa.array(np.concatenate(levels)), pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(counts), pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(columns[0]), pa.string()), *columns], names=["lang", "level", "prefix", "n"])

    return run


def _joined(values: pa.Array, ends: np.ndarray) -> pa.Array:
    """Binary values put together in runs that end at ``ends``, without a copy."""
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset :]
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets[np.concatenate([[0], ends])].astype(np.int32)), values.buffers()[2]])


def _suffixes(depth: int, extended: list[np.ndarray], groups: int):
    """Distinct suffixes of some texts and their counts, a row for each group: the words by place, joined by line feeds."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "level", "group", *[f"w{i}" for i in range(depth)], "counts"]
        for lang, words, a in _chunks(batches):
            h = _digests(lang, words)
            spelled = pa.array([b"\n", *(w + b"\n" for w in words[1:])], pa.binary())
            for start in range(0, len(a), CHUNK):
                part = _following(a[start : start + CHUNK + depth - 1], depth)
                begins = np.flatnonzero(part[0][:CHUNK] > 0)
                if not len(begins):
                    continue
                row, n = sorted_runs([c[begins] for c in part])
                level, d = np.ones(len(n), dtype=np.int32), h[row[0]]
                at, more = d, np.ones(len(n), dtype=bool)
                for listed, c in zip(extended, row[1:], strict=False):
                    more &= _among(d, listed)
                    d = _extend(d, h[c])
                    at = np.where(more, d, at)
                    level += more
                group = (at % np.uint64(groups)).astype(np.int32)
                order = np.lexsort((group, level))
                group, level = group[order], level[order]
                ends = np.append(np.flatnonzero((np.diff(group) != 0) | (np.diff(level) != 0)) + 1, len(n))
                columns = [_joined(spelled.take(pa.array(c[order])), ends) for c in row]
                sizes = pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int32))
                counts = pa.Array.from_buffers(pa.binary(), len(ends), [None, sizes, pa.py_buffer(n[order].astype(np.int32))])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(ends), pa.string()), pa.array(level[ends - 1]), pa.array(group[ends - 1]), *columns, counts], names=names)

    return run


def _subtree(depth: int, min_count: int):
    """Nodes of the subtree over a group's suffixes. Those above the prefix's own level lie in several groups: all are given."""

    def run(key, rows):
        lang, level = key[0].as_py(), key[1].as_py()
        words = [b""]
        for d in range(depth):
            for blob in rows[f"w{d}"]:
                words += blob.as_py().split(b"\n")[:-1]
        listed = pa.array(words, pa.binary()).dictionary_encode()
        spelled, numbers = listed.dictionary, listed.indices.to_numpy()[1:].astype(np.int64).reshape(depth, -1)
        weights = np.concatenate([np.frombuffer(c.as_py(), dtype=np.int32) for c in rows["counts"]]).astype(np.int64)
        leaves, total = sorted_runs(list(numbers), weights)
        out = []
        opens = np.zeros(len(total), dtype=bool)
        for d in range(depth):
            opens = opens | (np.diff(leaves[d], prepend=-1) != 0)
            first = np.flatnonzero(opens)
            n = np.add.reduceat(total, first)
            keep = (leaves[d][first] > 0) & ((n >= min_count) | (d + 1 < level))
            at = first[keep]
            parts = [spelled.take(pa.array(leaves[i][at])).cast(pa.string()) for i in range(d + 1)]
            phrase = parts[0] if d == 0 else pc.binary_join_element_wise(*parts, " ")
            out.append(pa.table([pa.array([lang] * len(at), pa.string()), pa.array([d + 1] * len(at), pa.int32()), phrase, pa.array(n[keep])], names=["lang", "words", "phrase", "n"]))
        return pa.concat_tables(out)

    return run


def phrase_counts(docs: DataFrame, max_words: int, min_count: int, budget: int = BUDGET, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``lang, words, phrase, n`` of all phrases up to ``max_words`` words that occur ``min_count`` times, and ``lang, n`` of all words."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), docs[text].cast("string").alias("text")).filter(F.col("text").isNotNull())
    counted = map_arrow(rows, _prefix_counts(max(1, max_words - 1)), "lang string, level int, prefix long, n long")
    counted = written(counted.groupBy("lang", "level", "prefix").agg(F.sum("n").alias("n")), "phrases-prefixes")
    of_lang = written(counted.filter("level = 1").groupBy("lang").agg(F.sum("n").alias("n")), "phrases-langs")
    total = of_lang.agg(F.sum("n")).first()[0] or 0
    budget = max(budget, -(-4 * total // EXTENDED))
    # at most total / (budget / 4) <= EXTENDED prefixes of each length
    heavy = counted.filter(F.col("n") > budget // 4).select("level", "prefix").collect()
    extended = [np.sort(np.array([r["prefix"] for r in heavy if r["level"] == d], dtype=np.int64).view(np.uint64)) for d in range(1, max_words)]
    groups = max(1, -(-2 * total // budget))
    places = ", ".join(f"w{i} binary" for i in range(max_words))
    suffixes = map_arrow(rows, _suffixes(max_words, extended, groups), f"lang string, level int, group int, {places}, counts binary")
    nodes = suffixes.groupBy("lang", "level", "group").applyInArrow(_subtree(max_words, min_count), "lang string, words int, phrase string, n long")
    counts = nodes.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    return written(counts, "phrases-nodes"), of_lang


def _exact_score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(10^6 a a / (l r)), exactly; the products may pass 64 bits."""
    wide = lambda c: c.cast("decimal(17,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(l) * wide(r)).cast("long")


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, absorb_percent: int = 50, top: int = 2000, budget: int = BUDGET, lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to ``max_words`` words of each language.

    Texts (A-Z lower-cased) are split into pieces at ``.,;:!?`` and line ends and into words at blanks and tabs; a phrase
    lies within a piece. ``a``: its occurrences, overlapping ones too, ``min_count`` at least. Its score is the least over
    the cuts into two parts (then the shortest first part) of floor(10^6 a a / (l r)), where ``l`` and ``r`` count the parts;
    ``n``: all words of the language. A phrase goes if a longer candidate that holds it occurs ``absorb_percent`` as often.
    Ranks go by falling score, then falling ``a``, then the phrase's bytes.

    A null language is ``und``, a null text is empty. Repeated rows count each time. Texts of any length are read whole.
    A language without candidates, and so an empty table, has no rows. Other columns are not read.
    """
    counts, of_lang = phrase_counts(docs, max_words, min_count, budget, lang, text)
    part = counts.select("lang", "phrase", "n")
    words = F.split("phrase", " ")
    found = counts.filter(F.col("words") > 1).select("lang", "phrase", "words", F.col("n").alias("a"), words.alias("w"))
    cut = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.withColumns({"first": F.array_join(F.slice("w", F.lit(1), F.col("k")), " "), "rest": F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ")})
    left = part.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = part.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    least = F.min(F.struct(_exact_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("x")
    scored = scored.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "x.l", "x.r", "x.score")

    inner = found.filter(F.col("words") > 2).withColumn("m", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("s", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)))
    inner = inner.groupBy("lang", F.array_join(F.slice("w", F.col("s"), F.col("m")), " ").alias("phrase")).agg(F.max("a").alias("longer"))
    own = scored.join(inner, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * absorb_percent))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))  # the leading ones of each part first: a language may hold most rows
    own = own.withColumn("_r", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).filter(F.col("_r") <= top)
    own = own.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return own.join(of_lang, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
