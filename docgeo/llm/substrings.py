"""Substring deduplication by recompression.

Texts are sequences of named symbols, at first the digests of their words. A round names runs of one symbol and pairs of a
left and a right symbol (a coin thrown by name decides which it is): a name is a digest of what it stands for, so equal
substrings get equal symbols in all tasks, but for a few at their ends, and no round needs a dictionary.

What a window's symbols are, less those that neighbours outside could have changed (its core), depends on the window alone.
Each window is represented by a symbol of its core on the highest level that has one; the sequences shrink by a quarter a
round, so some ten windows in a row share theirs. Symbols that different texts share reveal candidates; windows that are
represented by them are compared by 128-bit digests of all their words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgeo.llm.common import map_arrow, slices, written

# Rounds before which runs are named (each costs a window a symbol at both ends), and rounds at most.
RUNS_BEFORE = (0, 2)
ROUNDS = 24

# Symbols of a core that are looked at for the longest one.
LOOKED_AT = 4

# Words of a text that are compressed together; longer texts overlap by a window.
BLOCK_WORDS = 1 << 19

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    x = (x ^ (x >> np.uint64(29))) * _C
    return x ^ (x >> np.uint64(32))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(_mix(a) * _A + b)


def word_names(words: list[bytes]) -> np.ndarray:
    """Two columns of 64 bits for each word."""
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join(map(digest, words)), dtype=np.uint64).reshape(-1, 2)


def window_symbols(names: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows and the symbols that represent them. ``first``: the words that begin a text."""
    n = len(names)
    begin = np.flatnonzero(first)
    sizes = np.diff(np.append(begin, n))
    starts = np.flatnonzero(np.arange(n) + window <= np.repeat(begin + sizes, sizes)).astype(np.int32)
    symbol, size = names, np.ones(n, dtype=np.int32)
    low, high = starts, starts + np.int32(window)
    # windows in a row with the same core go on as one: `group` numbers the cores, `live` those that are not yet represented
    group, live = np.arange(len(starts), dtype=np.int32), np.arange(len(starts), dtype=np.int32)
    out = np.zeros(len(starts), dtype=np.uint64)

    def represent(which: np.ndarray) -> None:
        """The longest of the core's leading symbols, the first of them."""
        at, last = low[which], high[which] - 1
        best = at
        for step in range(1, LOOKED_AT):
            other = np.minimum(at + step, last)
            best = np.where(size[other] > size[best], other, best)
        out[live[which]] = symbol[best]

    def replace(heads: np.ndarray, new: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> None:
        """Go on with the symbols at ``heads``, named ``new``; cores shrink to [lower, upper) of the old ones."""
        nonlocal symbol, size, low, high, live, first
        left = lower < upper
        if not left.all():
            represent(np.flatnonzero(~left))
            lower, upper, live = lower[left], upper[left], live[left]
        number = np.cumsum(heads, dtype=np.int32) - 1
        low, high = number[lower], number[upper - 1] + 1
        at = np.flatnonzero(heads)
        symbol, size, first = new, np.add.reduceat(size, at), first[at]

    for r in range(ROUNDS):
        if not len(live):
            break
        if r in RUNS_BEFORE:
            heads = first.copy()
            heads[1:] |= symbol[1:] != symbol[:-1]
            at = np.flatnonzero(heads).astype(np.int32)
            length = np.diff(np.append(at, np.int32(len(symbol))))
            number = np.cumsum(heads, dtype=np.int32) - 1
            new = symbol[at]
            run = np.flatnonzero(length > 1)
            new[run] = _pair(new[run], length[run].astype(np.uint64))
            # the first and the last run of a core may go on outside
            replace(heads, new, (at + length)[number[low]], at[number[high - 1]])
            if not len(live):
                break
        right = (_mix(symbol + np.uint64((r + 1) * int(_A) % (1 << 64))) >> np.uint64(63)).astype(bool)
        second = np.zeros(len(symbol), dtype=bool)
        second[1:] = right[1:] & ~right[:-1] & ~first[1:]
        at = np.flatnonzero(~second)
        new = symbol[at]
        pair = np.flatnonzero(second[np.minimum(at + 1, len(symbol) - 1)] & (at + 1 < len(symbol)))
        new[pair] = _pair(new[pair], symbol[at[pair] + 1])
        # a right symbol at the core's start and a left one at its end may pair with a neighbour outside
        replace(~second, new, low + right[low], high - ~right[high - 1])
        if r % 2 and len(live):
            differs = np.ones(len(live), dtype=bool)
            differs[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            if not differs.all():
                of = np.arange(len(out), dtype=np.int32)
                of[live] = live[differs][np.cumsum(differs) - 1]
                group = of[group]
                low, high, live = low[differs], high[differs], live[differs]
    represent(np.arange(len(live)))
    return starts, out[group]


def window_digests(column: np.ndarray, window: int) -> np.ndarray:
    """For each place a digest of the ``window`` values from there on (as far as there are so many)."""
    out, done, power, size = None, 0, column, 1
    n = max(0, len(column) - window + 1)
    while size <= window:
        if window & size:
            part = power[done : done + n]
            out = part if out is None else _pair(out, part)
            done += size
        if 2 * size <= window:
            power = _pair(power[: len(power) - size], power[size:])
        size *= 2
    return out if out is not None else column[:0]


def _blocks(counts: list[int], window: int) -> Iterator[tuple[int, int]]:
    """Parts [from, to) of the words of one text after another: bounded ones that hold every window between them."""
    at = 0
    for n in counts:
        for start in range(0, max(1, n - window + 1), BLOCK_WORDS):
            yield at + start, at + min(n, start + BLOCK_WORDS + window - 1)
        at += n


def _compressed(texts: list[list[bytes]], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """All windows of the texts, a bounded number of words at a time (short texts together, long ones in blocks):
    text, start in the text, symbol and place in the names of the words, which come last."""
    counts = [len(t) for t in texts]
    names = word_names([w for t in texts for w in t])
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    cuts = [(s, e) for s, e in _blocks(counts, window) if e - s >= window]
    at = 0
    while at < len(cuts):
        upto, size = at, 0
        while upto < len(cuts) and (upto == at or size + cuts[upto][1] - cuts[upto][0] <= BLOCK_WORDS + window):
            size += cuts[upto][1] - cuts[upto][0]
            upto += 1
        blocks = np.array(cuts[at:upto], dtype=np.int64)
        at = upto
        joined = np.concatenate([names[s:e] for s, e in blocks])
        begin = np.concatenate([[0], np.cumsum(blocks[:, 1] - blocks[:, 0])])
        first = np.zeros(len(joined), dtype=bool)
        first[begin[:-1]] = True
        starts, symbols = window_symbols(np.ascontiguousarray(joined[:, 0]), first, window)
        of = np.repeat(np.arange(len(blocks)), np.diff(np.searchsorted(starts, begin)))
        text = np.searchsorted(offsets, blocks[:, 0], side="right") - 1
        yield text[of], starts + (blocks[:, 0] - begin[:-1] - offsets[text])[of], symbols, starts, joined


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _survey(window: int):
    """``doc, body, n_words, seq_a, seq_b, symbols``: a digest of each text's words, and the symbols that stand for its windows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [_words(t) for t in part.column(2).to_pylist()]
                found: list[list[np.ndarray]] = [[] for _ in texts]
                for text, _, symbols, _, _ in _compressed(texts, window):
                    new = np.ones(len(text), dtype=bool)
                    new[1:] = (text[1:] != text[:-1]) | (symbols[1:] != symbols[:-1])
                    text, symbols = text[new], symbols[new]
                    edges = np.flatnonzero(np.diff(text, prepend=-1))
                    for i, part_of in zip(text[edges].tolist(), np.split(symbols, edges[1:]), strict=True):
                        found[i].append(part_of)
                symbols = [np.unique(np.concatenate(f)).view(np.int64) if f else np.zeros(0, dtype=np.int64) for f in found]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in symbols])]).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *symbols])))
                seq = np.frombuffer(b"".join(xxhash.xxh3_128_digest(b" ".join(t)) for t in texts), dtype=np.int64).reshape(-1, 2)
                n = pa.array([len(t) for t in texts], pa.int64())
                columns = [part.column(0), part.column(1), n, pa.array(np.ascontiguousarray(seq[:, 0])), pa.array(np.ascontiguousarray(seq[:, 1])), listed]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "body", "n_words", "seq_a", "seq_b", "symbols"])

    return run


def _candidates(window: int):
    """``a, b, doc, body, start``: the windows of each text that one of its shared symbols represents, by the digests of their words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                doc, body = (part.column(i).to_numpy() for i in (0, 1))
                shared = part.column(3)
                of = np.repeat(np.arange(len(shared)), shared.value_lengths().to_numpy())
                wanted = _pair(shared.flatten().to_numpy().view(np.uint64), of.astype(np.uint64))
                for text, start, symbols, at, names in _compressed([_words(t) for t in part.column(2).to_pylist()], window):
                    # a symbol and its text as one number: one that is taken for another is only a candidate more
                    take = np.isin(_pair(symbols, text.astype(np.uint64)), wanted)
                    digests = [window_digests(np.ascontiguousarray(names[:, c]), window)[at[take]].view(np.int64) for c in (0, 1)]
                    columns = [*digests, doc[text[take]], body[text[take]], start[take]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "doc", "body", "start"])

    return run


def _covered(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``doc, body, spans``: the words that windows with these starts cover, as spans [start, end) in order."""
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = []
            for starts in batch.column(2):
                s = np.unique(starts.values.to_numpy())
                opens = np.flatnonzero(np.diff(s, prepend=s[0] - window - 1) > window)
                closes = np.append(opens[1:], len(s)) - 1
                spans.append([{"start": a, "end": b} for a, b in zip(s[opens].tolist(), (s[closes] + window).tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind)], names=["doc", "body", "spans"])

    return run


def _kept(key: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n_words, n_removed, kept = [], [], []
                for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    words, left, at = _words(text), [], 0
                    for span in spans or []:
                        left += words[at : span["start"]]
                        at = span["end"]
                    left += words[at:]
                    n_words.append(len(words))
                    n_removed.append(len(words) - len(left))
                    kept.append(b" ".join(left).decode())
                columns = [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), part.column(2)]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "n_words", "n_removed", "kept", "spans"])

    return run


SPANS = "array<struct<start:bigint,end:bigint>>"


def repeated_spans(rows: DataFrame, window: int) -> DataFrame:
    """``doc, body, spans`` of the rows (``doc, body, text``) that lose words: spans [start, end) of words, in order.

    Rows of the same words are one text: its later copies lose everything (from ``window`` words on), and only the first takes
    part in the search. Distinct symbols of a text are counted once, and sums are combined before they are shuffled, so a
    passage that many texts share is a number of narrow rows, which AQE splits where they are joined.
    """
    survey = written(map_arrow(rows, _survey(window), "doc long, body long, n_words long, seq_a long, seq_b long, symbols array<bigint>"), "substrings-survey")
    survey = survey.filter(F.col("n_words") >= window)
    seq = ["seq_a", "seq_b"]
    first = written(survey.groupBy(*seq).agg(F.min("doc").alias("of")), "substrings-first")
    own = survey.join(first.withColumnRenamed("of", "doc"), ["doc", *seq], "left_semi").select("doc", "body", F.explode("symbols").alias("symbol"))
    own = written(own, "substrings-symbols")
    shared = own.groupBy("symbol").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter(F.col("low") != F.col("high")).select("symbol")
    texts = own.join(written(shared, "substrings-shared"), "symbol").groupBy("doc", "body").agg(F.collect_set("symbol").alias("shared"))
    # joined by merge at every size: with a broadcast of what is small the texts would be shuffled by large inputs only
    found = rows.join(written(texts, "substrings-texts").hint("merge"), ["doc", "body"])
    windows = written(map_arrow(found.select("doc", "body", "text", "shared"), _candidates(window), "a long, b long, doc long, body long, start long"), "substrings-windows")
    earliest = windows.groupBy("a", "b").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter(F.col("low") != F.col("high")).select("a", "b", "low")
    earliest = written(earliest, "substrings-earliest")  # not in the join's own stage, which AQE could not split then
    gone = windows.join(earliest, ["a", "b"]).filter(F.col("doc") > F.col("low")).groupBy("doc", "body").agg(F.collect_set("start").alias("starts"))
    spans = map_arrow(gone.select("doc", "body", "starts"), _covered(window), f"doc long, body long, spans {SPANS}")
    later = survey.join(first, seq).filter(F.col("doc") > F.col("of")).dropDuplicates(["doc", "body"])
    whole = later.select("doc", "body", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"))).alias("spans"))
    return spans.unionByName(whole)


def without_repeats(docs: DataFrame, window: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, n_removed, kept, spans`` for every row: its text without the passages that an earlier document has.

    Words are runs of non-space (ASCII). A word goes if a window of ``window`` consecutive words covers it that also starts in
    a row with a smaller ``key``; what is repeated is judged on the whole input, not on what is left. ``kept``: the other
    words, joined by one blank; ``spans``: the removed ones, by word numbers.

    A null text is empty. Rows with a null key neither lose words nor take them from others. Rows that repeat a key don't
    count as earlier for each other. Texts shorter than a window keep all words; very long ones are worked on in overlapping
    blocks. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(docs[key].cast("long").alias("doc"), F.xxhash64(docs[text].cast("string")).alias("body"), docs[text].cast("string").alias("text"))
    spans = written(repeated_spans(rows.filter(F.col("doc").isNotNull() & F.col("text").isNotNull()), window), "substrings-spans")
    joined = rows.join(spans.hint("merge"), ["doc", "body"], "left").select(F.col("doc").alias(key), "text", "spans")
    return map_arrow(joined, _kept(key), f"{key} long, n_words long, n_removed long, kept string, spans {SPANS}")
