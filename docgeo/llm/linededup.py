"""Line deduplication by a segment-partition edit join.

Two lines within ``edits`` edits, the shorter cut into ``edits + 1`` segments: one segment at least stays whole and stands
in the longer line near its old place. So each distinct line is posted under its segments (keys of length, segment number
and content), and probes with its substrings at the places where a segment of a line of each admissible length could stand.
Lines that meet under a key are verified with a banded, bit-parallel edit distance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgeo.llm.common import cells, map_arrow, slices, written
from docgeo.llm.components import Forest, components

SEED = 42  # of Spark's xxhash64, so that a line has the same number in Python and in Spark

# Lines under one key that are compared in one cell; larger groups are cut into a grid of cells.
CELL = 256

# Distinct lines that a worker remembers in order not to post them again (memory only).
SEEN_LINES = 1 << 18

# Bytes of lines (whole cells) that a worker verifies together.
BLOCK_BYTES = 8 << 20

# Pairs verified at once, and characters held for them.
PAIRS = 1 << 13
PAIR_CHARS = 1 << 22


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, size) of ``edits + 1`` nearly equal segments; the last ones are a character longer if need be."""
    n = edits + 1
    short, longer = divmod(length, n)
    out, at = [], 0
    for i in range(n):
        size = short + (i >= n - longer)
        out.append((at, size))
        at += size
    return out


def plan(length: int, edits: int) -> list[tuple[int, int, int, int]]:
    """(start, end, seed, probe) of every key of a line of this length: its own segments, then its probes."""
    n = edits + 1
    own = [(s, s + size, length * n + i, 0) for i, (s, size) in enumerate(segments(length, edits))]
    probes = []
    for shorter in range(max(n, length - edits), length + 1):
        gap = length - shorter
        for i, (s, size) in enumerate(segments(shorter, edits)):
            rest = edits - i  # what the part right of the segment can still shift
            low, high = max(0, s - i, s + gap - rest), min(length - size, s + i, s + gap + rest)
            # an equally long line with the same segment at the same place is met among the segments
            probes += [(at, at + size, shorter * n + i, 1) for at in range(low, high + 1) if gap or at != s]
    return own + probes


def rest_plan(length: int, target: int, edits: int) -> list[tuple[int, int, int]]:
    """(start, end, segment) of the places in a string where a segment of one of ``target`` characters could stand."""
    gap, out = length - target, []
    for i, (s, size) in enumerate(segments(target, edits)):
        rest = edits - i
        out += [(at, at + size, i) for at in range(max(0, s - i, s + gap - rest), min(length - size, s + i, s + gap + rest) + 1)]
    return out


def _finer(edits: int):
    """``key, finer, line, probe`` of rows ``key, line, text, probe``: what is left of the lines without the segment that they
    share is cut into segments again, so that those who share one more meet. Two lines within ``edits`` edits do, as the rests
    on both sides of the segment that stayed whole are within them too. Rests too short for segments keep the key."""
    n = edits + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, mask = xxhash.xxh64_intdigest, (1 << 64) - 1
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for key, line, text, probe in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    code, found = key & mask, set()
                    for s, e, seed, is_probe in plan(len(text), edits):
                        if is_probe != probe or digest(text[s:e], seed) != code:
                            continue
                        target, rest = seed // n - (e - s), text[:s] + text[e:]
                        if target < n:
                            found.add((key, probe))
                            continue
                        for a, b, i in rest_plan(len(rest), target, edits):
                            own = not probe and (a, b - a) == segments(target, edits)[i]
                            found.add((digest(rest[a:b], (code * 31 + seed * n + i) & mask), 0 if own else 1))
                    out += [(key, f - (f >> 63 << 64), line, p) for f, p in found]
                columns = [pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "finer", "line", "probe"])

    return run


def _post(edits: int, min_chars: int, max_chars: int | None = None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, plans, seen = xxhash.xxh64_intdigest, {}, set()
        for batch in batches:
            for part in slices(batch, "text"):
                keys, ids, times, probe = [], [], [], []
                for text in part.column(0).to_pylist():
                    for line in (text or "").split("\n"):
                        if len(line) < min_chars or (max_chars is not None and len(line) > max_chars) or (own := digest(line, SEED)) in seen:
                            continue
                        seen.add(own)
                        steps = plans.get(len(line))
                        if steps is None:
                            steps = plans[len(line)] = plan(len(line), edits)
                        keys += [digest(line[s:e], seed) for s, e, seed, _ in steps]
                        probe += [p for _, _, _, p in steps]
                        ids.append(own)
                        times.append(len(steps))
                if len(seen) > SEEN_LINES:
                    seen.clear()
                    plans.clear()
                lids = np.repeat(np.array(ids, dtype=np.uint64).view(np.int64), times)
                columns = [np.array(keys, dtype=np.uint64).view(np.int64), lids, np.array(probe, dtype=np.int8)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "line", "probe"])

    return run


def _meetings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, probe, line): those of keys that hold a segment and two different lines, each once.

    Of a key that goes on in the next batch only whether it qualifies is kept, and its rows as long as it doesn't.
    """
    held = [np.zeros(0, dtype=np.int64) for _ in range(3)]
    open_key = None
    for batch in batches:
        key, line, probe = (np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)]) for i, h in enumerate(held))
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1]) | (probe[1:] != probe[:-1])
        key, line, probe = key[new], line[new], probe[new]
        if not len(key):
            continue
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, len(key)))
        good = np.logical_or.reduceat(line != np.repeat(line[first], size), first) & (probe[first] == 0)
        if key[0] == open_key:
            good[0] = True
        take = np.repeat(good, size)
        tail = first[-1]
        open_key = key[-1] if good[-1] else None
        held = [c[:0] for c in (key, line, probe)] if good[-1] else [c[tail : tail + 2] for c in (key, line, probe)]
        yield pa.RecordBatch.from_arrays([pa.array(c[take]) for c in (key, line, probe)], names=["key", "line", "probe"])


def within_edits(a: list[str], b: list[str], edits: int) -> np.ndarray:
    """For each pair of strings whether their edit distance is at most ``edits``.

    Bit d of the word for e errors says that the distance of the prefixes on diagonal ``d - edits`` is at most e: the whole
    band is one word, and a step along the text updates it with shifts and masks, for all pairs at once.
    """
    out = np.zeros(len(a), dtype=bool)
    sizes = np.array([(len(x), len(y)) for x, y in zip(a, b, strict=True)], dtype=np.int64).reshape(-1, 2)
    order = np.argsort(sizes[:, 1], kind="stable")
    order = order[np.abs(sizes[order, 0] - sizes[order, 1]) <= edits]
    at = 0
    while at < len(order):
        # pairs sorted by length: a block whose longest pair times its size fits
        n = min(PAIRS, len(order) - at)
        while n > 1 and n * (sizes[order[at + n - 1], 1] + 2 * edits) > PAIR_CHARS:
            n = max(1, n // 2)
        block = order[at : at + n]
        at += n
        m, last = sizes[block, 0], int(sizes[block[-1], 1])
        pattern = np.zeros((n, last + 3 * edits + 1), dtype=np.uint32)  # position 0 is `edits` places before the string
        texts = np.zeros((n, last + 1), dtype=np.uint32)
        for row, i in enumerate(block.tolist()):
            x, y = (np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for s in (a[i], b[i]))
            pattern[row, edits : edits + len(x)] = x + 1
            texts[row, : len(y)] = y + 1
        pattern, texts = np.ascontiguousarray(pattern.T), np.ascontiguousarray(texts.T)
        word = np.uint32
        whole = word((1 << (2 * edits + 1)) - 1)
        state = [np.full(n, sum(1 << (edits + d) for d in range(e + 1)), dtype=word) for e in range(edits + 1)]
        ends = sizes[block, 1]
        goal = (m - ends + edits).astype(word)
        done = int(np.searchsorted(ends, 0, side="right"))
        out[block[:done]] = (state[edits][:done] >> goal[:done]) & 1 == 1
        for j in range(last):
            if j % 32 == 31:
                live = state[edits] != 0  # the others are beyond the threshold on every diagonal
                if not live.any():
                    break
                if 2 * np.count_nonzero(live) < n:
                    block, ends, goal, n = block[live], ends[live], goal[live], int(np.count_nonzero(live))
                    pattern, texts = pattern[:, live], texts[:, live]
                    state = [s[live] for s in state]
                    done = int(np.searchsorted(ends, j, side="right"))
            equal = np.zeros(n, dtype=word)
            for d in range(2 * edits + 1):
                equal |= (pattern[j + d] == texts[j]).astype(word) << word(d)
            before = None
            for e in range(edits + 1):
                now = state[e] & equal
                if e:
                    now |= old | (old >> word(1)) | (before << word(1))
                    now &= whole
                old, state[e] = state[e], now
                before = now
            upto = int(np.searchsorted(ends, j + 1, side="right"))
            if upto > done:
                ready = slice(done, upto)
                out[block[ready]] = (state[edits][ready] >> goal[ready]) & 1 == 1
                done = upto
    return out


def trimmed(a: str, b: str) -> tuple[str, str]:
    """The strings without their common start and end, which don't change the edit distance."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    a, b = a[low:], b[low:]
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[len(a) - mid : len(a) - low] == b[len(b) - mid : len(b) - low]:
            low = mid
        else:
            high = mid - 1
    return a[: len(a) - low], b[: len(b) - low]


def cell_links(lines: list[str], cell: np.ndarray, is_probe: np.ndarray, side: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) that connect the lines within ``edits`` of each other in each cell: a spanning forest, not all pairs.

    ``cell`` is ascending. Pairs of two segments or of a segment and a probe are compared, those of two probes aren't (they
    meet elsewhere). First each cell's first line is compared with the others; pairs that are connected by then need no
    comparison. Pairs of all cells are verified together.
    """
    n = len(lines)
    joined = Forest(n)
    sizes_of = np.array([len(x) for x in lines], dtype=np.int64)

    def verify(i: np.ndarray, j: np.ndarray) -> None:
        at = 0
        while at < len(i):
            # as many pairs as hold PAIR_CHARS characters at most
            n = int(np.searchsorted(np.cumsum(sizes_of[i[at : at + PAIRS]] + sizes_of[j[at : at + PAIRS]]), PAIR_CHARS))
            x, y = i[at : at + max(1, n)], j[at : at + max(1, n)]
            at += max(1, n)
            open_ = joined.parent[x] != joined.parent[y]
            x, y = x[open_], y[open_]
            if len(x):
                cut = [trimmed(lines[p], lines[q]) for p, q in zip(x.tolist(), y.tolist(), strict=True)]
                near = within_edits([c[0] for c in cut], [c[1] for c in cut], edits)
                joined.link(x[near], y[near])

    def allowed(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return ((is_probe[i] == 0) | (is_probe[j] == 0)) & ((side[i] == 2) | (side[i] != side[j])) & (joined.parent[i] != joined.parent[j])

    starts = np.flatnonzero(np.diff(cell, prepend=cell[:1] - 1))
    sizes = np.diff(np.append(starts, n))
    first, other = np.repeat(starts, sizes), np.arange(n)
    ok = (first != other) & allowed(first, other)
    verify(first[ok], other[ok])
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        i, j = np.triu_indices(size - 1, 1)
        i, j = i + start + 1, j + start + 1
        ok = allowed(i, j)
        waiting.append((i[ok], j[ok]))
        if sum(len(w[0]) for w in waiting) >= PAIRS:
            verify(*(np.concatenate(w) for w in zip(*waiting, strict=True)))
            waiting = []
    if waiting:
        verify(*(np.concatenate(w) for w in zip(*waiting, strict=True)))
    moved = np.flatnonzero(joined.parent != np.arange(n))
    return moved, joined.parent[moved]


def _verify(edits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by cell, whose size is bounded; whole cells are verified together, about BLOCK_BYTES at a time."""
        rows: list[tuple] = []
        size, last, cell = 0, None, 0

        def links() -> pa.RecordBatch:
            number, probe, side = (np.array([x[c] for x in rows], dtype=np.int64) for c in (0, 3, 4))
            i, j = cell_links([x[2] for x in rows], number, probe, side, edits)
            ids = np.array([x[1] for x in rows], dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[j])], names=["a", "b"])

        for batch in batches:
            for part in slices(batch, "text"):
                for key, low, high, line, text, probe, side in zip(*(part.column(i).to_pylist() for i in range(7)), strict=True):
                    if last != (key, low, high):
                        last, cell = (key, low, high), cell + 1
                        if size > BLOCK_BYTES:
                            yield links()
                            rows, size = [], 0
                    rows.append((cell, line, text, probe, side))
                    size += len(text) + 100
        if rows:
            yield links()

    return run


def line_links(docs: DataFrame, edits: int, min_chars: int, text: str = "text", max_chars: int | None = None) -> DataFrame:
    """``a, b``: numbers (xxhash64) of different lines that connect all lines within ``edits`` edits of each other, of those
    that have from ``min_chars`` to ``max_chars`` characters (any number, if None)."""
    whole = docs.select(docs[text].cast("string").alias("text"))
    posted = map_arrow(whole, _post(edits, min_chars, max_chars), "key long, line long, probe byte")
    order = ["key", "probe", "line"]
    met = written(map_arrow(posted.repartition("key").sortWithinPartitions(*order).select("key", "line", "probe"), _meetings, "key long, line long, probe long"), "lines-met")
    wanted = written(met.select("line").distinct(), "lines-wanted")
    lines = whole.select(F.explode(F.split("text", "\n")).alias("text")).filter(F.length("text") >= min_chars)
    if max_chars is not None:
        lines = lines.filter(F.length("text") <= max_chars)
    # the wanted lines grow with the corpus, so they are never broadcast
    # copies of a line are put together in every task before any text is shuffled
    texts = lines.withColumn("line", F.xxhash64("text")).groupBy("line").agg(F.min("text").alias("text")).join(wanted.hint("merge"), "line")
    texts = written(texts, "lines-texts")
    grid = cells(less_crowded(met, texts, edits), ["key"], "line", CELL, "lines-crowded").join(texts, "line")
    cell = ["key", "low", "high"]
    rows = grid.repartition(*cell).sortWithinPartitions(*cell).select(*cell, "line", "text", "probe", "side")
    return map_arrow(rows, _verify(edits), "a long, b long")


def less_crowded(met: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """``key, line, probe`` that bring the same pairs together as ``met`` in fewer comparisons.

    A group of n lines beyond a cell's size costs about n * n / CELL rows. Its lines are posted once more, under the shared
    segment and another one; where that costs less in all, those groups take the place of the crowded one.
    """
    size = lambda n: F.sum(n * F.ceil(n / CELL)).alias("cost")
    crowded = met.groupBy("key").count().filter(F.col("count") > CELL)
    crowded = written(crowded.groupBy("key").agg(size(F.col("count"))), "lines-many")
    if crowded.isEmpty():
        return met
    again = met.join(crowded.select("key"), "key").join(texts, "line").select("key", "line", "text", "probe")
    finer = written(map_arrow(again, _finer(edits), "key long, finer long, line long, probe long"), "lines-finer")
    groups = finer.groupBy("key", "finer").agg(F.count("*").alias("n"), F.min("probe").alias("least"))
    meeting = written(groups.filter((F.col("n") > 1) & (F.col("least") == 0)), "lines-finer-groups")
    costs = meeting.groupBy("key").agg(size(F.col("n"))).withColumnRenamed("cost", "finer_cost")
    better = crowded.join(costs, "key", "left").filter(F.coalesce("finer_cost", F.lit(0)) < F.col("cost")).select("key")
    better = written(better, "lines-better")
    taken = finer.join(better, "key").join(meeting.select("key", "finer"), ["key", "finer"])
    taken = taken.select(F.xxhash64("key", "finer").alias("key"), "line", "probe")
    return met.join(better, "key", "left_anti").select("key", "line", "probe").unionByName(taken)


def line_occurrences(docs: DataFrame, min_chars: int, key: str = "doc_id", text: str = "text", short: bool = False) -> DataFrame:
    """``key, line_no, line`` (number of the text) of the lines that take part; with ``short`` all that are not blank."""
    lines = docs.filter(docs[key].isNotNull()).select(docs[key].alias(key), F.posexplode(F.split(docs[text].cast("string"), "\n")).alias("line_no", "text"))
    some = F.length("text") >= min_chars
    if short:
        some = some | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return lines.filter(some).select(key, "line_no", F.xxhash64("text").alias("line"))


def line_classes(
    docs: DataFrame, edits: int = 2, min_chars: int = 16, key: str = "doc_id", text: str = "text", short: bool = False, fewer: tuple[tuple[int, int], ...] = ()
) -> DataFrame:
    """``key, line_no, first_<key>, first_line_no, kept`` for every line of at least ``min_chars`` characters.

    With ``short`` also for every shorter line that is not blank (ASCII white space). Those are joined with fewer edits:
    ``fewer`` lists (least characters, edits), the longest first; a pair has the edits of its shorter line. Lines below all of
    these are classed by equality alone.

    Lines are split at line feeds and numbered from 0. Lines within ``edits`` (character insertions, deletions and
    substitutions) of each other are linked; a class holds what links reach. ``first_*`` is the class's first occurrence in
    order of (key, line_no), and only that one is ``kept``. Other lines, and rows whose key or text is null, have no
    result. Repeated rows repeat their lines, and all copies of the first occurrence are kept. Lines of any length are compared
    whole; an empty table gives no rows. Identical lines are one
    number (64-bit hash) from the start, so copies cost nothing in the join.
    """
    if min_chars <= edits:
        raise ValueError("min_chars must exceed edits")
    links, above, most = line_links(docs, edits, min_chars, text), min_chars, edits
    for least, allowed in fewer if short else ():
        if not allowed < least < above or allowed >= most:
            raise ValueError("fewer must list falling lengths and edits, with more characters than edits")
        # the shorter line of a pair has less than `above` characters, so the longer one has fewer than `above + allowed`
        links = links.unionByName(line_links(docs, allowed, least, text, above + allowed - 1))
        above, most = least, allowed
    linked = components(links, "a", "b", "line-links")
    here = written(line_occurrences(docs, min_chars, key, text, short), "line-occurrences")
    place = F.struct(key, "line_no")
    first = here.groupBy("line").agg(F.min(place).alias("first"))
    reached = first.join(linked, first["line"] == linked["node"]).select("line", "root", "first")
    least = reached.groupBy("root").agg(F.min("first").alias("of_class"))
    moved = reached.join(least, "root").select("line", "of_class")
    classes = written(first.join(moved, "line", "left").select("line", F.coalesce("of_class", "first").alias("first")), "line-classes")
    found = here.join(classes, "line")
    return found.select(
        key,
        "line_no",
        F.col(f"first.{key}").alias(f"first_{key}"),
        F.col("first.line_no").alias("first_line_no"),
        (place == F.col("first")).alias("kept"),
    )


def without_lines(text: Column, gone: Column) -> Column:
    """``text`` without the lines whose numbers are in the array ``gone``."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(gone, i)), "\n")


def drop_duplicate_lines(docs: DataFrame, edits: int = 2, min_chars: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the lines removed that repeat an earlier line of the corpus (see ``line_classes``); same columns.

    Lines of fewer than ``min_chars`` characters all stay, exact repeats too: in running text a closing brace, a heading or a
    table cell has its meaning from the lines around it. ``line_classes`` reports them with ``short``.

    A document that loses lines and keeps no word is dropped; one that had none before stays. Rows with a null key or text
    stay as they are. Other columns pass unchanged, whatever their names.
    """
    gone = line_classes(docs, edits, min_chars, key, text).filter(~F.col("kept"))
    gone = written(gone.groupBy(F.col(key).alias("_key")).agg(F.collect_set("line_no").alias("_gone")), "lines-gone")
    joined = docs.join(gone.hint("merge"), docs[key] == gone["_key"], "left")  # grows with the corpus: never broadcast
    left = F.when(gone["_gone"].isNull(), docs[text]).otherwise(without_lines(docs[text], gone["_gone"]))
    columns = [left.alias(c) if c == text else docs[c] for c in docs.columns]
    return joined.filter(gone["_gone"].isNull() | left.rlike(r"[^\x20\x09-\x0D]")).select(*columns)
