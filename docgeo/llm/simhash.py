"""SimHash near-duplicates with BK-trees.

Distinct fingerprints are posted under keys of equal bit blocks: two fingerprints that differ in at most ``radius`` of
``blocks`` blocks agree in the others, so every link lies within one key. A key's fingerprints are cut into shards of
bounded size. Each shard becomes a BK-tree whose children are keyed by their Hamming distance to the parent; the tree of
a shard goes to all shards of its key, and a search follows only edges within the radius.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgeo.llm.common import cells, map_arrow, slices, written
from docgeo.llm.components import Forest, components

SEED = 42

# Fingerprints in a shard: what one BK-tree holds at most (8 bytes each).
SHARD = 8192

# Postings that a worker searches together (whole keys), and pairs of query and node it holds at a time.
BLOCK_ROWS = 1 << 17
FRONTIER = 1 << 20

_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_LANES = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the word shingles (repeats included); 0 without words."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)])
    lanes = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8) + _LANES
    counts = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits(2 * counts.ravel() > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp`` (the 64 bits as a signed long) of every whole text, without a shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                codes = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(codes.view(np.int64))], names=[key, "fp"])

    return map_arrow(docs.select(docs[key], docs[text].cast("string").alias("text")), run, f"{key} {docs.schema[key].dataType.simpleString()}, fp long")


def posting_keys(fp: Column, radius: int, blocks: int) -> Column:
    """One key for each choice of ``blocks - radius`` bit blocks: their bits, with the choice's number."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        mask -= (mask >> 63) << 64  # as a signed long
        keys.append(F.struct(F.lit(n).alias("choice"), fp.bitwiseAND(F.lit(mask)).alias("bits")))
    return F.array(*keys)


class BkForest:
    """BK-trees over arrays of codes: one tree for each group, built and searched level by level."""

    def __init__(self, codes: np.ndarray, group: np.ndarray) -> None:
        """``group`` is ascending; the codes of a group are distinct."""
        self.codes = codes
        first = np.flatnonzero(np.diff(group, prepend=-1))
        self.root_of = first[np.searchsorted(group[first], group)]
        rest = np.setdiff1d(np.arange(len(codes)), first, assume_unique=True)
        at = self.root_of[rest]
        edges: list[np.ndarray] = []
        children: list[np.ndarray] = []
        while len(rest):
            slot = at * 65 + np.bitwise_count(codes[rest] ^ codes[at]).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            rest, slot = rest[order], slot[order]
            opens = np.diff(slot, prepend=-1) != 0  # the first code at a new distance becomes the child
            child = rest[opens]
            edges.append(slot[opens])
            children.append(child)
            at = child[np.cumsum(opens) - 1][~opens]
            rest = rest[~opens]
        slots = np.concatenate(edges) if edges else np.zeros(0, dtype=np.int64)
        order = np.argsort(slots)
        self.slots = slots[order]
        self.children = (np.concatenate(children) if children else np.zeros(0, dtype=np.int64))[order]

    def search(self, queries: np.ndarray, start: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (position in ``queries``, node) within the radius, in batches; ``start``: the root for each query."""
        todo = [(np.arange(len(queries)), start)]
        while todo:
            who, node = todo.pop()
            if len(who) > FRONTIER:
                todo += [(who[i : i + FRONTIER], node[i : i + FRONTIER]) for i in range(0, len(who), FRONTIER)]
                continue
            distance = np.bitwise_count(queries[who] ^ self.codes[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield who[near], node[near]
            low = np.searchsorted(self.slots, node * 65 + np.maximum(distance - radius, 0))
            n = np.searchsorted(self.slots, node * 65 + np.minimum(distance + radius, 64), side="right") - low
            total = int(n.sum())
            if total:
                before = np.cumsum(n) - n
                todo.append((np.repeat(who, n), self.children[np.arange(total) - np.repeat(before - low, n)]))


def shard_links(codes: np.ndarray, cell: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within each cell, as pairs of codes.

    ``cell`` is ascending. Codes of side 0 or 2 are in the cell's tree; those of side 1 or 2 search it.
    """
    distinct, node = np.unique(codes, return_inverse=True)
    joined = Forest(len(distinct))
    in_tree, asks = side != 1, side != 0
    tree = BkForest(codes[in_tree], cell[in_tree])
    roots = cell[in_tree]
    opens = np.flatnonzero(np.diff(roots, prepend=-1))
    at = np.searchsorted(roots[opens], cell[asks])
    found = at < len(opens)
    found[found] &= roots[opens][at[found]] == cell[asks][found]
    asking, of_tree, of_asking = codes[asks][found], node[in_tree], node[asks][found]
    for who, hit in tree.search(asking, opens[at[found]], radius):
        joined.link(of_asking[who], of_tree[hit])
    moved = np.flatnonzero(joined.parent != np.arange(len(distinct)))
    return distinct[moved], distinct[joined.parent[moved]]


def _search_cells(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; whole cells are searched together, about BLOCK_ROWS rows at a time."""
        names = ["choice", "bits", "low", "high", "fp", "side"]
        held = [np.zeros(0, dtype=np.int64) for _ in names]

        def links(columns: list[np.ndarray]) -> pa.RecordBatch:
            turns = np.zeros(len(columns[0]), dtype=bool)
            for c in columns[:4]:
                turns |= np.diff(c, prepend=c[:1]) != 0
            a, b = shard_links(columns[4].view(np.uint64), np.cumsum(turns), columns[5], radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held = [np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)]) for i, h in enumerate(held)]
            if len(held[0]) >= BLOCK_ROWS:
                differs = np.zeros(len(held[0]), dtype=bool)
                for c in held[:4]:
                    differs |= c != c[-1]
                cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
                if cut:
                    yield links([h[:cut] for h in held])
                    held = [h[cut:] for h in held]
        if len(held[0]):
            yield links(held)

    return run


def fingerprint_links(fps: DataFrame, radius: int, blocks: int | None = None) -> DataFrame:
    """``a, b``: pairs of distinct fingerprints that connect all that differ in at most ``radius`` bits.

    ``fps`` has one row per distinct ``fp``. Only a spanning forest per task is returned, never all pairs of a group.
    ``blocks`` (radius + 1 at least) sets how fine the keys are: more blocks make longer keys and more postings, any value
    gives the same components. Radius + 1 suits up to about a hundred million fingerprints, radius + 3 billions.
    """
    posted = fps.select("fp", F.explode(posting_keys(F.col("fp"), radius, blocks or radius + 1)).alias("k")).select("fp", "k.choice", "k.bits")
    grid = cells(posted, ["choice", "bits"], "fp", SHARD, "simhash-crowded")
    key = ["choice", "bits", "low", "high"]
    rows = grid.repartition(*key).sortWithinPartitions(*key).select(*key, "fp", "side")
    return map_arrow(rows, _search_cells(radius), "a long, b long")


def simhash_classes(docs: DataFrame, shingle: int = 4, radius: int = 4, blocks: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp, component_id`` for every row: the smallest key that the row's fingerprint reaches over links.

    Words are runs of non-space (ASCII) after lower-casing A-Z. Null, empty and blank texts have the fingerprint zero and
    link like any other. Rows with a null key get their component too; ``component_id`` is null only if no row of the
    component has a key. Repeated rows give repeated results. Texts are read whole, whatever their length; an empty table gives
    no rows. Other columns are not read. Copies meet as one fingerprint
    (grouped minimum) before any search.
    """
    coded = written(fingerprints(docs, shingle, key, text), "simhash-codes")
    distinct = coded.groupBy("fp").agg(F.min(key).alias("first"))
    linked = components(fingerprint_links(distinct.select("fp"), radius, blocks), "a", "b", "simhash-links")
    reached = distinct.join(linked, distinct["fp"] == linked["node"]).select("fp", "root", "first")
    least = reached.groupBy("root").agg(F.min("first").alias("component_id"))
    moved = reached.join(least, "root").select("fp", "component_id")
    classes = written(distinct.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id")), "simhash-classes")
    return coded.join(classes, "fp").select(key, "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, blocks: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without those whose component has a smaller key.

    One document of each group stays: the one with the smallest key. Rows that repeat a key count as one document and stay
    or go together; rows with a null key stay.
    """
    gone = simhash_classes(docs, shingle, radius, blocks, key, text).filter(F.col(key) > F.col("component_id"))
    gone = written(gone.select(F.col(key).alias("_gone")).distinct(), "simhash-gone")
    return docs.join(gone, docs[key] == gone["_gone"], "left_anti")
