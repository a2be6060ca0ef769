"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

All terms of a bounded sample of labelled documents (the examples) count, with their document frequencies over all
documents. How much a term depends on the label only sets its weight: none is left out. Distinct example vectors lie in
blocks of neighbours; each term has its largest weight in each block, so a search bounds a block's best cosine and skips
blocks that cannot hold a nearer example. Texts are searched in batches. Votes weighted by distance are calibrated on the
examples, each judged without itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgeo.llm.common import map_arrow, slices, uniform_hash, written

# Labelled documents per class that the classifier is fitted on (expected number; a hash sample of all of them).
EXAMPLES = 1024

# Weight of a term that tells nothing of the label, and the chi-squared value at which a term has half of the full weight.
LEAST_WEIGHT = 0.02
HALF_CHI2 = 20.0

NEIGHBOURS = 25
BLOCK = 64
DENSE_SHARE = 1 / 32  # terms of more examples have a row of all examples' weights, others a list
BATCH = 256
PRIOR_VOTES = 1.0
EVIDENCE = 3

_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters (and of non-ASCII characters) as UTF-8."""
    return (text or "").lower().encode("utf-8", "replace").translate(_LETTERS).split()


def held_out(key: Column) -> Column:
    """The rows whose labels are never learned from; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _example_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, toxic, terms, counts`` of rows ``key, toxic, text``."""
    for batch in batches:
        for part in slices(batch, "text"):
            tf = [Counter(terms(t)) for t in part.column(2).to_pylist()]
            found = [pa.array([list(c) for c in tf], pa.list_(pa.binary())), pa.array([list(c.values()) for c in tf], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *found], names=["key", "toxic", "terms", "counts"])


def _frequencies(vocabulary):
    """``term, n, docs``: rows that hold each term of the vocabulary, one row per term and task; term -1 stands for all rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(vocabulary.value)}
        counts, docs = np.zeros(len(number), dtype=np.int64), 0
        for batch in batches:
            for part in slices(batch, "text"):
                ids: list[int] = []
                for text in part.column(0).to_pylist():
                    ids += [number[t] for t in set(terms(text)) if t in number]
                counts += np.bincount(np.array(ids, dtype=np.int64), minlength=len(counts))
                docs += part.num_rows
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(counts[at], docs))], names=["term", "n"])

    return run


def label_weights(present: list[np.ndarray], labels: np.ndarray, n_terms: int) -> np.ndarray:
    """For each term a weight from LEAST_WEIGHT up to about 1, by how much its presence depends on the label (chi-squared)."""
    n1, n0 = float(labels.sum()), float(len(labels) - labels.sum())
    if not n1 or not n0:
        return np.ones(n_terms)
    none = [np.zeros(0, dtype=np.int64)]
    a = np.bincount(np.concatenate(none + [p for p, y in zip(present, labels, strict=True) if y]), minlength=n_terms).astype(float)
    b = np.bincount(np.concatenate(none + [p for p, y in zip(present, labels, strict=True) if not y]), minlength=n_terms).astype(float)
    apart = a * (n0 - b) - b * (n1 - a)
    chi2 = apart**2 * (n1 + n0) / np.maximum((a + b) * (n1 + n0 - a - b) * n1 * n0, 1e-9)
    return LEAST_WEIGHT + chi2**2 / (chi2**2 + HALF_CHI2**2)


@dataclass
class Vectors:
    """Sparse vectors one after another: those of vector i are at ``ptr[i] : ptr[i + 1]``."""

    ptr: np.ndarray
    ids: np.ndarray
    weights: np.ndarray

    def __len__(self) -> int:
        return len(self.ptr) - 1

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.ptr))

    def part(self, start: int, end: int) -> Vectors:
        a, b = self.ptr[start], self.ptr[end]
        return Vectors(self.ptr[start : end + 1] - a, self.ids[a:b], self.weights[a:b])


def weighed(term_weight: np.ndarray, ids: list[np.ndarray], counts: list[np.ndarray]) -> Vectors:
    """Unit vectors of (1 + ln count) * the term's weight."""
    ptr = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64)
    flat = np.concatenate([np.zeros(0, dtype=np.int64), *ids])
    w = (1 + np.log(np.concatenate([np.ones(0), *counts]))) * term_weight[flat]
    rows = np.repeat(np.arange(len(ids)), np.diff(ptr))
    length = np.sqrt(np.bincount(rows, weights=w * w, minlength=len(ids)))
    return Vectors(ptr, flat, w / np.maximum(length[rows], 1e-300))


def _spread(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """start .. end - 1 for each pair, one after another."""
    n = ends - starts
    before = np.cumsum(n) - n
    return np.arange(int(n.sum())) - np.repeat(before - starts, n)


class _Postings:
    """Per term a list of (place, weight)."""

    def __init__(self, n_terms: int, term: np.ndarray, place: np.ndarray, weight: np.ndarray) -> None:
        order = np.lexsort((place, term))
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.place, self.weight = place[order], weight[order]

    def product(self, q: Vectors, places: int) -> np.ndarray:
        """[vector, place]: sums of products of the weights."""
        s, e = self.start[q.ids], self.start[q.ids + 1]
        at = _spread(s, e)
        cell = np.repeat(q.rows(), e - s) * places + self.place[at]
        return np.bincount(cell, weights=self.weight[at] * np.repeat(q.weights, e - s), minlength=len(q) * places).reshape(len(q), places)


class BlockMaxIndex:
    """Distinct example vectors (unit length) in order; ``toxic`` and ``clean`` are the votes of each."""

    def __init__(self, term_weight: np.ndarray, vectors: Vectors, toxic: np.ndarray, clean: np.ndarray, shown: list, own: dict) -> None:
        self.term_weight, self.vectors, self.toxic, self.clean, self.shown, self.own = term_weight, vectors, toxic, clean, shown, own
        self.slope, self.shift = 1.0, 0.0
        n, n_terms = len(vectors), len(term_weight)
        self.blocks = -(-n // BLOCK)
        rows = vectors.rows()
        listed = np.bincount(vectors.ids, minlength=n_terms)
        dense = np.flatnonzero(listed > max(BLOCK / 2, n * DENSE_SHARE))
        self.dense_row = np.full(n_terms, -1, dtype=np.int64)
        self.dense_row[dense] = np.arange(len(dense))
        common = self.dense_row[vectors.ids] >= 0
        self.full = np.zeros((len(dense), self.blocks * BLOCK))
        self.full[self.dense_row[vectors.ids[common]], rows[common]] = vectors.weights[common]
        self.full_max = self.full.reshape(len(dense), self.blocks, BLOCK).max(axis=2) if n else np.zeros((len(dense), 0))
        term, place, weight = vectors.ids[~common], rows[~common], vectors.weights[~common]
        self.rare = _Postings(n_terms, term, place, weight)
        # the largest weight of each term in each block
        key = term * max(1, self.blocks) + place // BLOCK
        order = np.lexsort((-weight, key))
        first = order[np.flatnonzero(np.diff(key[order], prepend=-1))]
        self.rare_max = _Postings(n_terms, term[first], place[first] // BLOCK, weight[first])
        empty = np.flatnonzero(np.diff(vectors.ptr) == 0)
        self.blank = int(empty[0]) if len(empty) else None  # the vector without terms

    @property
    def base(self) -> float:
        total = self.toxic.sum() + self.clean.sum()
        return float(self.toxic.sum() / total) if total else 0.0

    def nearest(self, q: Vectors, k: int = NEIGHBOURS) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector the k examples of the largest cosine above 0, exactly, and the cosines; ties to the smaller position."""
        out = []
        for start in range(0, len(q), BATCH):
            out += self._nearest(q.part(start, min(len(q), start + BATCH)), k)
        return out

    def _nearest(self, q: Vectors, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        n = self.blocks * BLOCK
        if not n:
            return [(np.zeros(0, dtype=np.int64), np.zeros(0))] * len(q)
        common = self.dense_row[q.ids] >= 0
        queries = np.zeros((len(q), len(self.full)))
        queries[q.rows()[common], self.dense_row[q.ids[common]]] = q.weights[common]
        bound = queries @ self.full_max + self.rare_max.product(q, self.blocks)
        rare = self.rare.product(q, n)
        score = np.zeros((len(q), n))
        done = np.zeros(bound.shape, dtype=bool)

        def evaluate(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(axis=0)).tolist():
                at, block = np.flatnonzero(wanted[:, b]), slice(b * BLOCK, (b + 1) * BLOCK)
                score[at, block] = queries[at] @ self.full[:, block] + rare[at, block]
            done[wanted] = True

        # the most promising block first: no block whose bound is below the k-th cosine found there can hold a nearer one
        leading = np.zeros(bound.shape, dtype=bool)
        leading[np.arange(len(q)), bound.argmax(axis=1)] = True
        evaluate(leading & (bound > 0))
        kth = np.partition(score, n - k, axis=1)[:, n - k] if n > k else np.zeros(len(q))
        evaluate(~done & (bound > 0) & (bound >= kth[:, None] - 1e-12))
        score = np.minimum(score, 1.0)
        order = np.argsort(-score, axis=1, kind="stable")[:, :k]
        best = np.take_along_axis(score, order, axis=1)
        return [(o[s > 0], s[s > 0]) for o, s in zip(order, best, strict=True)]

    def vote(self, best: np.ndarray, score: np.ndarray, own: tuple | None = None) -> float:
        """Share of toxic votes, weighted by closeness, smoothed by the share among all examples; without the row's own vote.
        Texts without terms have the examples without terms as theirs."""
        if not len(best) and self.blank is not None:
            best, score = np.array([self.blank]), np.ones(1)
        toxic, clean = self.toxic[best].copy(), self.clean[best].copy()
        if own is not None:
            mine = best == own[0]
            toxic[mine] -= own[1]
            clean[mine] -= own[2]
        closeness = 1.0 / (1.05 - score)
        return float(((closeness * toxic).sum() + PRIOR_VOTES * self.base) / ((closeness * (toxic + clean)).sum() + PRIOR_VOTES))

    def calibrated(self, vote: float) -> float:
        v = min(max(vote, 1e-4), 1 - 1e-4)
        return float(1 / (1 + np.exp(-(self.slope * np.log(v / (1 - v)) + self.shift))))


def build_index(idf: np.ndarray, examples: list[tuple]) -> BlockMaxIndex:
    """``examples``: (key, toxic, vote weight, term ids, counts). Fits the calibration on the examples, each without itself."""
    groups: dict[tuple, list] = {}
    for key, toxic, weight, ids, counts in sorted(examples, key=lambda x: (x[0] is None, x[0])):
        order = np.argsort(ids)
        groups.setdefault((tuple(np.asarray(ids)[order].tolist()), tuple(np.asarray(counts)[order].tolist())), []).append((key, toxic, weight))
    found = list(groups)
    # copies of a text are one observation of each label, however often it was copied
    seen = [(np.array(g[0], dtype=np.int64), y) for g in found for y in {x[1] for x in groups[g]}]
    term_weight = idf * label_weights([s[0] for s in seen], np.array([s[1] for s in seen]), len(idf))
    vectors = weighed(term_weight, [np.array(g[0], dtype=np.int64) for g in found], [np.array(g[1], dtype=float) for g in found])
    # neighbours in the order share their heaviest terms, so that blocks differ and bounds are tight
    heavy = [tuple(v.ids[np.argsort(-v.weights, kind="stable")][:8].tolist()) for v in (vectors.part(i, i + 1) for i in range(len(found)))]
    order = sorted(range(len(found)), key=lambda i: (heavy[i], found[i]))
    found = [found[i] for i in order]
    vectors = weighed(term_weight, [np.array(g[0], dtype=np.int64) for g in found], [np.array(g[1], dtype=float) for g in found])
    toxic, clean, own = np.zeros(len(found)), np.zeros(len(found)), {}
    for i, g in enumerate(found):
        for key, label, weight in groups[g]:
            toxic[i] += weight * label
            clean[i] += weight * (1 - label)
            own[key] = (i, weight * label, weight * (1 - label))
    index = BlockMaxIndex(term_weight, vectors, toxic, clean, [groups[g][0][0] for g in found], own)
    near = index.nearest(vectors)
    judged = [(index.vote(*near[own[key][0]], own[key]), label, weight) for g in found for key, label, weight in groups[g]]
    if len({j[1] for j in judged}) == 2:
        votes, labels, importance = (np.array(c, dtype=float) for c in zip(*judged, strict=True))
        index.slope, index.shift = platt(votes, labels, importance)
    return index


def platt(votes: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve on the votes' log-odds (Newton steps with a small ridge)."""
    v = np.clip(votes, 1e-4, 1 - 1e-4)
    x = np.stack([np.log(v / (1 - v)), np.ones(len(v))], axis=1)
    w = importance / importance.mean()
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (w * (labels - p)) - 1e-2 * (beta - [1.0, 0.0])
        step = np.linalg.solve((x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(2), gradient)
        beta = beta + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def _score(vocabulary, shared, key: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: BlockMaxIndex = shared.value
        number = {t: i for i, t in enumerate(vocabulary.value)}
        for batch in batches:
            kind = pa.list_(pa.struct([("example", batch.schema.field(0).type), ("similarity", pa.float64()), ("toxic_share", pa.float64())]))
            for part in slices(batch, "text"):
                texts: dict = {}  # copies are searched once
                at = [texts.setdefault(t or "", len(texts)) for t in part.column(1).to_pylist()]
                tf = [Counter(number[t] for t in terms(text) if t in number) for text in texts]
                ids = [np.array(sorted(c), dtype=np.int64) for c in tf]
                near = index.nearest(weighed(index.term_weight, ids, [np.array([c[i] for i in x.tolist()], dtype=float) for c, x in zip(tf, ids, strict=True)]))
                scores, evidence = [], []
                for k, i in zip(part.column(0).to_pylist(), at, strict=True):
                    own, (best, cosine) = index.own.get(k), near[i]
                    scores.append(round(index.calibrated(index.vote(best, cosine, own)), 6))
                    evidence.append(
                        [
                            {"example": index.shown[j], "similarity": round(float(s), 6), "toxic_share": round(float(index.toxic[j] / (index.toxic[j] + index.clean[j])), 6)}
                            for j, s in zip(best[: EVIDENCE + 1].tolist(), cosine.tolist())
                            if own is None or j != own[0]
                        ][:EVIDENCE]
                    )
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64()), pa.array(evidence, kind)], names=[key, "score", "evidence"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic", examples: int = EXAMPLES) -> DataFrame:
    """``key, held_out, score, predicted, evidence`` for every row of ``docs``.

    Learns from ``labels`` (``key, toxic``) of rows that are not held out: a hash sample of about ``examples`` documents per
    class, each weighing as many as it stands for. All their terms make the vocabulary; a text is its vector over it. No row
    is scored with its own label. A text without any of the terms, null and empty ones included, gets the calibrated share of
    toxic examples among those without terms. ``evidence``: the nearest examples (one key per distinct vector), their cosines
    and the share of toxic ones among them; equal cosines in order of the vectors. Repeated rows and null keys give one row
    each; several labels of a key count as the largest. Without labels of both classes the score is the share of toxic
    labels. Texts of any length are read whole; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    known = labels.filter(labels[toxic].isNotNull() & labels[key].isNotNull() & ~held_out(labels[key])).groupBy(labels[key].alias("_key")).agg(F.max(toxic).cast("int").alias("toxic"))
    known = written(known, "toxicity-labels")
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.coalesce(*[F.when(F.col("toxic") == c, F.lit(min(1.0, examples / m))) for c, m in n.items()], F.lit(0.0))
    chosen = written(known.filter(uniform_hash(F.col("_key"), F.lit(7)) < share), "toxicity-chosen")
    small = F.broadcast(chosen)  # about 2 * examples rows of a key and a label, whatever the input
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    sample = rows.join(small, F.col("key") == F.col("_key")).dropDuplicates(["key"]).select("key", "toxic", "text")
    taken = map_arrow(sample, _example_terms, f"key {kind}, toxic int, terms array<binary>, counts array<bigint>").collect()
    words = sorted({bytes(t) for r in taken for t in r["terms"]})  # the terms of about 2 * examples texts
    number = {t: i for i, t in enumerate(words)}
    vocabulary = spark.sparkContext.broadcast(words)
    counted = map_arrow(rows.select("text"), _frequencies(vocabulary), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = {r["term"]: r["n"] for r in counted.collect()}
    n_docs = df.pop(-1, 0)
    idf = np.log((1 + n_docs) / (1 + np.array([df.get(i, 0) for i in range(len(words))], dtype=float))) + 1
    weight = {c: max(1.0, m / examples) for c, m in n.items()}
    index = build_index(idf, [(r["key"], r["toxic"], weight[r["toxic"]], [number[bytes(t)] for t in r["terms"]], r["counts"]) for r in taken])
    schema = f"{key} {kind}, score double, evidence array<struct<example:{kind},similarity:double,toxic_share:double>>"
    scored = map_arrow(rows, _score(vocabulary, spark.sparkContext.broadcast(index), key), schema)
    return scored.select(key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
