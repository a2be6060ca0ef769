"""Confidence by clustering each document's distances to its frequency-weighted centroid.

Per document: weighted centroid of lat/lon, haversine distance of every place to it, 1-D k-means on the distances
with k = 2, then 3..5 while the between-cluster sum of squares grows by at least the gain factor; places in the
cluster nearest the centroid get 1, the others 0. Documents with two or fewer distinct distances get 1 everywhere.

The random-start k-means of the workflow is replaced by the exact optimum (dynamic programming over the sorted
distinct distances, where optimal 1-D clusters are contiguous), so results are deterministic. The nearest
cluster is then a prefix of the sorted distances: confidence is ``distance <= cut``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgeo.functions.geo import haversine_km
from docgeo.session import ship_package

# Fixed values of the workflow: largest k tried, required gain of between-SS to accept one more cluster.
MAX_K = 5
GAIN = 1.15
# Documents with at most so many distinct distances are clustered together, so many cells of their tables at a time.
MANY = 64
CELLS = 1 << 18

DISTANCE_DECIMALS = 6  # distances are compared after rounding to 1 mm, so engines agree on distinctness


def centroids(doc_geo: DataFrame) -> DataFrame:
    """(doc_id, c_lat, c_lon): frequency-weighted mean degrees of the places that have both coordinates.

    Exact decimal sums, added up in every task before they are shuffled: a document with very many places sends one row
    per task, and runs (and engines) agree however the rows were split.
    """
    f = F.col("frequency").cast("decimal(12,0)")
    known = doc_geo.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    sums = known.groupBy("doc_id").agg(
        F.sum("frequency").cast("double").alias("weight"),
        *[F.sum(F.col(c).cast("decimal(20,9)") * f).cast("double").alias(c) for c in ("lat", "lon")],
    )
    return sums.select("doc_id", (F.col("lat") / F.col("weight")).alias("c_lat"), (F.col("lon") / F.col("weight")).alias("c_lon"))


def centroid_distance(doc_geo: DataFrame) -> DataFrame:
    """doc_geo + c_lat, c_lon (frequency-weighted mean degrees) + distance_km (rounded to 6 decimals).

    A place that lacks a coordinate takes no part in the centroid and has no distance (NULL). The centroids, one row per
    document, are joined back; no window holds a document's rows together, and AQE splits the join for a large one.
    """
    distance = haversine_km(F.col("lat"), F.col("lon"), F.col("c_lat"), F.col("c_lon"))
    joined = doc_geo.join(centroids(doc_geo), "doc_id", "left").select(*doc_geo.columns, "c_lat", "c_lon")
    return joined.withColumn("distance_km", F.round(distance, DISTANCE_DECIMALS))


def _dc_dp(x: np.ndarray, m: np.ndarray, kmax: int):
    """best[k][b], arg[k][b] for prefix sums, by divide and conquer over the monotone split points, O(k n log n)."""
    n = len(x)
    M = np.concatenate([[0.0], np.cumsum(m)])
    S = np.concatenate([[0.0], np.cumsum(m * x)])
    best = np.full((kmax + 1, n + 1), -np.inf)
    arg = np.zeros((kmax + 1, n + 1), dtype=np.int64)
    bb = np.arange(1, n + 1)
    best[1, 1:] = S[bb] ** 2 / M[bb]
    for k in range(2, kmax + 1):
        prev = best[k - 1]
        stack = [(k, n, k - 1, n - 1)]
        while stack:
            lo, hi, olo, ohi = stack.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            aa = np.arange(olo, min(ohi, mid - 1) + 1)
            vals = prev[aa] + (S[mid] - S[aa]) ** 2 / (M[mid] - M[aa])
            j = int(np.argmax(vals))
            best[k, mid] = vals[j]
            arg[k, mid] = aa[j]
            stack.append((lo, mid - 1, olo, aa[j]))
            stack.append((mid + 1, hi, aa[j], ohi))
    return best, arg, M, S


def choose_cut(d: np.ndarray, m: np.ndarray, max_k: int = MAX_K, gain: float = GAIN) -> float:
    """Largest distance of the cluster nearest the centroid; ``inf`` when every place gets confidence 1.

    ``d``: sorted distinct distances, ``m``: how many places have each distance.
    """
    n = len(d)
    n_rows = int(m.sum())
    if n <= 2:
        return float("inf")
    kmax = max(2, min(max_k, n_rows - 1, n))
    x = d - float((m * d).sum() / m.sum())  # centre before squaring
    best, arg, M, S = _dc_dp(x, m.astype(float), kmax)
    total = S[n] ** 2 / M[n]
    between = {k: best[k][n] - total for k in range(2, kmax + 1)}
    k = 2
    if n_rows > 3:
        for kk in range(3, kmax + 1):
            if between[kk] < gain * between[k]:
                break
            k = kk
    b = n
    for j in range(k, 1, -1):
        b = int(arg[j][b])
    return float(d[b - 1])


def choose_cuts(d: np.ndarray, m: np.ndarray, max_k: int = MAX_K, gain: float = GAIN) -> np.ndarray:
    """``choose_cut`` of many documents at once that have the same number of distinct distances (one per row)."""
    g, n = d.shape
    if n <= 2:
        return np.full(g, np.inf)
    n_rows = m.sum(axis=1)
    kmax = np.maximum(2, np.minimum(np.minimum(max_k, n_rows.astype(int) - 1), n))
    x = d - ((m * d).sum(axis=1) / n_rows)[:, None]
    zero = np.zeros((g, 1))
    M = np.concatenate([zero, np.cumsum(m, axis=1)], axis=1)
    S = np.concatenate([zero, np.cumsum(m * x, axis=1)], axis=1)
    later = np.arange(n + 1)[:, None] < np.arange(n + 1)  # [a, b]: the last cluster holds the distances a to b - 1
    weight = np.where(later, M[:, None, :] - M[:, :, None], 1.0)
    cost = np.where(later, (S[:, None, :] - S[:, :, None]) ** 2 / weight, -np.inf)
    best, args = cost[:, 0, :], {}
    total, k, going = S[:, n] ** 2 / M[:, n], np.full(g, 2), n_rows > 3
    chosen = None
    for kk in range(2, int(kmax.max()) + 1):
        vals = best[:, :, None] + cost
        args[kk] = vals.argmax(axis=1)
        best = np.take_along_axis(vals, args[kk][:, None, :], axis=1)[:, 0, :]
        between = best[:, n] - total
        if chosen is None:
            chosen = between
            continue
        going &= (kk <= kmax) & ~(between < gain * chosen)
        k, chosen = np.where(going, kk, k), np.where(going, between, chosen)
    end, rows = np.full(g, n), np.arange(g)
    for kk in range(int(k.max()), 1, -1):
        end = np.where(kk <= k, args[kk][rows, end], end)
    return d[rows, end - 1]


def _cuts_of(pdf: pd.DataFrame, max_k: int, gain: float) -> pd.DataFrame:
    """Cut per document for rows sorted by (doc_id, distance_km): documents with few distinct distances by their number."""
    doc = pdf["doc_id"].to_numpy()
    d = pdf["distance_km"].to_numpy(float)
    m = pdf["m"].to_numpy(float)
    starts = np.concatenate([[0], np.flatnonzero(doc[1:] != doc[:-1]) + 1])
    sizes = np.diff(np.append(starts, len(doc)))
    cuts = np.empty(len(starts))
    for n in np.unique(sizes):
        which = np.flatnonzero(sizes == n)
        if n > MANY:
            cuts[which] = [choose_cut(d[a : a + n], m[a : a + n], max_k, gain) for a in starts[which]]
            continue
        for part in np.array_split(which, -(-len(which) * (n + 1) ** 2 // CELLS)):
            at = starts[part][:, None] + np.arange(n)
            cuts[part] = choose_cuts(d[at], m[at], max_k, gain)
    return pd.DataFrame({"doc_id": doc[starts], "cut": cuts})


def _cut_batches(max_k: int, gain: float):
    """mapInPandas body over rows partitioned by doc_id and sorted by (doc_id, distance): many documents per Arrow
    batch; a document cut by a batch boundary is carried into the next batch."""

    def run(batches):
        carry = None
        for pdf in batches:
            if carry is not None and len(carry):
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if len(pdf) == 0:
                continue
            last = pdf["doc_id"].iloc[-1]
            tail = (pdf["doc_id"] == last).to_numpy()
            carry = pdf[tail]
            done = pdf[~tail]
            if len(done):
                yield _cuts_of(done, max_k, gain)
        if carry is not None and len(carry):
            yield _cuts_of(carry, max_k, gain)

    return run


def cluster_confidence(doc_geo: DataFrame, max_k: int = MAX_K, gain: float = GAIN) -> DataFrame:
    """doc_geo + c_lat, c_lon, distance_km, confidence (1.0 inside the cluster nearest the centroid, else 0.0;
    0.0 without a coordinate).

    Python sees only (doc_id, distinct distance, multiplicity) through Arrow: the rows are hash-partitioned by
    doc_id and sorted, and each Arrow batch carries many documents (no per-group round trip). A document's group
    is its distinct geocoded distances, bounded by the location cache. The cut comes back as one row per document
    and is joined on doc_id.
    """
    ship_package(doc_geo.sparkSession)
    d = centroid_distance(doc_geo)
    groups = d.where(F.col("distance_km").isNotNull()).groupBy("doc_id", "distance_km").agg(F.count(F.lit(1)).cast("double").alias("m"))
    cuts = (
        groups.repartition("doc_id")
        .sortWithinPartitions("doc_id", "distance_km")
        .mapInPandas(_cut_batches(max_k, gain), "doc_id long, cut double")
    )
    return d.join(cuts, "doc_id", "left").withColumn(
        "confidence", F.when(F.col("distance_km") <= F.col("cut"), F.lit(1.0)).otherwise(F.lit(0.0))
    ).drop("cut")
