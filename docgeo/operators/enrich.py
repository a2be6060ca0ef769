"""Country and continent from boundary polygons (point in polygon), and the file name of each row."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgeo.functions.geo import crossings
from docgeo.functions.text import file_id
from docgeo.session import cut_lineage, ship_package

CELL_DEGREES = 10.0

# A cell with more edges is divided into four, down to this level (cells of 1/4096 of the coarsest), as long as its parts
# hold no more edges than this times its own in all: dividing doesn't help where edges are longer than cells.
LEAF_EDGES = 16
MAX_LEVEL = 12
MAX_GROWTH = 4.0

CELL_SCHEMA = "level int, cx int, cy int, odd int, ys array<double>, edges array<struct<x1:double,y1:double,x2:double,y2:double>>"


def _odd_times(ys: np.ndarray) -> np.ndarray:
    found, n = np.unique(ys, return_counts=True)
    return found[n % 2 == 1]


def _narrowed(edges: np.ndarray, ys: np.ndarray, odd: int, x0: float, y0: float, size: float) -> tuple[np.ndarray, np.ndarray, int]:
    """What a ray to the right from a point of the cell at (x0, y0) can cross.

    Edges near the cell stay. Edges right of it are crossed whatever the point's x is: each then counts by its two ends' y
    alone, (y1 > lat) != (y2 > lat), so that only y values found an odd number of times matter (``ys``), and those above the
    cell always count (``odd``). Edges left, above or below never count.
    """
    slack = 1e-9 * size  # points are dealt to cells by rounded quotients: a little more than the cell is covered
    bottom, top, left, right = y0 - slack, y0 + size + slack, x0 - slack, x0 + size + slack
    x1, y1, x2, y2 = edges.T
    relevant = ~((y1 > top) & (y2 > top)) & ~((y1 <= bottom) & (y2 <= bottom)) & ~((x1 < left) & (x2 < left))
    beyond = relevant & (x1 > right) & (x2 > right)
    ys = _odd_times(np.concatenate([ys, y1[beyond], y2[beyond]]))
    odd ^= int(np.count_nonzero(ys > top)) & 1
    return edges[relevant & ~beyond], ys[(ys > bottom) & (ys <= top)], odd


def quadtree(edges: np.ndarray, size: float) -> Iterator[tuple[int, int, int, int, np.ndarray, np.ndarray]]:
    """(level, cx, cy, odd, ys, edges) of the cells of a polygon: those that its edges pass, with the edges near them, and
    those inside. What lies in no cell is outside. A cell of level n measures ``size / 2**n``."""
    if not len(edges):
        return
    low, high = edges.reshape(-1, 2).min(axis=0), edges.reshape(-1, 2).max(axis=0)
    level = 0
    while True:  # the coarsest cells needed, above level 0 if need be, so that no edge is looked at for every cell
        first, last = np.floor(low / size * 2.0**level), np.floor(high / size * 2.0**level)
        if np.all(last - first <= 1):
            break
        level -= 1
    empty = np.zeros(0)
    top = [(int(cx), int(cy)) for cx in np.unique([first[0], last[0]]) for cy in np.unique([first[1], last[1]])]

    def part(level: int, cx: int, cy: int, near: np.ndarray, ys: np.ndarray, odd: int) -> tuple:
        width = size / 2.0**level
        return level, cx, cy, *_narrowed(near, ys, odd, cx * width, cy * width, width)

    todo = [(part(level, cx, cy, edges, empty, 0), 1.0) for cx, cy in top]
    while todo:
        (level, cx, cy, near, ys, odd), grown = todo.pop()
        if not len(near) and not len(ys) and not odd:
            continue
        if level < 0 or (len(near) > LEAF_EDGES and level < MAX_LEVEL):
            parts = [part(level + 1, 2 * cx + i, 2 * cy + j, near, ys, odd) for i in (0, 1) for j in (0, 1)]
            growth = grown * max(1.0, sum(len(p[3]) for p in parts) / max(1, len(near)))
            if level < 0 or growth <= MAX_GROWTH:
                todo += [(p, grown if level < 0 else growth) for p in parts]
                continue
        yield level, cx, cy, odd, ys, near


def _ring_edges(rings: pa.Scalar) -> np.ndarray:
    """Edges (x1, y1, x2, y2) between the points that follow each other in a ring, from the last one to the first too if the
    ring is left open, without level ones (no ray crosses them)."""
    out = [np.zeros((0, 4))]
    for ring in rings.values if rings.is_valid else []:
        if ring.is_valid and len(ring.values) > 1:
            x, y = (ring.values.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
            out.append(np.column_stack([x, y, np.roll(x, -1), np.roll(y, -1)]))  # a closed ring ends with an edge of no length
    edges = np.concatenate(out)
    return edges[np.isfinite(edges).all(axis=1) & (edges[:, 1] != edges[:, 3])]


def _divided(size: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge = pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")])
        for batch in batches:
            at = batch.schema.get_field_index("rings")
            for row in range(batch.num_rows):
                cells = list(quadtree(_ring_edges(batch.column(at)[row]), size))
                numbers = [pa.array([c[i] for c in cells], pa.int32()) for i in range(4)]
                ys = pa.array([c[4].tolist() for c in cells], pa.list_(pa.float64()))
                offsets = np.concatenate([[0], np.cumsum([len(c[5]) for c in cells])]).astype(np.int32)
                flat = np.concatenate([np.zeros((0, 4)), *[c[5] for c in cells]])
                near = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, i])) for i in range(4)], fields=list(edge)))
                same = [batch.column(i).take(pa.array(np.full(len(cells), row))) for i in range(at)]
                yield pa.RecordBatch.from_arrays([*same, *numbers, ys, near], names=[*batch.schema.names[:at], "level", "cx", "cy", "odd", "ys", "edges"])

    return run


def polygon_cells(boundaries: DataFrame, cell: float = CELL_DEGREES) -> DataFrame:
    """(poly_id, country, continent, level, cx, cy, odd, ys, edges): the quadtree cells of every polygon.

    A cell holds the edges near it only, so what is stored grows with the length of the boundaries; cells inside a polygon
    hold nothing but that. A polygon is divided by one task, which holds its edges.
    """
    ship_package(boundaries.sparkSession)
    kind = boundaries.schema["poly_id"].dataType.simpleString()
    rows = boundaries.select("poly_id", "country", "continent", "rings")
    return rows.mapInArrow(_divided(cell), f"poly_id {kind}, country string, continent string, {CELL_SCHEMA}")


def locate_points(points: DataFrame, boundaries: DataFrame, cell: float = CELL_DEGREES) -> DataFrame:
    """(lat, lon, country, continent) for the distinct points; even-odd rule, lowest poly_id wins, NULL outside.

    A point meets only the cells that hold it, one of each level there is (an equi-join; Catalyst broadcasts the cells if
    they are small enough), and is tested against the few edges near it.
    """
    pts = points.select("lat", "lon").where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).distinct()
    cells = cut_lineage(polygon_cells(boundaries, cell))
    levels = [r["level"] for r in cells.select("level").distinct().collect()]  # MAX_LEVEL + 1 at most
    lat, lon = F.col("lat"), F.col("lon")
    probe = pts.withColumn("level", F.explode(F.array(*[F.lit(n) for n in sorted(levels)]).cast("array<int>")))
    at = lambda v: F.floor(v / F.lit(cell) * F.pow(F.lit(2.0), F.col("level"))).cast("int")
    probe = probe.withColumns({"cx": at(lon), "cy": at(lat)})
    crossed = F.col("odd") + F.size(F.filter("ys", lambda y: y > lat)) + crossings(F.col("edges"), lon, lat)
    inside = (
        probe.join(cells, ["level", "cx", "cy"])
        .where(crossed % 2 == 1)
        .groupBy("lat", "lon")
        .agg(F.min_by(F.struct("country", "continent"), F.col("poly_id")).alias("p"))
        .select("lat", "lon", "p.country", "p.continent")
    )
    return pts.join(inside, ["lat", "lon"], "left")


def enrich(doc_geo: DataFrame, boundaries: DataFrame, cell: float = CELL_DEGREES) -> DataFrame:
    """doc_geo + country, continent (NULL outside every polygon). Rows keep their order-free identity."""
    located = locate_points(doc_geo, boundaries, cell)
    return doc_geo.join(located, ["lat", "lon"], "left")


def attach_file_names(doc_geo: DataFrame, docs: DataFrame, prefix: str | None = None) -> DataFrame:
    """Add ``file_name`` (directory prefix removed) from the corpus; the corpus side reads two columns only."""
    names = docs.select("doc_id", F.col("file_name").alias("_path"))
    if prefix is not None:
        names = names.withColumn("_path", file_id("_path", prefix))
    return doc_geo.join(names, "doc_id", "left").withColumnRenamed("_path", "file_name")
