"""Point in polygon by quadtree cells against the plain crossing count over all edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docgeo.operators import enrich as N

SCHEMA = "poly_id int, country string, continent string, rings array<array<struct<x:double,y:double>>>"


def star(n, x, y, radius, seed):
    rng = np.random.default_rng(seed)
    a = np.linspace(0, 2 * np.pi, n, endpoint=False)
    r = radius * rng.uniform(0.3, 1.0, n)
    ring = np.column_stack([x + r * np.cos(a), y + r * np.sin(a)])
    return np.vstack([ring, ring[:1]])


def edges_of(rings):
    return np.concatenate([np.column_stack([r[:-1], r[1:]]) for r in map(np.asarray, rings)])


def plainly_inside(edges, lon, lat):
    x1, y1, x2, y2 = edges.T
    cross = (y1[:, None] > lat) != (y2[:, None] > lat)
    with np.errstate(divide="ignore", invalid="ignore"):
        x = (x2 - x1)[:, None] * (lat - y1[:, None]) / (y2 - y1)[:, None] + x1[:, None]
    return (cross & (lon < x)).sum(axis=0) % 2 == 1


SQUARE = [(0.0, 0.0), (20.0, 0.0), (20.0, 20.0), (0.0, 20.0), (0.0, 0.0)]
HOLE = [(5.0, 5.0), (10.0, 5.0), (10.0, 10.0), (5.0, 10.0), (5.0, 5.0)]
SHAPES = {
    "star": [star(300, 12.0, 7.0, 25.0, 1)],
    "small": [star(50, 3.3, 3.3, 0.01, 2)],
    "grid lines": [SQUARE, HOLE],
    "parts": [star(80, -60.0, 10.0, 8.0, 3), star(80, 60.0, 10.0, 8.0, 4), star(40, -60.0, 10.0, 1.5, 5)],
    "crossing itself": [[(0.0, 0.0), (30.0, 30.0), (30.0, 0.0), (0.0, 30.0), (0.0, 0.0)]],
}


def in_cells(edges, size, lon, lat):
    cells = {}
    for level, cx, cy, odd, ys, near in N.quadtree(edges, size):
        assert cells.setdefault((level, cx, cy), (odd, ys, near))[1] is ys  # every cell once
    out = np.zeros(len(lon), dtype=int)
    for level in {c[0] for c in cells}:
        at = np.floor(np.column_stack([lon, lat]) / size * 2.0**level).astype(int)
        for i, (cx, cy) in enumerate(at.tolist()):
            if (level, cx, cy) in cells:
                odd, ys, near = cells[level, cx, cy]
                inside = plainly_inside(near, lon[i : i + 1], lat[i : i + 1])[0] if len(near) else False
                out[i] += (odd + int((ys > lat[i]).sum()) + int(inside)) % 2
    return out


@pytest.mark.parametrize("name", SHAPES)
@pytest.mark.parametrize("size", [10.0, 0.7])
def test_quadtree_equals_the_plain_count(name, size):
    rings = SHAPES[name]
    edges = edges_of(rings)
    edges = edges[edges[:, 1] != edges[:, 3]]
    low, high = edges.reshape(-1, 2).min(axis=0) - 1e-3, edges.reshape(-1, 2).max(axis=0) + 1e-3
    if size < 1 and (high - low).max() > 60:
        pytest.skip("thousands of cells inside")
    rng = np.random.default_rng(9)
    points = rng.uniform(low, high, (1500, 2))
    corners = np.concatenate([np.asarray(r) for r in rings])  # on vertices, level with vertices, and on grid lines
    mixed = np.column_stack([rng.choice(corners[:, 0], 300), rng.choice(corners[:, 1], 300)])
    grid = np.column_stack([rng.integers(-3, 4, 300) * size, rng.integers(-3, 4, 300) * size])
    points = np.concatenate([points, corners, mixed, grid])
    lon, lat = points.T
    assert np.array_equal(in_cells(edges, size, lon, lat), plainly_inside(edges, lon, lat).astype(int))


def test_what_is_stored_grows_with_the_boundary():
    """A polygon of a hundred thousand vertices: edges in all cells together, not cells times edges."""
    edges = edges_of([star(3000, 10.0, 10.0, 40.0, 6)])  # spikes longer than cells: dividing stops
    near = [len(c[5]) for c in N.quadtree(edges, 10.0)]
    assert sum(near) < 20 * len(edges)
    smooth = np.column_stack([10 + 40 * np.cos(np.linspace(0, 2 * np.pi, 100_001)), 10 + 40 * np.sin(np.linspace(0, 2 * np.pi, 100_001))])
    near = [len(c[5]) for c in N.quadtree(edges_of([smooth]), 10.0)]
    assert sum(near) < 1.3 * 100_000 and max(near) <= N.LEAF_EDGES


def test_locate_points_of_a_large_polygon(spark):
    a = np.linspace(0, 2 * np.pi, 100_001)
    r = 40 + np.sin(40 * a) + 0.01 * np.sin(9000 * a)
    ring = np.column_stack([10 + r * np.cos(a), 10 + r * np.sin(a)])
    ring[-1] = ring[0]
    rows = [(2, "big", "X", [[{"x": float(x), "y": float(y)} for x, y in ring]]), (1, "square", "Y", [[{"x": x, "y": y} for x, y in SQUARE]]), (3, "none", "Z", None)]
    rng = np.random.default_rng(8)
    points = rng.uniform(-35, 55, (3000, 2))
    df = spark.createDataFrame([(float(y), float(x)) for x, y in points] + [(None, 1.0)], "lat double, lon double")
    got = {(r["lat"], r["lon"]): r["country"] for r in N.locate_points(df, spark.createDataFrame(rows, SCHEMA)).collect()}
    big, square = (plainly_inside(edges_of([r]), points[:, 0], points[:, 1]) for r in (ring, SQUARE))
    want = {(y, x): "square" if s else "big" if b else None for (x, y), b, s in zip(points.tolist(), big, square)}
    assert got == want and set(want.values()) == {"square", "big", None}


def test_a_ring_left_open_is_closed(spark):
    ring = [{"x": x, "y": y} for x, y in SQUARE]
    df = spark.createDataFrame([(1.0, -30.0), (1.0, 3.0), (21.0, 3.0)], "lat double, lon double")
    for rings in ([ring], [ring[:-1]]):
        out = N.locate_points(df, spark.createDataFrame([(1, "A", "X", rings)], SCHEMA)).collect()
        assert {(r["lat"], r["lon"]): r["country"] for r in out} == {(1.0, -30.0): None, (1.0, 3.0): "A", (21.0, 3.0): None}


def test_no_boundaries(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "lat double, lon double")
    out = N.enrich(df, spark.createDataFrame([], SCHEMA))
    assert [tuple(r) for r in out.select("lat", "country", "continent").collect()] == [(1.0, None, None)]
    assert out.where(F.col("country").isNotNull()).count() == 0
