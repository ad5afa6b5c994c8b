from __future__ import annotations

import math
import random

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tripmill.operators import overlay
from tripmill.operators.overlay import dissolve
from tripmill.operators.spatial import polygon_edges, within_pairs
from tripmill.plans import dims


def ring(*points):
    return "(" + ", ".join(f"{x!r} {y!r}" for x, y in [*points, points[0]]) + ")"


def box(a, b, c, d):
    return ring((a, b), (c, b), (c, d), (a, d))


def polygon(*rings):
    return f"POLYGON ({', '.join(rings)})"


def shapes(spark, rows):
    """Per id: the union's area, its shells and its holes."""
    whole = dissolve(spark.createDataFrame(rows, "k int, geometry_wkt string").repartition(3), "k")
    edges = polygon_edges(whole, "k")
    area = edges.groupBy("k").agg(F.round(F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2, 6).alias("a"))
    rings = edges.select("k", "part", "ring").distinct().groupBy("k").agg(F.count(F.when(F.col("ring") == 0, 1)).alias("s"), F.count(F.when(F.col("ring") > 0, 1)).alias("h"))
    return {r["k"]: (r["a"], r["s"], r["h"]) for r in area.join(rings, "k").collect()}


def test_touching_overlapping_and_nested_parts(spark):
    rows = [
        (1, f"MULTIPOLYGON (({box(0, 0, 2, 2)}), ({box(1, 1, 3, 3)}))"),  # overlap
        (2, polygon(box(0, 0, 1, 1))), (2, polygon(box(1, 1, 2, 2))),  # a corner in common
        (3, polygon(box(0, 0, 3, 1))), (3, polygon(box(0, 2, 3, 3))), (3, polygon(box(0, 0, 1, 3))), (3, polygon(box(2, 0, 3, 3))),  # a hole between four
        (4, polygon(box(0, 0, 4, 4))), (4, polygon(box(1, 1, 2, 2))), (4, polygon(box(4, 1, 5, 2))),  # inside, and along a piece of an edge
        (5, "nothing"), (5, None), (6, polygon(box(0, 0, 4, 4), box(1, 1, 3, 3))), (6, polygon(box(1.5, 1.5, 2.5, 2.5))),  # an island in a hole
        (7, polygon(box(0, 0, 1, 1))), (7, polygon(box(0, 0, 1, 1))), (7, polygon(ring((0, 0), (0, 1), (1, 1), (1, 0)))),  # the same, both ways round
        (8, polygon(box(0, 0, 4, 4), box(1, 1, 3, 3))), (8, polygon(box(1, 1, 3, 3))),  # a hole filled
        (9, polygon(ring((0.1, 0.1), (0.4, 0.7), (0.1, 0.9)))), (9, polygon(ring((0.1, 0.1), (0.7, 0.2), (0.4, 0.7), (0.2, 0.3)))),  # a slanted edge, in pieces
    ]
    want = {1: (7, 1, 0), 2: (2, 2, 0), 3: (8, 1, 1), 4: (17, 1, 0), 6: (13, 2, 1), 7: (1, 1, 0), 8: (16, 1, 0)}
    got = shapes(spark, rows)
    nine = got.pop(9)
    assert got == want
    assert nine[1:] == (1, 0) and nine[0] == pytest.approx(0.12 + 0.165, abs=1e-6)  # side by side: their areas add up


def test_union_holds_what_any_part_holds(spark):
    """Random triangles: points of the union are the points of any part, and no edge is left inside."""
    rng = random.Random(4)
    rows, triangles = [], {}
    for k in range(3):
        for _ in range(12):
            x, y = rng.uniform(0, 6), rng.uniform(0, 6)
            t = [(x + 2.5 * math.cos(a), y + 2.5 * math.sin(a)) for a in sorted(rng.uniform(0, 2 * math.pi) for _ in range(3))]
            triangles.setdefault(k, []).append(t)
            rows.append((k, polygon(ring(*t))))

    def inside(p, t):
        turns = [(b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) for a, b in zip(t, t[1:] + t[:1], strict=True)]
        return min(turns) > 1e-9 or max(turns) < -1e-9

    whole = dissolve(spark.createDataFrame(rows, "k int, geometry_wkt string"), "k")
    spots = [(i, rng.uniform(-3, 9), rng.uniform(-3, 9)) for i in range(600)]
    points = spark.createDataFrame(spots, "id int, longitude double, latitude double")
    want = sorted((i, k) for i, x, y in spots for k, ts in triangles.items() if any(inside((x, y), t) for t in ts))
    assert tuples(within_pairs(points, "id", whole, "k", simple=True), "id", "k") == sorted(want, key=repr)
    middles = polygon_edges(whole, "k").select("k", ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y")).collect()
    assert middles and not any(inside((r["x"], r["y"]), t) for r in middles for t in triangles[r["k"]])


def test_boundary_without_inner_edges(spark):
    halves = [(polygon(box(-87.8, 41.7, -87.7, 41.9)),), (polygon(box(-87.7, 41.7, -87.6, 41.9)),), (polygon(box(-87.72, 41.8, -87.68, 41.95)),)]
    city = dims.city_boundary_table(spark.createDataFrame(halves, "geometry_wkt string")).collect()
    assert len(city) == 1 and city[0]["geometry_wkt"].startswith("POLYGON") and city[0]["geometry_wkt"].count("(") == 2
    # Strictly inside along what was the common edge.
    spot = spark.createDataFrame([("seam", -87.7, 41.75), ("rim", -87.8, 41.75)], "location_id string, longitude double, latitude double")
    table = spark.createDataFrame([(1, city[0]["geometry_wkt"])], "boundary_id int, geometry_wkt string")
    assert tuples(within_pairs(spot, "location_id", table, "boundary_id", simple=True), "location_id") == [("seam",)]


def test_nothing(spark):
    assert dissolve(spark.createDataFrame([], "k int, geometry_wkt string"), "k").count() == 0


def test_geometries_in_one_place_do_not_meet(spark, monkeypatch):
    """Pieces are looked up among the parts of their own geometry: as many pairs for each as for one alone."""
    found, plain = [], overlay.within_pairs

    def counted(*args, **options):
        pairs = plain(*args, **options)
        found.append(pairs.count())
        return pairs

    monkeypatch.setattr(overlay, "within_pairs", counted)
    boxes = [box(0, 0, 3, 3), box(1, 1, 4, 4), box(2, 0, 5, 2)]
    assert shapes(spark, [(1, polygon(b)) for b in boxes]) == {1: (17.0, 1, 0)}
    alone, found[:] = found[0], []
    assert shapes(spark, [(k, polygon(b)) for k in range(6) for b in boxes]) == {k: (17.0, 1, 0) for k in range(6)}
    assert alone > 0 and found[0] == 6 * alone
