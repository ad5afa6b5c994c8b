from __future__ import annotations

import math
import random

import numpy as np
from conftest import tuples
from pyspark.sql import functions as F

from tripmill.functions.geometry import utm16n
from tripmill.operators import spatial
from tripmill.operators.nearest import nearest_site
from tripmill.operators import zones as zones_module
from tripmill.operators.zones import voronoi_zones
from tripmill.plans import dims

DONUT = (
    "MULTIPOLYGON (((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4)), ((20 0, 30 0, 25 8, 20 0)))"
)


def points(spark, spots):
    return spark.createDataFrame([(i, *xy) for i, xy in enumerate(spots)], "id int, longitude double, latitude double")


def polygons(spark, *wkts):
    return spark.createDataFrame(list(enumerate(wkts)), "poly int, geometry_wkt string")


def inside(spark, spots, *wkts):
    pairs = spatial.within_pairs(points(spark, spots), "id", polygons(spark, *wkts), "poly")
    return {(spots[r["id"]], r["poly"]) for r in pairs.collect()}


def test_strictly_inside_only(spark):
    good = [(1.0, 1.0), (5.0, 3.0), (25.0, 4.0), (9.999, 9.999)]
    bad = [
        (5.0, 5.0), (4.0, 5.0), (4.0, 4.0), (0.0, 5.0), (10.0, 5.0), (5.0, 0.0), (5.0, 10.0), (0.0, 0.0), (10.0, 10.0),
        (15.0, 5.0), (-1.0, 0.0), (11.0, 10.0), (25.0, 8.0), (22.5, 4.0), (25.0, 0.0), (None, 5.0), (5.0, None),
        (float("nan"), 1.0), (float("inf"), 1.0),
    ]
    assert inside(spark, good + bad, DONUT) == {(p, 0) for p in good}


def test_overlapping_polygons_and_left_join(spark):
    a, b = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))", "POLYGON ((2 2, 6 2, 6 6, 2 6, 2 2))"
    pts = points(spark, [(1.0, 1.0), (3.0, 3.0), (9.0, 9.0)])
    joined = spatial.join_within(pts, "id", polygons(spark, a, b), "poly")
    assert tuples(joined, "id", "poly") == [(0, 0), (1, 0), (1, 1), (2, None)]
    assert tuples(spatial.outside_of(pts, "id", polygons(spark, a, b), "poly"), "id") == [(2,)]


def test_shared_edge_of_parts_is_inside(spark):
    two = "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((2 0, 4 0, 4 2, 2 2, 2 0)))"
    assert inside(spark, [(2.0, 1.0), (2.0, 0.0), (2.0, 2.0), (1.0, 1.0), (3.0, 1.0)], two) == {
        ((2.0, 1.0), 0), ((1.0, 1.0), 0), ((3.0, 1.0), 0)
    }


def test_partly_shared_edge_of_parts_is_inside(spark):
    two = "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((2 0, 4 0, 4 1, 2 1, 2 0)), ((0 2, 1 2, 1 3, 0 3, 0 2)))"
    within = [(2.0, 0.5), (1.0, 1.0), (3.0, 0.5), (0.5, 2.0), (0.25, 2.5)]
    rim = [(2.0, 1.0), (2.0, 1.5), (2.0, 0.0), (1.0, 2.0), (1.5, 2.0), (0.0, 2.0), (4.0, 0.5)]
    assert {p for p, _ in inside(spark, within + rim, two)} == set(within)
    slanted = "MULTIPOLYGON (((0 0, 4 4, 0 4, 0 0)), ((1 1, 3 1, 3 3, 1 1)))"
    assert {p for p, _ in inside(spark, [(2.0, 2.0), (0.5, 0.5), (3.5, 3.5), (2.5, 1.5)], slanted)} == {(2.0, 2.0), (2.5, 1.5)}


def test_far_points_are_looked_up_too(spark):
    far = "POLYGON ((-3e9 -3e9, 3e9 -3e9, 3e9 3e9, -3e9 3e9, -3e9 -3e9))"
    assert {p for p, _ in inside(spark, [(2e9, 2e9), (4e9, 0.0), (float("-inf"), 0.0)], far)} == {(2e9, 2e9)}


def test_a_detailed_ring_has_few_bands_in_a_cell(spark):
    ring = [(math.cos(k * math.pi / 10_000), math.sin(k * math.pi / 10_000)) for k in range(20_000)]
    text = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in [*ring, ring[0]]) + "))"
    filed = spatial.filed_bands(spatial.polygon_bands(polygons(spark, text), "poly")).cache()
    cells = filed.groupBy("lx", "ly", "cx", "cy").count()
    assert cells.agg(F.max("count")).first()[0] <= 4
    assert filed.agg(F.max(F.size("edges"))).first()[0] <= 4 * spatial.BAND_EDGES
    assert filed.select("band").distinct().count() > 250


def test_no_polygons(spark):
    pts = points(spark, [(1.0, 1.0)])
    assert tuples(spatial.join_within(pts, "id", polygons(spark, "POINT (1 1)"), "poly"), "id", "poly") == [(0, None)]


def test_many_edges_against_brute_force(spark):
    """Stars of several hundred edges, so that bands are used, of very different sizes."""
    rng = random.Random(7)
    rings, texts = [], []
    for size in (0.001, 1.0, 50.0):
        ring = []
        for k in range(400):
            r = size * rng.uniform(0.4, 1.0)
            ring.append((r * math.cos(k * math.pi / 200), r * math.sin(k * math.pi / 200)))
        ring.append(ring[0])
        rings.append(ring)
        texts.append("POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "))")
    spots = [(rng.uniform(-1, 1) * s, rng.uniform(-1, 1) * s) for s in (0.001, 1.0, 50.0) for _ in range(300)]

    def odd(p, ring):
        n = 0
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > p[1]) != (y2 > p[1]) and p[0] < x1 + (p[1] - y1) / (y2 - y1) * (x2 - x1):
                n += 1
        return n % 2 == 1

    want = {(p, k) for p in spots for k, ring in enumerate(rings) if odd(p, ring)}
    assert inside(spark, spots, *texts) == want


def test_steep_edges_are_cut_into_upright_bands(spark):
    """A saw of 4000 teeth, each edge of which reaches through half its height: few edges a band, the same points inside."""
    rng = random.Random(5)
    teeth = [(k / 100, 1 + k * 37 % 100 / 50) for k in range(4000)]
    hole = [(5.05, 0.5), (9.05, 0.7), (9.0, 0.9), (5.0, 0.8), (5.05, 0.5)]
    rings = [[*teeth, (40.0, 0.0), (-0.5, 0.0), teeth[0]], hole]
    text = "POLYGON (" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + ")" for ring in rings) + ")"
    filed = spatial.polygon_bands(polygons(spark, text), "poly").cache()
    assert filed.agg(F.max(F.size("edges"))).first()[0] <= 4 * spatial.BAND_EDGES
    assert filed.agg(F.sum(F.size("edges"))).first()[0] <= 2 * 4006
    cuts = [r["lo"] for r in filed.select("lo").collect()]
    spots = [(rng.uniform(-1, 41), rng.uniform(-0.1, 3.1)) for _ in range(500)]
    spots += [(rng.choice(cuts), rng.uniform(0, 3)) for _ in range(200)] + teeth[::50] + [(x, 1.0) for x, _ in teeth[::40]] + hole
    spots = list(dict.fromkeys(spots))
    edges = [(*a, *b) for ring in rings for a, b in zip(ring, ring[1:])]

    def within(x, y):
        odd = sum((b > y) != (d > y) and x < a + (y - b) / (d - b) * (c - a) for a, b, c, d in edges) % 2
        return odd and not any(min(a, c) <= x <= max(a, c) and min(b, d) <= y <= max(b, d) and (c - a) * (y - b) == (d - b) * (x - a) for a, b, c, d in edges)

    assert inside(spark, spots, text) == {(p, 0) for p in spots if within(*p)}


def test_point_lookup_is_an_equi_join(spark):
    pts = points(spark, [(1.0, 1.0)])
    plan = spatial.within_pairs(pts, "id", polygons(spark, DONUT), "poly")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def brute(spots, sites):
    out = {}
    for i, (x, y) in enumerate(spots):
        if x is not None:
            out[i] = min((math.sqrt((x - sx) ** 2 + (y - sy) ** 2), s) for s, sx, sy in sites)[1]
    return out


def test_nearest_site(spark):
    """The grid search agrees with brute force, with a third of the sites in one spot."""
    rng = random.Random(3)
    sites = [(f"s{i:03d}", rng.uniform(0, 10), rng.uniform(0, 10)) for i in range(100)]
    sites += [(f"t{i:03d}", 5 + rng.uniform(0, 1e-5), 5 + rng.uniform(0, 1e-5)) for i in range(50)]
    sites += [("u0", 7.0, 7.0), ("u1", 7.0, 7.0)]
    spots = [(rng.uniform(-5, 15), rng.uniform(-5, 15)) for _ in range(300)] + [(7.0, 7.0), (5.0, 5.0), (None, 1.0)]
    df = spark.createDataFrame(sites, "site string, sx double, sy double")
    pts = points(spark, spots)
    for n in (len(sites), 12, 1):
        some = df.where(F.col("site").isin([s for s, _, _ in sites[:n]]))
        want = brute(spots, sites[:n])
        found = nearest_site(pts, "id", F.col("longitude"), F.col("latitude"), some, "site", F.col("sx"), F.col("sy"))
        got = {r["id"]: r["site"] for r in found.collect()}
        assert got.pop(len(spots) - 1) is None
        assert got == want
    none = nearest_site(pts, "id", F.col("longitude"), F.col("latitude"), df.limit(0), "site", F.col("sx"), F.col("sy"))
    assert {r["site"] for r in none.collect()} == {None}


def test_zones(spark):
    stations = dims.stations_table(dims.default_stations(spark))
    city = dims.city_boundary_table(
        spark.createDataFrame([("POLYGON ((-87.9 41.6, -87.5 41.6, -87.5 42.1, -87.9 42.1, -87.9 41.6))",)], "geometry_wkt string")
    )
    zones = voronoi_zones(stations, city)
    assert zones.count() == 4 and zones.where("area_km2 > 0").count() == 4
    # The zones tile the frame.
    xy = np.array([[r.p.x, r.p.y] for r in stations.select(utm16n("double(longitude)", "double(latitude)").alias("p")).collect()])
    low, high = xy.min(axis=0), xy.max(axis=0)
    margin = (high - low).max()
    frame = np.prod(high - low + 2 * margin) / 1e6
    total = zones.agg(F.sum("area_km2")).first()[0]
    assert abs(total - frame) < 0.05
    # Each station lies in its own zone only, and so does what is nearest to it.
    pairs = spatial.within_pairs(stations, "station_id", zones.withColumnRenamed("station_id", "zone"), "zone")
    assert {tuple(r) for r in pairs.collect()} == {(s, s) for s, _, _ in dims.STATIONS}
    rng = random.Random(1)
    spots = points(spark, [(rng.uniform(-87.9, -87.5), rng.uniform(41.6, 42.1)) for _ in range(400)])
    by_zone = {r["id"]: r["station_id"] for r in spatial.within_pairs(spots, "id", zones, "station_id").collect()}
    at = utm16n("double(longitude)", "double(latitude)")
    near = nearest_site(
        spots.withColumn("at", at), "id", F.col("at.x"), F.col("at.y"), stations.withColumn("at", at), "station_id",
        F.col("at.x"), F.col("at.y"),
    )
    differ = [r["id"] for r in near.collect() if by_zone.get(r["id"]) != r["station_id"]]
    assert len(differ) <= 2  # zone sides are straight in degrees, bisectors in metres


def test_zones_of_one_station(spark):
    one = dims.stations_table(spark.createDataFrame([("a", -87.6, 41.8)], "station_id string, longitude double, latitude double"))
    city = dims.city_boundary_table(spark.createDataFrame([("POLYGON ((-87.7 41.7, -87.5 41.7, -87.5 41.9, -87.7 41.9, -87.7 41.7))",)], "geometry_wkt string"))
    assert voronoi_zones(one, city).count() == 1


def test_zones_in_tiles(spark):
    """Scattered sites, a dense spot, a lattice and equal sites, settled in tiles of several sizes: the cells of a search over all sites."""
    rng = random.Random(3)
    sites = [(f"s{i}", rng.uniform(-88, -87.4), rng.uniform(41.5, 42.2)) for i in range(250)]
    sites += [(f"d{i}", -87.7 + rng.uniform(0, 1e-5), 41.8 + rng.uniform(0, 1e-5)) for i in range(60)]
    sites += [(f"g{i}", -87.6 + i % 6 * 0.001, 41.7 + i // 6 * 0.001) for i in range(36)] + [("e0", -87.5, 41.9), ("e1", -87.5, 41.9)]
    df = spark.createDataFrame(sites, "station_id string, longitude double, latitude double").repartition(3)
    at = {r[0]: np.array([r.p.x, r.p.y]) for r in df.select("station_id", utm16n("longitude", "latitude").alias("p")).collect()}
    spots = np.unique(np.array(list(at.values())), axis=0)
    frame = zones_module._frame((*spots.min(axis=0), *spots.max(axis=0)), None)
    want = {}
    for name, site in at.items():
        ring = zones_module._one_corner(zones_module._cell(site, spots[(spots != site).any(axis=1)], frame))
        x, y = (ring - ring[0]).T
        want[name] = (abs(np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y)) / 2 / 1e6, len(ring))
    got = {r["station_id"]: (r["area_km2"], r["geometry_wkt"].count(",")) for r in voronoi_zones(df, None, last=60, crowd=40).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k][0] - want[k][0]) < 0.006 and got[k][1] == want[k][1] for k in want)


def test_zones_are_numbered_in_order(spark):
    rows = [(f"z{i * 7919 % 500:03d}", "POLYGON EMPTY", 1.0, "EPSG:4326") for i in range(500)]
    zones = spark.createDataFrame(rows, "station_id string, geometry_wkt string, area_km2 double, crs string").repartition(7)
    got = [(r["station_id"], r["zone_id"]) for r in dims.zones_table(zones).collect()]
    assert sorted(got) == [(f"z{i:03d}", i + 1) for i in range(500)]
    plan = dims.zones_table(zones)._jdf.queryExecution().optimizedPlan().toString()
    assert all("windowspecdefinition(_range" in line for line in plan.splitlines() if "windowspecdefinition" in line)
