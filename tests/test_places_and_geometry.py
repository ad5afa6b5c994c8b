from __future__ import annotations

import hashlib
import math
import random
import re

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tripmill.functions import geometry, instants, places
from tripmill.operators.checks import CheckFailed
from tripmill.operators.spatial import polygon_areas, polygon_edges
from tripmill.plans import dims

JSON_POINT = '{"type":"Point","coordinates":[-87.6298,41.8781]}'


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").orderBy("i")


def test_hash_id(spark):
    texts = ["a", "ñandú", ""]
    got = [r[0] for r in column(spark, texts).select(places.hash_id(F.col("v"))).collect()]
    assert got == [hashlib.sha1(t.encode()).hexdigest()[:16] for t in texts]


def test_geojson_point(spark):
    texts = [
        JSON_POINT,
        "{'type': 'Point', 'coordinates': [-87.6, 41.8]}",
        "POINT (-87.6 41.8)",
        '{"type":"LineString","coordinates":[1.0,2.0]}',
        '{"type":"Point","coordinates":[1.0]}',
        '{"type":"Point","coordinates":[1.0,2.0]} tail',
        "{broken",
        None,
    ]
    got = [tuple(r) for r in column(spark, texts).select(places.geojson_point(F.col("v")).alias("p")).select("p.*").collect()]
    assert got == [(-87.6298, 41.8781), (-87.6, 41.8)] + [(None, None)] * 6


def test_point_text_forms(spark):
    spaced = '{ "type": "Point", "coordinates": [ -87.6298, 41.8781 ] }'
    df = column(spark, [JSON_POINT, spaced, "POINT (1 2)"])
    assert [r[0] for r in df.select(places.point_text(F.col("v"))).collect()] == [JSON_POINT, spaced, "POINT (1 2)"]
    assert [r[0] for r in df.select(places.point_text(F.col("v"), "json")).collect()] == [JSON_POINT, JSON_POINT, "POINT (1 2)"]
    python = "{'type': 'Point', 'coordinates': [-87.6298, 41.8781]}"
    assert [r[0] for r in df.select(places.point_text(F.col("v"), "repr")).collect()] == [python, python, "POINT (1 2)"]


def snyder(lon, lat):
    """Transverse Mercator by Snyder (1987), eqs. 8-9, 8-10: another series than the one under test."""
    a, f = 6378137.0, 1 / 298.257222101
    e2 = 2 * f - f * f
    ep2 = e2 / (1 - e2)
    p, dl = math.radians(lat), math.radians(lon + 87)
    n = a / math.sqrt(1 - e2 * math.sin(p) ** 2)
    t, c, aa = math.tan(p) ** 2, ep2 * math.cos(p) ** 2, dl * math.cos(p)
    m = a * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * p
        - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * p)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * p)
        - (35 * e2**3 / 3072) * math.sin(6 * p)
    )
    x = 0.9996 * n * (aa + (1 - t + c) * aa**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * ep2) * aa**5 / 120)
    y = 0.9996 * (
        m
        + n * math.tan(p) * (aa**2 / 2 + (5 - t + 9 * c + 4 * c**2) * aa**4 / 24
                             + (61 - 58 * t + t**2 + 600 * c - 330 * ep2) * aa**6 / 720)
    )
    return 500000 + x, y


def test_utm_against_another_series_and_back(spark):
    spots = [(-87.655, 41.97), (-87.755, 41.97), (-87.58, 41.79), (-87.67, 41.75), (-87.0, 42.0), (-88.4, 41.2)]
    df = spark.createDataFrame(spots, "lon double, lat double")
    for r in df.select("lon", "lat", geometry.utm16n("lon", "lat").alias("p")).collect():
        assert (r.p.x, r.p.y) == pytest.approx(snyder(r.lon, r.lat), abs=2e-3)
        assert geometry.lonlat_from_utm16n(r.p.x, r.p.y) == pytest.approx((r.lon, r.lat), abs=1e-8)  # a millimetre


def test_wkt_edges_area_and_text(spark):
    wkts = [
        (1, "POLYGON ((-87.9 41.66, -87.83 41.66, -87.83 41.73, -87.9 41.73, -87.9 41.66))"),
        (2, "POLYGON ((-87.9 41.66,-87.83 41.66,-87.83 41.73,-87.9 41.73,-87.9 41.66),"
            "(-87.88 41.68,-87.85 41.68,-87.85 41.71,-87.88 41.71,-87.88 41.68))"),
        (3, "multipolygon(((0 0, 1 0, 0 1, 0 0)), ((5 5, 6 5, 5 6, 5 5), (5.1 5.1, 5.2 5.1, 5.1 5.2, 5.1 5.1)))"),
        (4, "POINT (1 2)"),
        (5, None),
    ]
    df = spark.createDataFrame(wkts, "id int, geometry_wkt string")
    counts = {tuple(r) for r in polygon_edges(df, "id").groupBy("id", "part", "ring").count().collect()}
    assert counts == {(1, 0, 0, 4), (2, 0, 0, 4), (2, 0, 1, 4), (3, 0, 0, 3), (3, 1, 0, 3), (3, 1, 1, 3)}
    km2 = {r["id"]: r["km2"] for r in polygon_areas(df, "id").where("id < 3").collect()}
    assert km2[1] == pytest.approx(45.27, abs=0.01)
    assert km2[1] - km2[2] == pytest.approx(45.27 * 9 / 49, abs=0.02)
    texts = df.withColumn("parts", geometry.wkt_parts("geometry_wkt")).select("id", geometry.wkt_of_parts("parts").alias("t"))
    back = {r["id"]: r["t"] for r in texts.where("id < 4").collect()}
    assert back[1] == "POLYGON ((-87.9 41.66, -87.83 41.66, -87.83 41.73, -87.9 41.73, -87.9 41.66))"
    assert back[3].startswith("MULTIPOLYGON (((0.0 0.0, 1.0 0.0, 0.0 1.0, 0.0 0.0)), ((5.0 5.0,")


def test_rectangle_with_a_missing_side(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, None)], "w double, s double, e double, n double")
    assert df.select(geometry.wkt_rectangle(*(F.col(c) for c in "wsen"))).first()[0] is None


def test_instants(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:59:59.999999' AS a, TIMESTAMP_NTZ'2024-03-03 02:00:00' AS b")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")  # 02:30 does not exist there on that day
    try:
        r = df.select(
            instants.hour_trunc(F.col("a")).cast("string").alias("h"),
            instants.day_of_week(F.col("a")).alias("d"),
            instants.epoch_diff(F.col("a"), F.col("b")).alias("s"),
            instants.seconds(F.col("a")).alias("e"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r.h, r.d) == ("2024-03-10 02:00:00", 0)
    assert r.s == pytest.approx(7 * 86400 + 3599.999999)
    assert r.e == pytest.approx(1710039599.999999, abs=1e-6)


def test_date_from_iso(spark):
    got = tuples(column(spark, ["2025-09-01T00:00:00.000", "nope", None]).select("i", instants.date_from_iso(F.col("v")).cast("string")))
    assert got == [(0, "2025-09-01"), (1, None), (2, None)]


def test_reprojection_there_and_back(spark):
    rng = random.Random(11)
    spots = [(rng.uniform(-90, -84), rng.uniform(-5, 80)) for _ in range(200)]
    rows = [(i, f"POINT ({x!r} {y!r})", "EPSG:4326") for i, (x, y) in enumerate(spots)]
    rows += [(1000, "POLYGON ((-87 41, -86 41, -86 42, -87 41), (-86.2 41.1, -86.1 41.1, -86.1 41.2, -86.2 41.1))", "EPSG:4326")]
    rows += [(1001, "MULTIPOLYGON (((-87 41, -86 41, -86 42, -87 41)), ((-88 41, -87.5 41, -87.5 42, -88 41)))", "EPSG:4326")]
    df = spark.createDataFrame(rows, "id int, geometry_wkt string, crs string")
    there = geometry.reprojected(df, "EPSG:26916")
    metres = {r["id"]: r["geometry_wkt"] for r in there.collect()}
    assert {r["crs"] for r in there.collect()} == {"EPSG:26916"}
    x, y = map(float, metres[0][7:-1].split())
    lon, lat = geometry.lonlat_from_utm16n(x, y)
    assert abs(lon - spots[0][0]) < 1e-8 and abs(lat - spots[0][1]) < 1e-8
    back = {r["id"]: r["geometry_wkt"] for r in geometry.reprojected(there).collect()}
    number = re.compile(r"-?[0-9.]+(?:E-?[0-9]+)?")
    for i, text, _ in rows:
        assert number.sub("n", back[i]) == number.sub("n", text)
        assert all(abs(float(a) - float(b)) < 1e-9 for a, b in zip(number.findall(back[i]), number.findall(text), strict=True))


def test_reprojection_of_other_systems(spark):
    rows = [(1, "POINT (1 2)", "EPSG:3857"), (2, "POINT (-87 41)", "EPSG:4326"), (3, "LINESTRING (0 0, 1 1)", "EPSG:26916"), (4, None, "EPSG:26916"), (5, "POINT (1 2)", None)]
    df = spark.createDataFrame(rows, "id int, geometry_wkt string, crs string")
    got = {r["id"]: (r["geometry_wkt"], r["crs"]) for r in geometry.reprojected(df).collect()}
    assert got == {1: (None, "EPSG:3857"), 2: ("POINT (-87 41)", "EPSG:4326"), 3: (None, "EPSG:4326"), 4: (None, "EPSG:4326"), 5: (None, None)}
    assert dims.in_degrees(df.where("id = 2"), spark.range(1))[1].columns == ["id"]
    for refused in ("id = 1", "id = 5"):
        with pytest.raises(CheckFailed):
            dims.in_degrees(df.where(refused))
