from __future__ import annotations

import datetime as dt

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tripmill.functions.places import hash_id
from tripmill.operators import checks
from tripmill.operators.upsert import upsert
from tripmill.plans import dims, extracts, facts, marts

DAY = dt.datetime(2024, 1, 1)
P1 = '{"type":"Point","coordinates":[-87.6,41.8]}'
P2 = '{"type":"Point","coordinates":[-87.7,41.9]}'


def staged(spark, rows):
    base = dict(
        trip_id="t", trip_start_timestamp=DAY, trip_seconds=600.0, trip_miles=2.0, fare=10.0, pickup_location_id="p",
        dropoff_location_id="d",
    )
    schema = (
        "trip_id string, trip_start_timestamp timestamp_ntz, trip_seconds double, trip_miles double, fare double, "
        "pickup_location_id string, dropoff_location_id string"
    )
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schema)


def test_fact_rules(spark):
    rows = [
        dict(trip_id="ok"), dict(trip_id="fare0", fare=0.0), dict(trip_id="fare?", fare=None),
        dict(trip_id="s60", trip_seconds=60.0), dict(trip_id="s60.5", trip_seconds=60.5), dict(trip_id="s61.5", trip_seconds=61.5),
        dict(trip_id="s?", trip_seconds=None), dict(trip_id="m0", trip_miles=0.0), dict(trip_id="m?", trip_miles=None),
        dict(trip_id="badp", pickup_location_id="bad"), dict(trip_id="badd", dropoff_location_id="bad"),
        dict(trip_id="nop", pickup_location_id=None), dict(trip_id="nod", dropoff_location_id=None),
        dict(trip_id="before", trip_start_timestamp=DAY - dt.timedelta(microseconds=1)),
        dict(trip_id="last", trip_start_timestamp=DAY + dt.timedelta(days=1, microseconds=-1)),
        dict(trip_id="end", trip_start_timestamp=DAY + dt.timedelta(days=1)),
    ]
    bad = spark.createDataFrame([("bad",)], "location_id string")
    out = facts.trip_rows(staged(spark, rows), bad, "2024-01-01T00:00:00", "2024-01-02T00:00:00")
    got = {r["trip_id"]: (r["trip_seconds"], r["rate_per_mile"], r["duration_minutes"]) for r in out.collect()}
    assert got == {
        "ok": (600, 5.0, 10.0), "s60.5": (60, 5.0, 60.5 / 60), "s61.5": (62, 5.0, 61.5 / 60),
        "m0": (600, 0.0, 10.0), "m?": (600, 0.0, 10.0), "last": (600, 5.0, 10.0),
    }


def test_extract_filters(spark):
    raw = spark.createDataFrame(
        [
            ("x-a0", "2024-01-01T00:00:00", "1.0", P1, P1), ("y-a0", "2024-01-01T01:00:00", "1", P1, P1),
            ("z-a1", "2024-01-01T00:30:00", "1.0", P1, P1), ("u-a0", "2024-01-01T00:30:00", "0.9", P1, P1),
            ("v-a0", "2024-01-01T00:30:00", "1.0", None, P1), ("w-a0", "2024-01-01T01:00:01", "1.0", P1, P1),
        ],
        "trip_id string, trip_start_timestamp string, percent_time_chicago string, "
        "pickup_centroid_location string, dropoff_centroid_location string",
    )
    kept = extracts.in_city_with_centroids(
        extracts.sampled_by_suffix(extracts.in_closed_range(raw, "trip_start_timestamp", "2024-01-01T00:00:00.000", "2024-01-01T01:00:00.000"))
    )
    assert tuples(kept, "trip_id") == [("x-a0",), ("y-a0",)]
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        extracts.typed(raw, {"trip_id": "string", "fare": "double"})


def test_location_dimension(spark):
    trips = spark.createDataFrame(
        [(P1, P2), (P2, P1), ("POINT (1 2)", None), (P1, "broken")], "pickup_centroid_location string, dropoff_centroid_location string"
    )
    dim = dims.locations_build(trips)
    assert dim.columns == ["location_id", "original_text", "longitude", "latitude", "source_type"]
    assert {r["original_text"]: (r["longitude"], r["latitude"]) for r in dim.collect()} == {
        P1: (-87.6, 41.8), P2: (-87.7, 41.9), "POINT (1 2)": (None, None), "broken": (None, None)
    }
    old = dim.where(F.col("original_text") == P1).withColumn("source_type", F.lit("old"))
    updated = dims.location_dimension(old, trips)
    assert updated.count() == 4
    assert tuples(updated.where("source_type = 'old'"), "original_text") == [(P1,)]
    assert dims.location_dimension(old, trips, "rebuild").where("source_type = 'old'").count() == 0
    assert dims.location_dimension(None, trips).count() == 4
    with pytest.raises(ValueError):
        dims.location_dimension(None, trips, "sometimes")
    keyed = dims.map_location_keys(trips, dim.where(F.col("original_text") != "broken"))
    assert keyed.columns == ["pickup_location_id", "dropoff_location_id"]
    assert keyed.where("dropoff_location_id IS NULL").count() == 2
    both = dims.hash_location_keys(trips).exceptAll(dims.map_location_keys(trips, dim))
    assert both.count() == 0


def test_location_ids_that_clash(spark):
    """Short ids: of several texts under one id the first stays, and stored rows win."""
    trips = spark.range(200).select(F.concat(F.lit("text "), F.col("id")).alias("pickup_centroid_location"))
    dim = dims.locations_build(trips, id_len=1)
    assert dim.count() == 16 and dim.select("location_id").distinct().count() == 16
    old = spark.createDataFrame([("0", "stored")], "location_id string, original_text string")
    updated = dims.locations_update(old, trips, id_len=1)
    assert tuples(updated.where("location_id = '0'"), "original_text") == [("stored",)]
    assert updated.count() == 16


def test_region_dimension(spark):
    traffic = spark.createDataFrame(
        [
            (1, "A", "-87.7", "-87.6", "41.8", "41.9"), (1, "A", "-87.7", "-87.6", "41.8", "41.9"),
            (1, "A", "-87.8", "-87.6", "41.8", "41.9"), (2, "B", "", "-87.6", "41.8", "41.9"),
            (3, "C", "x", "-87.6", "41.8", "41.9"), (4, "D", None, "-87.6", "41.8", "41.9"),
        ],
        "region_id int, region string, west string, east string, south string, north string",
    )
    built = dims.regions_build(traffic)
    (row,) = built.collect()
    assert (row.region_id, row.west) == (1, -87.8)
    assert row.geometry_wkt == "POLYGON ((-87.8 41.8, -87.6 41.8, -87.6 41.9, -87.8 41.9, -87.8 41.8))"
    old = built.withColumn("region", F.lit("old"))
    more = traffic.unionAll(spark.createDataFrame([(5, "E", "1", "2", "3", "4")], traffic.schema))
    assert tuples(dims.region_dimension(old, more), "region_id", "region") == [(1, "old"), (5, "E")]
    export = dims.regions_export(built, "b").first()
    assert (export.crs, export.batch_id) == ("EPSG:4326", "b") and 180 < export.area_km2 < 190


def test_map_and_invalid_locations(spark):
    at = [("in", -87.65, 41.85), ("edge", -87.7, 41.85), ("rim", -87.6, 41.85), ("out", -80.0, 41.85), ("null", None, None), ("two", -87.62, 41.85)]
    locations = spark.createDataFrame([(i, x, y, "b") for i, x, y in at], "location_id string, longitude double, latitude double, batch_id string")

    def box(w, e):
        return f"POLYGON (({w} 41.8, {e} 41.8, {e} 41.9, {w} 41.9, {w} 41.8))"

    regions = spark.createDataFrame([(7, box(-87.7, -87.6)), (3, box(-87.63, -87.6))], "region_id int, geometry_wkt string")
    zones = spark.createDataFrame([("S", box(-88, -87))], "station_id string, geometry_wkt string")
    boundary = spark.createDataFrame([(1, box(-87.9, -87.6))], "boundary_id int, geometry_wkt string")
    mapped = {r["location_id"]: (r["region_id"], r["station_id"]) for r in dims.map_locations(locations, regions, zones).collect()}
    assert mapped == {"in": (7, "S"), "edge": (None, "S"), "rim": (None, "S"), "out": (None, None), "null": (None, None), "two": (3, "S")}
    assert tuples(dims.invalid_locations(locations, boundary), "location_id") == [("null",), ("out",), ("rim",)]


def test_boundary_and_stations(spark):
    with pytest.raises(checks.CheckFailed):
        dims.city_boundary_table(spark.createDataFrame([("POINT (1 2)",)], "geometry_wkt string"))
    stations = dims.stations_table(dims.default_stations(spark)).orderBy("station_id").collect()
    assert [r.station_id for r in stations] == ["Estacion_A", "Estacion_B", "Estacion_C", "Estacion_D"]
    assert str(stations[0].longitude) == "-87.6550000" and stations[0].geometry_wkt == "POINT (-87.655 41.97)"
    bad = dims.stations_table(spark.createDataFrame([("s", -187.0, 41.0)], "station_id string, longitude double, latitude double"))
    assert checks.station_range_rows(bad).count() == 1
    with pytest.raises(checks.CheckFailed):
        dims.require_crs(spark.createDataFrame([("EPSG:26916",)], "crs string"))


def test_upsert_modes(spark):
    target = spark.createDataFrame([("a", 1, 10), ("b", 2, 20), ("c", None, 30)], "k string, v int, w int")
    source = spark.createDataFrame([("b", None, 99), ("c", 3, 98), ("d", 4, 97)], "k string, v int, w int")
    assert tuples(upsert(target, source, "k", ["v"])) == [("a", 1, 10), ("b", None, 20), ("c", 3, 30), ("d", 4, 97)]
    assert tuples(upsert(target, source, "k", ["v"], "coalesce")) == [("a", 1, 10), ("b", 2, 20), ("c", 3, 30), ("d", 4, 97)]
    once = upsert(target, source, "k", ["v", "w"])
    assert tuples(upsert(once, source, "k", ["v", "w"])) == tuples(once)


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k string, v int")
    assert {r["k"] for r in checks.duplicate_key_rows(df, "k").collect()} == {"a", None}
    with pytest.raises(checks.CheckFailed, match="not a key"):
        checks.require_unique(df, "k", name="t")
    checks.require_unique(df, "v")
    parent = spark.createDataFrame([("a",)], "id string")
    assert tuples(checks.orphan_rows(df, "k", parent, "id"), "v") == [(4,)]
    with pytest.raises(checks.CheckFailed):
        checks.count_gate(df.limit(0), "t")
    with pytest.raises(checks.CheckFailed):
        checks.require_rows(df.limit(0), "t")
    assert checks.count_gate(df, "t") == 4


def test_hourly_pickup(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 5, 59, 59), 1, 2.0, 4.0), ("b", dt.datetime(2024, 1, 1, 5, 0), 1, None, 6.0), ("c", DAY, None, 1.0, 1.0)]
    df = spark.createDataFrame(
        rows, "trip_id string, trip_start_timestamp timestamp_ntz, pickup_community_area int, rate_per_mile double, duration_minutes double"
    )
    assert tuples(marts.hourly_pickup(df)) == [(dt.datetime(2024, 1, 1, 5), 1, 2, 2.0, 5.0)]


def test_hash_length(spark):
    assert len(spark.range(1).select(hash_id(F.lit("x"), 20)).first()[0]) == 20
