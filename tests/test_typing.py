"""Lenient typing: the fixture rows of the three feeds and the edges of each cast."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tripmill.functions import typing
from tripmill.plans.extracts import typed
from tripmill.plans.schemas import TRAFFIC, TRIPS, WEATHER

POINT = '{"type":"Point","coordinates":[-87.6298,41.8781]}'


def frame(spark, rows):
    return spark.createDataFrame(rows, typing.string_schema(list(rows[0])))


def trip(**changes):
    row = dict(
        trip_id="t1", batch_id="b", trip_start_timestamp="2025-01-15T10:30:00", trip_end_timestamp="2025-01-15T10:45:00",
        trip_seconds="900", trip_miles="2.5", percent_time_chicago="1.0", percent_distance_chicago="1.0",
        pickup_community_area="32", dropoff_community_area="28", trips_pooled="1", fare="12.50", tip="2.00",
        additional_charges="1.50", trip_total="16.00", shared_trip_authorized="true",
        pickup_centroid_location=POINT, dropoff_centroid_location=POINT,
    )
    return {**row, **changes}


def test_trips_clean_null_and_malformed(spark):
    nothing = {k: None for k in trip() if k not in ("trip_id", "batch_id")}
    bad = dict(trip_start_timestamp="not-a-date", trip_seconds="abc", fare="12.xx", shared_trip_authorized="maybe")
    rows = [trip(), trip(trip_id="t2", **nothing), trip(trip_id="t3", **bad)]
    clean, empty, broken = typed(frame(spark, rows), TRIPS).orderBy("trip_id").collect()
    assert list(clean.asDict()) == list(TRIPS)
    assert clean.trip_start_timestamp == dt.datetime(2025, 1, 15, 10, 30)
    assert (clean.trip_seconds, clean.trip_miles, clean.fare) == (900.0, 2.5, 12.5)
    assert (clean.pickup_community_area, clean.shared_trip_authorized) == (32, True)
    assert clean.pickup_centroid_location == POINT
    assert all(v is None for k, v in empty.asDict().items() if k not in ("trip_id", "batch_id"))
    assert all(broken[k] is None for k in bad)
    assert (broken.trip_miles, broken.tip, broken.trip_end_timestamp) == (2.5, 2.0, dt.datetime(2025, 1, 15, 10, 45))


def test_traffic(spark):
    row = dict(
        time="2025-09-01T10:00:00", region_id="1", bus_count="10", num_reads="100", region="North", record_id="r1",
        batch_id="b", speed="25.5",
    )
    bad = {**row, "time": "not-a-date", "region_id": "x", "speed": "fast", "bus_count": "10.5", "record_id": "r2"}
    good, broken = typed(frame(spark, [row, bad]), TRAFFIC).orderBy("record_id").collect()
    assert (good.time, good.region_id, good.speed) == (dt.datetime(2025, 9, 1, 10), 1, 25.5)
    assert (broken.time, broken.region_id, broken.speed, broken.bus_count) == (None, None, None, 10)


def test_weather(spark):
    row = dict(
        record_id="A_20250901", datetime="2025-09-01", station_id="A", temp="22.5", feelslike="21", precipprob="0",
        windspeed="12.3", winddir="180", conditions="Clear", batch_id="b",
    )
    bad = {**row, "record_id": "B", "datetime": "not-a-date", "temp": "high", "feelslike": "low", "windspeed": "fast"}
    good, broken = typed(frame(spark, [row, bad]), WEATHER).orderBy("record_id").collect()
    assert (good.datetime, good.temp, good.winddir) == (dt.datetime(2025, 9, 1), 22.5, "180")
    assert [broken[c] for c in ("datetime", "temp", "feelslike", "windspeed")] == [None] * 4


def test_cast_edges(spark):
    def run(cast, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r[0] for r in df.orderBy("i").select(cast(F.col("v"))).collect()]

    words = ["true", "True", "1", "false", "False", "0", "yes", "TRUE", "maybe", None]
    assert run(typing.cast_bool_map, words) == [True] * 3 + [False] * 3 + [None] * 4
    numbers = ["10.5", "11.5", "-0.5", "1e3", "1.0f", "", "61.7", None]
    assert run(typing.cast_int_rounded, numbers) == [10, 12, 0, 1000, None, None, 62, None]
    assert run(typing.cast_double, [" 7 ", ".5", "-2.", "0x1F", "12.xx", "1d"]) == [7.0, 0.5, -2.0, None, None, None]
    assert run(lambda c: typing.CASTS["int"](c), ["3000000000", "7"]) == [None, 7]


def test_booleans_and_numbers_that_are_not_text(spark):
    df = spark.createDataFrame([(True, 1, 2.5)], "b boolean, n int, d double")
    out = df.select(typing.cast_bool_map(F.col("b")), typing.cast_bool_map(F.col("n")), typing.cast_int_rounded(F.col("d")))
    assert tuple(out.first()) == (True, True, 2)
    doubles = spark.createDataFrame([(1.0, "1.0"), (0.0, "0.0"), (-0.0, "x"), (0.5, "1")], "d double, s string")
    got = [tuple(r) for r in doubles.select(typing.cast_bool_map(F.col("d")), typing.cast_bool_map(F.col("s"))).collect()]
    assert got == [(True, None), (False, None), (False, None), (None, True)]


def test_whole_numbers_keep_their_digits(spark):
    values = ["9007199254740993", " -9007199254740993 ", "9223372036854775807", "9223372036854775808", "+7", "1e3"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(typing.cast_int_rounded(F.col("v"))).collect()]
    assert got == [9007199254740993, -9007199254740993, 9223372036854775807, None, 7, 1000]


def test_missing_and_unmapped_columns(spark, caplog):
    df = spark.createDataFrame([("1", "x")], "a string, other string")
    out = typing.cast_frame(df, {"a": "bigint", "gone": "double"})
    assert out.columns == ["a", "other"] and tuple(out.first()) == (1, "x")
    assert "gone" in caplog.text
    assert tuple(typing.cast_frame(df, {"a": "decimal(5,2)"}).select(F.col("a").cast("string")).first()) == ("1.00",)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert [r[0] for r in df.select(typing.finite(F.col("v"))).collect()] == [None, 1.0]
