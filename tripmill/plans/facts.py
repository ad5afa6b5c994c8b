"""Staging to facts: the window, the quality rules, the derived columns and the merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.upsert import upsert
from tripmill.plans.extracts import in_half_open_window
from tripmill.plans.schemas import UPDATES


def good_trips(trips: DataFrame) -> DataFrame:
    return trips.where(
        F.col("fare").isNotNull()
        & (F.col("fare") > 0)
        & (F.col("trip_seconds") > 60)
        & F.col("pickup_location_id").isNotNull()
        & F.col("dropoff_location_id").isNotNull()
    )


def without_invalid(trips: DataFrame, invalid: DataFrame) -> DataFrame:
    """Drop trips that start or end at an invalid location."""
    out = trips
    for column in ("pickup_location_id", "dropoff_location_id"):
        out = out.join(invalid.select(F.col("location_id").alias(column)), column, "left_anti")
    return out


def rate_per_mile() -> Column:
    """Zero when the miles are zero, negative or unknown."""
    return F.when(F.col("trip_miles") > 0, F.col("fare") / F.col("trip_miles")).otherwise(F.lit(0.0))


def duration_minutes() -> Column:
    return F.col("trip_seconds") / F.lit(60.0)


def trip_rows(staging: DataFrame, invalid: DataFrame, start: str, end: str) -> DataFrame:
    """Fact rows of the trips that start in ``[start, end)``.

    Whole seconds are rounded half to even; the minutes come from the seconds as staged.
    """
    kept = without_invalid(good_trips(in_half_open_window(staging, "trip_start_timestamp", start, end)), invalid)
    derived = kept.withColumns({"rate_per_mile": rate_per_mile(), "duration_minutes": duration_minutes()})
    return derived.withColumn("trip_seconds", F.rint("trip_seconds").cast("int"))


def traffic_rows(staging: DataFrame, start: str, end: str) -> DataFrame:
    return in_half_open_window(staging, "time", start, end).drop("region")


def weather_rows(staging: DataFrame, start: str, end: str) -> DataFrame:
    return in_half_open_window(staging, "datetime", start, end)


def _present(table: str, df: DataFrame) -> list[str]:
    return [c for c in UPDATES[table] if c in df.columns]


def upsert_trips(stored: DataFrame, rows: DataFrame) -> DataFrame:
    return upsert(stored, rows, "trip_id", _present("fact_tables.fact_trips", stored))


def upsert_traffic(stored: DataFrame, rows: DataFrame) -> DataFrame:
    return upsert(stored, rows, "record_id", _present("fact_tables.fact_traffic", stored))


def upsert_weather(stored: DataFrame, rows: DataFrame) -> DataFrame:
    return upsert(stored, rows, "record_id", _present("fact_tables.fact_weather", stored))


def weather_staging(typed: DataFrame) -> DataFrame:
    """Wind speed is kept as text and wind direction as a number from staging on."""
    return typed.withColumns({"windspeed": F.col("windspeed").cast("string"), "winddir": F.col("winddir").try_cast("double")})
