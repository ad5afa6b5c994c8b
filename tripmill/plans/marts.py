"""The three marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.instants import day_of_week, hour_trunc, month_of, start_hour
from tripmill.operators.asof import asof_nearest
from tripmill.operators.counts import active_and_recent_rows
from tripmill.operators.slices import time_cuts


def hourly_pickup(trips: DataFrame) -> DataFrame:
    return (
        trips.where("pickup_community_area IS NOT NULL")
        .groupBy(hour_trunc(F.col("trip_start_timestamp")).alias("trip_hour"), "pickup_community_area")
        .agg(
            F.count("trip_id").alias("total_trips"),
            F.avg("rate_per_mile").alias("avg_rate_per_mile"),
            F.avg("duration_minutes").alias("avg_duration_minutes"),
        )
    )


def with_location_map(trips: DataFrame, mapped: DataFrame) -> DataFrame:
    """Region and station of the pickup; null for a location that is not mapped."""
    places = mapped.select(F.col("location_id").alias("pickup_location_id"), "region_id", "station_id")
    return trips.join(places, "pickup_location_id", "left")


def reading_cuts(trips: DataFrame, traffic: DataFrame, weather: DataFrame) -> list[float]:
    """Slices for both nearest-in-time joins, counted once on the stored tables."""
    return time_cuts([(trips, F.col("trip_start_timestamp")), (traffic, F.col("time")), (weather, F.col("datetime"))])


def nearest_traffic(trips: DataFrame, traffic: DataFrame, cuts: list[float] | None = None) -> DataFrame:
    payload = {"region_id": "pickup_traffic_region_id", "speed": "traffic_speed", "num_reads": "traffic_num_reads"}
    return asof_nearest(trips, traffic, "region_id", "trip_start_timestamp", "time", "record_id", payload, cuts)


def nearest_weather(trips: DataFrame, weather: DataFrame, cuts: list[float] | None = None) -> DataFrame:
    payload = {
        "station_id": "pickup_weather_station_id",
        "temp": "weather_temp",
        "feelslike": "weather_feelslike",
        "windspeed": "weather_windspeed",
        "conditions": "weather_conditions",
    }
    return asof_nearest(trips, weather, "station_id", "trip_start_timestamp", "datetime", "record_id", payload, cuts)


# Columns of the marts.
ENRICHED = [
    "trip_id", "trip_start_timestamp", "pickup_location_id",
    "pickup_traffic_region_id", "traffic_speed", "traffic_num_reads",
    "pickup_weather_station_id", "weather_temp", "weather_feelslike", "weather_windspeed", "weather_conditions",
]


def trips_enriched(trips: DataFrame, mapped: DataFrame, traffic: DataFrame, weather: DataFrame) -> DataFrame:
    slim = trips.select("trip_id", "trip_start_timestamp", "pickup_location_id")
    placed, cuts = with_location_map(slim, mapped), reading_cuts(trips, traffic, weather)
    return nearest_weather(nearest_traffic(placed, traffic, cuts), weather, cuts).select(*ENRICHED)


def window_features(trips: DataFrame) -> DataFrame:
    """Adds ``active_trips_total`` and ``trips_from_pickup_loc_last_30m``."""
    start, end, place = "trip_start_timestamp", "trip_end_timestamp", "pickup_location_id"
    return active_and_recent_rows(trips, start, end, place, "active_trips_total", "trips_from_pickup_loc_last_30m")


TRIP_COLUMNS = [
    "trip_id", "trip_start_timestamp", "trip_end_timestamp", "rate_per_mile", "fare", "duration_minutes",
    "trip_miles", "trip_total", "pickup_location_id", "dropoff_location_id", "pickup_community_area",
    "dropoff_community_area",
]

# Column of the enriched mart -> column of the feature table.
CONDITIONS = {
    "traffic_speed": "pickup_traffic_speed",
    "traffic_num_reads": "pickup_traffic_num_reads",
    "weather_temp": "pickup_weather_temp",
    "weather_feelslike": "pickup_weather_feelslike",
    "weather_windspeed": "pickup_weather_windspeed",
    "weather_conditions": "pickup_weather_conditions",
}


def features(df: DataFrame) -> DataFrame:
    start = F.col("trip_start_timestamp")
    return df.select(
        *TRIP_COLUMNS[:8],
        start_hour(start).alias("start_hour"),
        day_of_week(start).alias("day_of_week"),
        month_of(start).alias("month_of_trip"),
        *TRIP_COLUMNS[8:],
        *[F.col(c).alias(name) for c, name in CONDITIONS.items()],
        "active_trips_total",
        "trips_from_pickup_loc_last_30m",
    )


def described_trips(trips: DataFrame, mapped: DataFrame, traffic: DataFrame, weather: DataFrame) -> DataFrame:
    """Every trip with its counts and the nearest traffic and weather: what both trip marts choose from."""
    placed, cuts = with_location_map(window_features(trips.select(*TRIP_COLUMNS)), mapped), reading_cuts(trips, traffic, weather)
    return nearest_weather(nearest_traffic(placed, traffic, cuts), weather, cuts)


def ml_base(trips: DataFrame, mapped: DataFrame, traffic: DataFrame, weather: DataFrame) -> DataFrame:
    """One row per trip: times, places, nearest traffic and weather, and the two counts.

    Traffic and weather are looked up on the trips themselves: no join by trip id is needed.
    """
    return features(described_trips(trips, mapped, traffic, weather))


def ml_base_from_mart(trips: DataFrame, enriched: DataFrame) -> DataFrame:
    counted = window_features(trips.select(*TRIP_COLUMNS))
    return features(counted.join(enriched.select("trip_id", *CONDITIONS), "trip_id", "left"))
