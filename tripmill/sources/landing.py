"""Reading landed API responses and extracts.

Responses are landed as they came: one JSON document per line, or (``whole_files``) one document per
file. Every scalar is read as text; typing is a separate, lenient step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions.places import latlon_text, record_key
from tripmill.functions.typing import string_schema
from tripmill.sources.arrays import object_texts

# Columns as the feeds deliver them.
TRIP_FIELDS = [
    "trip_id", "trip_start_timestamp", "trip_end_timestamp", "trip_seconds", "trip_miles",
    "percent_time_chicago", "percent_distance_chicago", "shared_trip_authorized", "trips_pooled",
    "pickup_centroid_location", "dropoff_centroid_location", "pickup_community_area",
    "dropoff_community_area", "fare", "tip", "additional_charges", "trip_total",
]
TRAFFIC_FIELDS = [
    "time", "region_id", "speed", "region", "bus_count", "num_reads", "hour", "record_id",
    "west", "east", "north", "south",
]
DAY_FIELDS = ["datetime", "temp", "feelslike", "precipprob", "windspeed", "winddir", "conditions"]


#: Folders of a feed by the day of its records: ``landed_day=2025-09-01``.
LANDED_DAY = "landed_day"


def land_by_day(records: DataFrame, time: str, path: str) -> None:
    """Records as JSON lines in a folder for each day of ``time``; those without a day are kept apart."""
    day = F.substring(F.col(time), 1, 10).try_cast("date")
    records.withColumn(LANDED_DAY, day).hint("rebalance", LANDED_DAY).write.partitionBy(LANDED_DAY).json(path)


def read_records(spark: SparkSession, path: str, fields: list[str], whole_files: bool = False) -> DataFrame:
    """Records of a response that is a list of objects; anything else in the response is no data.

    The list is an array that is the whole file (``whole_files``; a large one is read by many tasks, see
    :mod:`tripmill.sources.arrays`) or one object per line. Nested values arrive as JSON text. An array's
    object that cannot be read is no record.
    Folders by day (:func:`land_by_day`) add the column LANDED_DAY, by which an extract reads only its days.
    """
    if whole_files:
        texts, folders = object_texts(spark, path)
        record = F.from_json("text", string_schema(fields))
        df = texts.select(record.alias("_record"), *folders)
        df = df.select(*[F.col(f"_record.{c}") for c in fields if c not in folders], *folders)
        return df.na.drop(how="all", subset=fields)
    df = spark.read.schema(string_schema(fields)).json(path)
    return df.na.drop(how="all", subset=fields)


def read_weather(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """One row per station and day from folders ``station_id=<id>``.

    A payload is an object with a ``days`` list, or the list itself (each of its days is then a row of
    its own).
    """
    day = string_schema(DAY_FIELDS)
    payload = T.StructType([T.StructField("days", T.ArrayType(day)), *day.fields, T.StructField("station_id", T.StringType())])
    df = spark.read.schema(payload).json(path, multiLine=whole_files)
    days = F.coalesce(F.col("days"), F.array(F.struct(*DAY_FIELDS)))
    return (
        df.select("station_id", F.explode(days).alias("day"))
        .select("station_id", "day.*")
        .where("datetime IS NOT NULL")
        .withColumn("record_id", record_key(F.col("station_id"), F.col("datetime")))
    )


def stations_to_query(stations: DataFrame) -> DataFrame:
    """Station id and the ``"lat,lon"`` text the weather feed is asked with; unplaced ones are skipped."""
    placed = stations.where("latitude IS NOT NULL AND longitude IS NOT NULL")
    return placed.select("station_id", latlon_text(F.col("latitude"), F.col("longitude")).alias("location"))


def read_extract(spark: SparkSession, path: str) -> DataFrame:
    """A parquet extract; a missing path is an error."""
    return spark.read.parquet(path)


def write_extract(df: DataFrame, path: str) -> None:
    """A parquet extract of one run, at a path named by its batch id."""
    df.write.mode("overwrite").parquet(path)
