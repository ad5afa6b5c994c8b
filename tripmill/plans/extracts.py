"""Selecting and typing what was landed from the three feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.instants import as_ntz
from tripmill.functions.typing import cast_double, cast_frame, cast_timestamp, finite
from tripmill.plans.schemas import TRAFFIC, TRAFFIC_BOX, TRIPS, WEATHER
from tripmill.sources.landing import LANDED_DAY

# Dates of the extracts, and the sample and limit that a caller may ask for.
START_DATE = "2025-09-01T00:00:00.000"
COLD_START_END_DATE = "2025-09-03T23:59:00.000"
END_DATE = "2025-09-10T23:59:00.000"
TRIP_SAMPLE_SUFFIX = "a0"
TRAFFIC_LIMIT = 1000


def add_batch_id(df: DataFrame, batch_id: str) -> DataFrame:
    return df.withColumn("batch_id", F.lit(batch_id))


def add_created_at(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", F.current_timestamp())


def in_closed_range(df: DataFrame, time: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Both ends included; ``time`` may still be text.

    What was landed in folders by the day of ``time`` is read from the folders of the range only.
    """
    if LANDED_DAY in df.columns:
        first, last = (F.lit((v or d)[:10]).cast("date") for v, d in ((start, START_DATE), (end, END_DATE)))
        df = df.where(F.col(LANDED_DAY).between(first, last))
    at = cast_timestamp(F.col(time)) if dict(df.dtypes)[time] == "string" else F.col(time)
    return df.where(at.between(as_ntz(start or START_DATE), as_ntz(end or END_DATE)))


def in_half_open_window(df: DataFrame, time: str, start: str, end: str) -> DataFrame:
    return df.where((F.col(time) >= as_ntz(start)) & (F.col(time) < as_ntz(end)))


def sampled_by_suffix(df: DataFrame, column: str = "trip_id", suffix: str | None = TRIP_SAMPLE_SUFFIX) -> DataFrame:
    return df if suffix is None else df.where(F.col(column).endswith(suffix))


def in_city_with_centroids(df: DataFrame) -> DataFrame:
    return df.where(
        (cast_double(F.col("percent_time_chicago")) == 1)
        & F.col("pickup_centroid_location").isNotNull()
        & F.col("dropoff_centroid_location").isNotNull()
    )


def typed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Cast, keep the mapped columns only, and take NaN for missing."""
    numeric = {c for c, kind in df.dtypes if kind in ("double", "float")}
    doubles = [c for c, kind in mapping.items() if kind == "double" and c in numeric]
    return cast_frame(df.withColumns({c: finite(F.col(c)) for c in doubles}), mapping).select(*mapping)


def extract_trips(
    raw: DataFrame, start: str | None, end: str | None, batch_id: str, suffix: str | None = None
) -> DataFrame:
    """All trips of the range in the city; a ``suffix`` keeps only the sample of ids that end in it."""
    wanted = in_city_with_centroids(sampled_by_suffix(in_closed_range(raw, "trip_start_timestamp", start, end), suffix=suffix))
    return typed(add_batch_id(wanted, batch_id), TRIPS)


def earliest_traffic(df: DataFrame, limit: int = TRAFFIC_LIMIT) -> DataFrame:
    """The first ``limit`` readings by time; readings of one instant by record id."""
    return df.orderBy(F.col("time").asc_nulls_last(), "record_id").limit(limit)


def extract_traffic(
    raw: DataFrame, start: str | None, end: str | None, batch_id: str, limit: int | None = None
) -> DataFrame:
    """Typed readings with the box columns still attached, for the region dimension."""
    wanted = in_closed_range(raw, "time", start, end).where("region_id IS NOT NULL")
    cast = cast_frame(add_batch_id(wanted, batch_id), TRAFFIC)
    kept = cast.select(*TRAFFIC, *[c for c in TRAFFIC_BOX if c in cast.columns])
    return kept if limit is None else earliest_traffic(kept, limit)


def extract_weather(raw: DataFrame, start: str | None, end: str | None, batch_id: str) -> DataFrame:
    """Days from ``start`` to ``end``, by date."""
    day = cast_timestamp(F.col("datetime")).cast("date")
    first, last = (F.lit((v or d)[:10]).cast("date") for v, d in ((start, START_DATE), (end, END_DATE)))
    return typed(add_batch_id(raw.where(day.between(first, last)), batch_id), WEATHER)
