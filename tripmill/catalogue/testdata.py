"""The ride-share feeds as views over the given tables.

Trips, traffic and weather are derived from ``events``, sites from ``supplier``; every row of those
tables is used. ``raw_*`` frames are all text, as landed, with some cells that cannot be read;
``staged_*`` frames are the same rows typed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.zones import voronoi_zones
from tripmill.plans import dims, extracts, facts, marts
from tripmill.plans.schemas import TRAFFIC, TRIPS
from tripmill.session import new_folder

# The window that holds the whole of ``events``.
START, END = "2024-01-01T00:00:00", "2024-02-01T00:00:00"

# Landed boundary: two halves that share the edge at -87.7, the western one with a hole, and a wedge.
CITY = [
    "POLYGON ((-87.86 41.69, -87.7 41.69, -87.7 41.99, -87.86 41.99, -87.86 41.69),"
    " (-87.8 41.85, -87.76 41.85, -87.76 41.88, -87.8 41.88, -87.8 41.85))",
    "POLYGON ((-87.7 41.69, -87.52 41.69, -87.52 41.99, -87.7 41.99, -87.7 41.69))",
    "MULTIPOLYGON (((-87.9 41.68, -87.87 41.68, -87.885 41.72, -87.9 41.68)))",
]

MALFORMED = "POINT (-87.7 41.8)"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Columns below are SQL text over ``event_id AS e, user_id AS u, value AS v, ts``.


def _floor_minutes(step: int) -> str:
    return f"ts - make_dt_interval(0, 0, minute(ts) % {step}, date_part('SECOND', ts))"


def _thousandths(v: str) -> str:
    return f"concat(({v}) div 1000, '.', lpad(({v}) % 1000, 3, '0'))"


def centroid(j: str) -> str:
    """GeoJSON text of place ``j``."""
    lat = _thousandths(f"41660 + (({j}) * 7) % 360")
    return f"""concat('{{"type":"Point","coordinates":[-87.', 900 - ({j}) % 400, ',', {lat}, ']}}')"""


# Column -> (value, ``n``, bad text of every ``n``-th event).
Columns = dict[str, tuple[str, int | None, str | None]]

TRIP_COLUMNS: Columns = {
    "trip_id": ("sha1(CAST(e AS STRING))", None, None),
    "trip_start_timestamp": (f"IF(e % 2 = 0, {_floor_minutes(15)}, ts)", 101, "not-a-date"),
    "trip_end_timestamp": ("IF(e % 29 != 0, ts + make_dt_interval(0, 0, 0, CAST(v * 10 AS DECIMAL(18,6))), NULL)", None, None),
    "trip_seconds": ("v * 10", 103, "abc"),
    "trip_miles": ("IF(e % 23 != 0, (e % 40) / 2.0D, NULL)", None, None),
    "percent_time_chicago": ("IF(e % 5 = 0, 0.8D, 1.0D)", None, None),
    "percent_distance_chicago": ("IF(e % 3 = 0, 0.9D, 1.0D)", None, None),
    "shared_trip_authorized": ("IF(e % 19 != 0, e % 2 = 0, NULL)", 109, "maybe"),
    "trips_pooled": ("CAST(e % 3 + 1 AS INT)", None, None),
    "pickup_centroid_location": (f"IF(e % 41 = 0, '{MALFORMED}', IF(e % 37 != 0, {centroid('u')}, NULL))", None, None),
    "dropoff_centroid_location": (centroid("(u * 7 + e) % 1000"), None, None),
    "pickup_community_area": ("IF(e % 17 != 0, CAST(u % 77 + 1 AS INT), NULL)", None, None),
    "dropoff_community_area": ("CAST((u * 3 + e) % 77 + 1 AS INT)", None, None),
    "fare": ("IF(e % 31 != 0, v / 4, NULL)", 107, "12.xx"),
    "tip": ("(e % 7) * 0.5D", None, None),
    "additional_charges": ("(e % 3) * 1.25D", None, None),
    "trip_total": ("coalesce(IF(e % 31 != 0, v / 4, NULL), 0.0D) + (e % 7) * 0.5D + (e % 3) * 1.25D", None, None),
}


def _box(axis: str, step: int) -> str:
    if axis == "lon":
        return f"concat('-87.', 900 - 70 * ((u % 29) % 6 + {step}))"
    return _thousandths(f"41660 + 70 * ((u % 29) div 6 + {step})")


TRAFFIC_COLUMNS: Columns = {
    "time": (f"IF(e % 2 = 0, {_floor_minutes(10)}, ts)", 113, "not-a-date"),
    "region_id": ("CAST(u % 29 + 1 AS INT)", None, None),
    "speed": ("v", 127, "fast"),
    "region": ("concat('Region ', u % 29 + 1)", None, None),
    "bus_count": ("(e % 50) + IF(e % 3 = 0, 0.5D, 0.0D)", None, None),
    "num_reads": ("CAST(e % 500 AS INT)", None, None),
    "hour": ("hour(ts)", None, None),
    "record_id": ("CAST(e AS STRING)", None, None),
    "west": (_box("lon", 0), 97, "n/a"),
    "east": (_box("lon", 1), None, None),
    "north": (_box("lat", 1), None, None),
    "south": (_box("lat", 0), None, None),
}


def _raw(df: DataFrame, columns: Columns) -> DataFrame:
    """All text, with the unreadable cells."""
    out = []
    for name, (value, n, bad) in columns.items():
        text = f"CAST({value} AS STRING)"
        if name.endswith("timestamp") or name == "time":
            text = f"replace({text}, ' ', 'T')"
        out.append(f"{text} AS {name}" if n is None else f"IF(e % {n} = 0, '{bad}', {text}) AS {name}")
    return df.selectExpr(*out)


def _typed(df: DataFrame, columns: Columns) -> DataFrame:
    """The same rows typed; unreadable cells are null."""
    return df.selectExpr(
        *[f"{v} AS {name}" if n is None else f"IF(e % {n} != 0, {v}, NULL) AS {name}" for name, (v, n, _) in columns.items()]
    )


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr("event_id AS e", "user_id AS u", "value AS v", "ts", "event_type")


def raw_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(_events(spark, sf), TRIP_COLUMNS)


def centroid_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Typed trips that still carry the centroid texts."""
    return extracts.add_batch_id(_typed(_events(spark, sf), TRIP_COLUMNS), "b0").select(*TRIPS)


def staged_trips(spark: SparkSession, sf: str) -> DataFrame:
    return dims.hash_location_keys(centroid_trips(spark, sf))


def _errors(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).where("event_type = 'error'")


def raw_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(_errors(spark, sf), TRAFFIC_COLUMNS)


def boxed_traffic(spark: SparkSession, sf: str) -> DataFrame:
    """Typed readings with the box texts."""
    raw = _raw(_errors(spark, sf), TRAFFIC_COLUMNS).select("west", "east", "south", "north", "record_id")
    return staged_traffic(spark, sf).join(raw, "record_id")


def staged_traffic(spark: SparkSession, sf: str) -> DataFrame:
    df = _typed(_errors(spark, sf), TRAFFIC_COLUMNS)
    return extracts.add_batch_id(df.withColumn("bus_count", F.rint("bus_count").cast("int")), "b0").select(*TRAFFIC)


def _weather_days(spark: SparkSession, sf: str) -> DataFrame:
    station = F.expr("concat('Estacion_', substring('ABCD', CAST(u % 4 + 1 AS INT), 1))")
    return (
        _events(spark, sf)
        .groupBy(station.alias("station_id"), F.col("ts").cast("date").alias("day"))
        .agg(
            F.max("v").alias("temp"),
            F.min("v").alias("feelslike"),
            F.expr("CAST(count(*) % 100 AS DOUBLE) AS precipprob"),
            F.expr("(count(*) % 300) / 10.0D AS windspeed"),
            F.expr("CAST(count(*) * 7 % 360 AS STRING) AS winddir"),
            F.expr("IF(count(*) % 2 = 0, 'Clear', 'Rain, Partially cloudy') AS conditions"),
        )
    )


def staged_weather(spark: SparkSession, sf: str) -> DataFrame:
    days = _weather_days(spark, sf)
    df = days.select(
        F.concat_ws("_", "station_id", F.col("day").cast("string")).alias("record_id"),
        F.col("day").cast("timestamp_ntz").alias("datetime"),
        "station_id", "temp", "feelslike", "precipprob", "windspeed", "winddir", "conditions",
    )
    return facts.weather_staging(extracts.add_batch_id(df, "b0"))


def weather_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """``station_id, value``: JSON payloads, one per station and day, in both shapes the feed uses."""
    day = F.struct(
        F.col("day").cast("string").alias("datetime"), "temp", "feelslike", "precipprob", "windspeed",
        F.col("winddir").cast("double").alias("winddir"), "conditions",
    )
    payload = F.when(F.dayofmonth("day") % 2 == 0, F.to_json(F.struct(F.array(day).alias("days")))).otherwise(F.to_json(day))
    return _weather_days(spark, sf).select("station_id", payload.alias("value"))


def city_polygons(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in CITY], "geometry_wkt string")


def sites(spark: SparkSession, sf: str) -> DataFrame:
    """A site per supplier; every 50th has no coordinates."""
    k = F.col("s_suppkey")
    lon = F.lit(-87.9) + (k * 37 % 1009) / F.lit(2500.0)
    lat = F.lit(41.66) + (k * 101 % 997) / F.lit(2700.0)
    placed = k % 50 != 49
    return table(spark, sf, "supplier").select(
        F.col("s_name").alias("station_id"),
        F.when(placed, F.round(lon, 6)).alias("longitude"),
        F.when(placed, F.round(lat, 6)).alias("latitude"),
    )


# -- stored tables --------------------------------------------------------------------------------
# Dimensions and facts are tables in practice: each is derived once per session and folder of test
# data, written to the shared folder, and read from there by the queries above it.


def _locations(spark: SparkSession, sf: str) -> DataFrame:
    return extracts.add_batch_id(dims.locations_build(centroid_trips(spark, sf)), "b0")


def _regions(spark: SparkSession, sf: str) -> DataFrame:
    return dims.regions_export(dims.regions_build(boxed_traffic(spark, sf)), "b0")


def _boundary(spark: SparkSession, sf: str) -> DataFrame:
    return dims.city_boundary_table(city_polygons(spark))


def _zones(spark: SparkSession, sf: str) -> DataFrame:
    return voronoi_zones(dims.stations_table(dims.default_stations(spark)), stored(spark, sf, "boundary"))


def _mapped(spark: SparkSession, sf: str) -> DataFrame:
    return dims.map_locations(*(stored(spark, sf, t) for t in ("locations", "regions", "zones")))


def _invalid(spark: SparkSession, sf: str) -> DataFrame:
    return dims.invalid_locations(stored(spark, sf, "locations"), stored(spark, sf, "boundary"))


def _fact_trips(spark: SparkSession, sf: str) -> DataFrame:
    return facts.trip_rows(staged_trips(spark, sf), stored(spark, sf, "invalid"), START, END)


def _fact_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return facts.traffic_rows(staged_traffic(spark, sf), START, END)


def _fact_weather(spark: SparkSession, sf: str) -> DataFrame:
    return facts.weather_rows(staged_weather(spark, sf), START, END)


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return marts.trips_enriched(*(stored(spark, sf, t) for t in ("fact_trips", "mapped", "fact_traffic", "fact_weather")))


BUILDERS = {
    "locations": _locations,
    "regions": _regions,
    "boundary": _boundary,
    "zones": _zones,
    "mapped": _mapped,
    "invalid": _invalid,
    "fact_trips": _fact_trips,
    "fact_traffic": _fact_traffic,
    "fact_weather": _fact_weather,
    "enriched": _enriched,
}
_written: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf: str, name: str) -> DataFrame:
    place = (spark.sparkContext.applicationId, sf, name)
    if place not in _written:
        folder = new_folder(spark, name)
        BUILDERS[name](spark, sf).write.parquet(folder)
        _written[place] = folder
    return spark.read.parquet(_written[place])
