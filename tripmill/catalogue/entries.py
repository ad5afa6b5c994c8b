"""Every operator as a named query over the given tables, with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.catalogue import testdata as td
from tripmill.catalogue.oracle import CTES, END, NUMBER, START, _inside, _utm, sql
from tripmill.functions import instants, places, typing
from tripmill.functions.geometry import reprojected, utm16n, wkt_point, wkt_rectangle
from tripmill.operators import checks, counts
from tripmill.operators.asof import asof_nearest
from tripmill.operators.overlay import dissolve
from tripmill.operators.nearest import euclid, nearest_site
from tripmill.operators.spatial import join_within, polygon_areas, polygon_edges, within_pairs
from tripmill.operators.upsert import upsert
from tripmill.operators.zones import voronoi_zones
from tripmill.plans import dims, extracts, facts, jobs, marts
from tripmill.plans.schemas import TRAFFIC, TRIPS
from tripmill.session import new_folder
from tripmill.sources import arrays, landing
from tripmill.sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

col = F.col


def query(name: str, oracle: str | None = None, **override: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = sql(oracle, **override)
        return fn

    return add


def stored(name: str) -> Query:
    return lambda spark, sf: td.stored(spark, sf, name)


fact_trips, fact_traffic, fact_weather = stored("fact_trips"), stored("fact_traffic"), stored("fact_weather")
locations, regions, zones, mapped = stored("locations"), stored("regions"), stored("zones"), stored("mapped")
invalid, boundary, enriched = stored("invalid"), stored("boundary"), stored("enriched")


def _warehouse(spark: SparkSession, name: str, *tables: str) -> Warehouse:
    folder = new_folder(spark, name)
    wh = Warehouse(spark, folder, prefix=f"w{folder[-8:]}_")
    wh.create(*tables)
    return wh


# == sources and sinks ===========================================================================

_RAW_TRIPS = f"""
    SELECT sha1(e::VARCHAR) AS trip_id,
        CASE WHEN e % 101 = 0 THEN 'not-a-date' WHEN e % 2 = 0
            THEN strftime(time_bucket(INTERVAL '15 minutes', ts), '%Y-%m-%dT%H:%M:%S')
            ELSE rtrim(rtrim(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '0'), '.') END AS trip_start_timestamp,
        CASE WHEN e % 103 = 0 THEN 'abc' ELSE (v * 10)::VARCHAR END AS trip_seconds,
        CASE WHEN e % 109 = 0 THEN 'maybe' WHEN e % 19 <> 0 THEN (e % 2 = 0)::VARCHAR END AS shared_trip_authorized,
        CASE WHEN e % 107 = 0 THEN '12.xx' WHEN e % 31 <> 0 THEN (v / 4)::VARCHAR END AS fare,
        CASE WHEN e % 17 <> 0 THEN (u % 77 + 1)::VARCHAR END AS pickup_community_area,
        CASE WHEN e % 29 <> 0 THEN rtrim(rtrim(strftime(ts + to_microseconds(CAST(round(v * 1e7) AS BIGINT)),
            '%Y-%m-%dT%H:%M:%S.%f'), '0'), '.') END AS trip_end_timestamp,
        trip_miles::VARCHAR AS trip_miles, percent_time_chicago::VARCHAR AS percent_time_chicago,
        percent_distance_chicago::VARCHAR AS percent_distance_chicago, trips_pooled::VARCHAR AS trips_pooled,
        pickup_centroid_location, dropoff_centroid_location, dropoff_community_area::VARCHAR AS dropoff_community_area,
        tip::VARCHAR AS tip, additional_charges::VARCHAR AS additional_charges, trip_total::VARCHAR AS trip_total
    FROM e JOIN (SELECT trip_id AS id, * EXCLUDE (trip_id, trip_start_timestamp, trip_end_timestamp, trip_seconds, fare,
        shared_trip_authorized, pickup_community_area) FROM centroid_trips) ON id = sha1(e::VARCHAR)"""


@query("src_json_records", _RAW_TRIPS)
def src_json_records(spark, sf):
    folder = new_folder(spark, "landed-trips")
    td.raw_trips(spark, sf).write.json(folder)
    return landing.read_records(spark, folder, landing.TRIP_FIELDS)


@query("src_json_array", _RAW_TRIPS)
def src_json_array(spark, sf):
    folder = new_folder(spark, "landed-arrays")
    arrays.land_arrays(td.raw_trips(spark, sf), folder)
    return landing.read_records(spark, folder, landing.TRIP_FIELDS, whole_files=True)


@query(
    "src_weather_json",
    """SELECT record_id, station_id, CAST(CAST(datetime AS DATE) AS VARCHAR) AS datetime, temp::VARCHAR AS temp,
        feelslike::VARCHAR AS feelslike, precipprob::VARCHAR AS precipprob, windspeed, winddir::VARCHAR AS winddir,
        conditions FROM weather""",
)
def src_weather_json(spark, sf):
    folder = new_folder(spark, "landed-weather")
    td.weather_payloads(spark, sf).write.partitionBy("station_id").text(folder)
    return landing.read_weather(spark, folder)


@query("src_parquet", "SELECT * FROM events")
def src_parquet(spark, sf):
    return landing.read_extract(spark, f"{sf}/events.parquet")


_TRIP_COLUMNS = ", ".join(TRIPS)


@query("snk_parquet", f"SELECT {_TRIP_COLUMNS} FROM centroid_trips")
def snk_parquet(spark, sf):
    folder = new_folder(spark, "extract-b0")
    landing.write_extract(extracts.typed(extracts.add_batch_id(td.raw_trips(spark, sf), "b0"), TRIPS), folder)
    return landing.read_extract(spark, folder)


_DECIMALS = "CAST(longitude AS DECIMAL(10,7)) AS longitude, CAST(latitude AS DECIMAL(10,7)) AS latitude"


@query("src_view_stations", f"SELECT station_id, {_DECIMALS} FROM sites")
def src_view_stations(spark, sf):
    wh = _warehouse(spark, "stations", "dim_spatial.weather_stations_points")
    wh.replace("dim_spatial.weather_stations_points", dims.stations_table(td.sites(spark, sf)))
    return wh.read("dim_spatial.weather_stations_points").select("station_id", "longitude", "latitude").orderBy("station_id")


@query(
    "src_view_stations_zones",
    f"""SELECT station_id, station_id AS station_name, {_DECIMALS},
        CASE WHEN longitude IS NOT NULL THEN CAST(row_number() OVER
            (PARTITION BY longitude IS NULL ORDER BY station_id) AS INT) END AS zone_id FROM sites""",
)
def src_view_stations_zones(spark, sf):
    """The stored view of stations with their zones, over tables replaced after it was made."""
    wh = _warehouse(spark, "view", "dim_spatial.weather_stations_points", "dim_spatial.weather_voronoi_zones")
    stations = dims.stations_table(td.sites(spark, sf))
    wh.replace("dim_spatial.weather_stations_points", stations)
    wh.replace("dim_spatial.weather_voronoi_zones", dims.zones_table(voronoi_zones(stations, boundary(spark, sf))))
    return wh.read("dim_spatial.vw_stations_with_zones").select("station_id", "station_name", "longitude", "latitude", "zone_id")


@query("src_table_query", "SELECT location_id, longitude, latitude, batch_id FROM locations")
def src_table_query(spark, sf):
    return locations(spark, sf).select("location_id", "longitude", "latitude", "batch_id")


@query("src_station_requests", "SELECT station_id, latitude || ',' || longitude AS location FROM sites WHERE longitude IS NOT NULL")
def src_station_requests(spark, sf):
    return landing.stations_to_query(td.sites(spark, sf))


_STAGED_TRAFFIC = "SELECT record_id, time, region_id, speed, region, bus_count, num_reads, batch_id FROM traffic"
_TRAFFIC_OUT = ["record_id", "time", "region_id", "speed", "region", "bus_count", "num_reads", "batch_id"]


@query("snk_append_schema_match", _STAGED_TRAFFIC)
def snk_append_schema_match(spark, sf):
    wh = _warehouse(spark, "append", "staging.stg_raw_traffic")
    wh.append("staging.stg_raw_traffic", td.staged_traffic(spark, sf).withColumn("hour", F.hour("time")))
    return wh.read("staging.stg_raw_traffic").select(*_TRAFFIC_OUT)


@query("snk_append_key_check", f"SELECT *, true AS second_load_refused FROM ({_STAGED_TRAFFIC})")
def snk_append_key_check(spark, sf):
    wh = _warehouse(spark, "append", "staging.stg_raw_traffic")
    rows = td.staged_traffic(spark, sf)
    wh.append("staging.stg_raw_traffic", rows)
    try:
        wh.append("staging.stg_raw_traffic", rows)
        refused = False
    except checks.CheckFailed:
        refused = True
    return wh.read("staging.stg_raw_traffic").select(*_TRAFFIC_OUT, F.lit(refused).alias("second_load_refused"))


@query("snk_replace", "SELECT location_id, coalesce(region_id, 0) AS region_id, station_id, batch_id FROM mapped")
def snk_replace(spark, sf):
    wh = _warehouse(spark, "replace", "dim_spatial.mapped_locations")
    wh.replace("dim_spatial.mapped_locations", mapped(spark, sf))
    wh.replace("dim_spatial.mapped_locations", wh.read("dim_spatial.mapped_locations").na.fill(0, ["region_id"]))
    return wh.read("dim_spatial.mapped_locations").select("location_id", "region_id", "station_id", "batch_id")


@query("add_batch_id", "SELECT sha1(e::VARCHAR) AS trip_id, 'run1__try1' AS batch_id FROM e")
def add_batch_id(spark, sf):
    return extracts.add_batch_id(td.raw_trips(spark, sf).select("trip_id"), "run1__try1")


@query("add_created_at", "SELECT sha1(e::VARCHAR) AS trip_id, true AS is_stamped FROM e")
def add_created_at(spark, sf):
    stamped = extracts.add_created_at(td.raw_trips(spark, sf).select("trip_id"))
    return stamped.select("trip_id", col("created_at").isNotNull().alias("is_stamped"))


# == projection, predicates, top-k ===============================================================


@query("proj_trip_columns", f"SELECT {_TRIP_COLUMNS} FROM centroid_trips")
def proj_trip_columns(spark, sf):
    return extracts.typed(extracts.add_batch_id(td.raw_trips(spark, sf), "b0"), TRIPS)


@query(
    "flt_closed_time_range",
    """SELECT trip_id, trip_start_timestamp FROM staged_trips
       WHERE trip_start_timestamp BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20 06:15:00'""",
)
def flt_closed_time_range(spark, sf):
    trips = td.staged_trips(spark, sf).select("trip_id", "trip_start_timestamp")
    return extracts.in_closed_range(trips, "trip_start_timestamp", "2024-01-05T06:00:00.000", "2024-01-20T06:15:00.000")


@query(
    "flt_half_open_window",
    """SELECT trip_id, trip_start_timestamp FROM staged_trips
       WHERE trip_start_timestamp >= TIMESTAMP '2024-01-05 06:00:00' AND trip_start_timestamp < TIMESTAMP '2024-01-20 06:15:00'""",
)
def flt_half_open_window(spark, sf):
    trips = td.staged_trips(spark, sf).select("trip_id", "trip_start_timestamp")
    return extracts.in_half_open_window(trips, "trip_start_timestamp", "2024-01-05T06:00:00", "2024-01-20T06:15:00")


@query("flt_suffix_sample", "SELECT trip_id FROM staged_trips WHERE trip_id LIKE '%a0'")
def flt_suffix_sample(spark, sf):
    return extracts.sampled_by_suffix(td.staged_trips(spark, sf).select("trip_id"))


@query(
    "flt_in_city_not_null",
    """SELECT trip_id FROM centroid_trips WHERE percent_time_chicago = 1
       AND pickup_centroid_location IS NOT NULL AND dropoff_centroid_location IS NOT NULL""",
)
def flt_in_city_not_null(spark, sf):
    return extracts.in_city_with_centroids(td.raw_trips(spark, sf)).select("trip_id")


@query(
    "topk_earliest_traffic",
    "SELECT record_id, time, region_id, speed FROM traffic ORDER BY time NULLS LAST, record_id LIMIT 1000",
)
def topk_earliest_traffic(spark, sf):
    return extracts.earliest_traffic(td.staged_traffic(spark, sf)).select("record_id", "time", "region_id", "speed")


@query(
    "flt_trip_quality",
    """SELECT trip_id, fare, trip_seconds FROM staged_trips WHERE fare > 0 AND trip_seconds > 60
       AND pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL""",
)
def flt_trip_quality(spark, sf):
    return facts.good_trips(td.staged_trips(spark, sf)).select("trip_id", "fare", "trip_seconds")


@query("flt_station_coords", "SELECT station_id FROM sites WHERE latitude IS NOT NULL AND longitude IS NOT NULL")
def flt_station_coords(spark, sf):
    return landing.stations_to_query(td.sites(spark, sf)).select("station_id")


@query(
    "flt_pickup_area",
    "SELECT trip_id, pickup_community_area FROM staged_trips WHERE pickup_community_area IS NOT NULL",
)
def flt_pickup_area(spark, sf):
    return td.staged_trips(spark, sf).where("pickup_community_area IS NOT NULL").select("trip_id", "pickup_community_area")


# == joins =======================================================================================


@query("join_anti_invalid", "SELECT trip_id, pickup_location_id, dropoff_location_id FROM fact_trips")
def join_anti_invalid(spark, sf):
    trips = facts.good_trips(extracts.in_half_open_window(td.staged_trips(spark, sf), "trip_start_timestamp", td.START, td.END))
    kept = facts.without_invalid(trips, invalid(spark, sf))
    return kept.select("trip_id", "pickup_location_id", "dropoff_location_id")


@query(
    "join_left_location_map",
    """SELECT t.trip_id, t.pickup_location_id, m.region_id, m.station_id
       FROM staged_trips t LEFT JOIN mapped m ON t.pickup_location_id = m.location_id""",
)
def join_left_location_map(spark, sf):
    trips = td.staged_trips(spark, sf).select("trip_id", "pickup_location_id")
    return marts.with_location_map(trips, mapped(spark, sf)).select("trip_id", "pickup_location_id", "region_id", "station_id")


def _placed_trips(spark, sf):
    trips = fact_trips(spark, sf).select("trip_id", "trip_start_timestamp", "pickup_location_id")
    return marts.with_location_map(trips, mapped(spark, sf))


_TRAFFIC_COLUMNS = ["trip_id", "pickup_traffic_region_id", "traffic_speed", "traffic_num_reads"]
_WEATHER_COLUMNS = [
    "trip_id", "pickup_weather_station_id", "weather_temp", "weather_feelslike", "weather_windspeed", "weather_conditions",
]


@query("asof_nearest_traffic", f"SELECT {', '.join(_TRAFFIC_COLUMNS)} FROM enriched")
def asof_nearest_traffic(spark, sf):
    return marts.nearest_traffic(_placed_trips(spark, sf), fact_traffic(spark, sf)).select(*_TRAFFIC_COLUMNS)


@query("asof_nearest_traffic_sliced", f"SELECT {', '.join(_TRAFFIC_COLUMNS)} FROM enriched")
def asof_nearest_traffic_sliced(spark, sf):
    return marts.nearest_traffic(_placed_trips(spark, sf), fact_traffic(spark, sf)).select(*_TRAFFIC_COLUMNS)


@query("asof_nearest_weather", f"SELECT {', '.join(_WEATHER_COLUMNS)} FROM enriched")
def asof_nearest_weather(spark, sf):
    return marts.nearest_weather(_placed_trips(spark, sf), fact_weather(spark, sf)).select(*_WEATHER_COLUMNS)


@query("asof_nearest_weather_sliced", f"SELECT {', '.join(_WEATHER_COLUMNS)} FROM enriched")
def asof_nearest_weather_sliced(spark, sf):
    return marts.nearest_weather(_placed_trips(spark, sf), fact_weather(spark, sf)).select(*_WEATHER_COLUMNS)


@query(
    "asof_nearest_event",
    """SELECT p.event_id, n.event_id AS nearest_event_id, n.value AS nearest_value
       FROM (SELECT * FROM events WHERE event_type <> 'error') p
       LEFT JOIN LATERAL (
           SELECT * FROM events x WHERE x.event_type = 'error' AND x.user_id = p.user_id
           ORDER BY abs(epoch_us(p.ts) - epoch_us(x.ts)), x.ts, x.event_id LIMIT 1) n ON TRUE""",
)
def asof_nearest_event(spark, sf):
    """The same join on a key with many values: each event and its user's nearest error."""
    events = td.table(spark, sf, "events")
    errors = events.where("event_type = 'error'")
    payload = {"event_id": "nearest_event_id", "value": "nearest_value"}
    found = asof_nearest(events.where("event_type <> 'error'"), errors, "user_id", "ts", "ts", "event_id", payload)
    return found.select("event_id", "nearest_event_id", "nearest_value")


@query(
    "asof_nearest_burst",
    """WITH r AS (SELECT event_id AS rec, user_id % 7 AS k, TIMESTAMP '2024-01-01 12:00:00' + to_microseconds(event_id % 50) AS t
           FROM events WHERE event_id % 2 = 0)
       SELECT p.event_id, n.rec AS nearest_event_id FROM events p LEFT JOIN LATERAL (
           SELECT * FROM r WHERE r.k = p.user_id % 7 ORDER BY abs(epoch_us(p.ts) - epoch_us(r.t)), r.t, r.rec LIMIT 1) n ON TRUE""",
)
def asof_nearest_burst(spark, sf):
    """Readings that lie microseconds apart, and all events as probes long before and after them."""
    events = td.table(spark, sf, "events")
    at = F.expr("timestamp_ntz'2024-01-01 12:00:00' + make_dt_interval(0, 0, 0, cast(event_id % 50 AS decimal(18, 6)) / 1000000)")
    burst = events.where("event_id % 2 = 0").select(F.col("event_id").alias("rec"), (F.col("user_id") % 7).alias("k"), at.alias("t"))
    probes = events.select("event_id", (F.col("user_id") % 7).alias("k"), "ts")
    return asof_nearest(probes, burst, "k", "ts", "t", "rec", {"rec": "nearest_event_id"}).select("event_id", "nearest_event_id")


@query(
    "join_left_mart",
    """SELECT t.trip_id, t.fare, n.traffic_speed, n.weather_temp FROM staged_trips t LEFT JOIN enriched n USING (trip_id)""",
)
def join_left_mart(spark, sf):
    trips = td.staged_trips(spark, sf).select("trip_id", "fare")
    mart = enriched(spark, sf).select("trip_id", "traffic_speed", "weather_temp")
    return trips.join(mart, "trip_id", "left")


@query(
    "join_stations_zones",
    f"""SELECT station_id, station_id AS station_name, {_DECIMALS},
        CASE WHEN longitude IS NOT NULL THEN CAST(row_number() OVER
            (PARTITION BY longitude IS NULL ORDER BY station_id) AS INT) END AS zone_id FROM sites""",
)
def join_stations_zones(spark, sf):
    stations = dims.stations_table(td.sites(spark, sf))
    joined = dims.stations_with_zones(stations, dims.zones_table(voronoi_zones(stations, boundary(spark, sf))))
    return joined.select("station_id", "station_name", "longitude", "latitude", "zone_id")


@query("spjoin_point_region", "SELECT location_id, region_id FROM point_region")
def spjoin_point_region(spark, sf):
    return join_within(locations(spark, sf).select("location_id", "longitude", "latitude"), "location_id", regions(spark, sf), "region_id").select("location_id", "region_id")


@query("spjoin_point_zone", "SELECT location_id, station_id FROM point_zone")
def spjoin_point_zone(spark, sf):
    return join_within(locations(spark, sf).select("location_id", "longitude", "latitude"), "location_id", zones(spark, sf), "station_id").select("location_id", "station_id")


@query("map_locations", "SELECT location_id, region_id, station_id, batch_id FROM mapped")
def map_locations(spark, sf):
    return dims.map_locations(locations(spark, sf), regions(spark, sf), zones(spark, sf))


@query("spanti_city_boundary", "SELECT location_id, batch_id, longitude, latitude, crs FROM invalid")
def spanti_city_boundary(spark, sf):
    return dims.invalid_locations(locations(spark, sf), boundary(spark, sf))


@query("spjoin_zone_contains_site", "SELECT station_id, station_id AS zone_station_id FROM sites WHERE longitude IS NOT NULL")
def spjoin_zone_contains_site(spark, sf):
    sites = td.sites(spark, sf)
    cells = voronoi_zones(sites, boundary(spark, sf)).withColumnRenamed("station_id", "zone_station_id")
    return within_pairs(sites, "station_id", cells, "zone_station_id")


@query(
    "nearest_site",
    """SELECT l.location_id, n.station_id, round(n.distance, 9) AS distance FROM locations l LEFT JOIN LATERAL (
           SELECT s.station_id, sqrt(power(l.longitude - s.longitude, 2) + power(l.latitude - s.latitude, 2)) AS distance
           FROM sites s WHERE s.longitude IS NOT NULL AND l.longitude IS NOT NULL
           ORDER BY distance, s.station_id LIMIT 1) n ON TRUE""",
)
def nearest_site_query(spark, sf):
    found = nearest_site(
        locations(spark, sf), "location_id", col("longitude"), col("latitude"),
        td.sites(spark, sf), "station_id", col("longitude"), col("latitude"),
    )
    return found.select("location_id", "station_id", F.round("distance", 9).alias("distance"))


@query("nearest_station_metres", "SELECT location_id, station_id FROM point_zone")
def nearest_station_metres(spark, sf):
    """Zone membership without polygons: the nearest station in projected metres."""
    at = utm16n("longitude", "latitude")
    places_ = locations(spark, sf).withColumn("at", at)
    stations = dims.default_stations(spark).withColumn("at", at)
    found = nearest_site(
        places_, "location_id", col("at.x"), col("at.y"), stations, "station_id", col("at.x"), col("at.y")
    )
    return found.select("location_id", "station_id")


@query("map_location_keys", "SELECT trip_id, pickup_location_id, dropoff_location_id FROM staged_trips")
def map_location_keys(spark, sf):
    keyed = dims.map_location_keys(td.centroid_trips(spark, sf), locations(spark, sf))
    return keyed.select("trip_id", "pickup_location_id", "dropoff_location_id")


# == dimensions and upserts ======================================================================

_LOCATION_COLUMNS = "location_id, original_text, longitude, latitude, source_type"


@query("dim_locations_build", f"SELECT {_LOCATION_COLUMNS} FROM locations")
def dim_locations_build(spark, sf):
    return dims.locations_build(td.centroid_trips(spark, sf))


@query("dim_locations_update", f"SELECT {_LOCATION_COLUMNS} FROM locations")
def dim_locations_update(spark, sf):
    """The dimension of the early trips, extended by the late ones."""
    trips = td.centroid_trips(spark, sf)
    early = trips.where("trip_start_timestamp < TIMESTAMP_NTZ'2024-01-04'")
    late = trips.where("NOT coalesce(trip_start_timestamp < TIMESTAMP_NTZ'2024-01-04', false)")
    return dims.locations_update(dims.locations_build(early), late)


@query("dim_strategy", f"SELECT {_LOCATION_COLUMNS}, 'rebuild' AS strategy FROM locations UNION ALL SELECT {_LOCATION_COLUMNS}, 'incremental' FROM locations")
def dim_strategy(spark, sf):
    trips = td.centroid_trips(spark, sf)
    prior = dims.locations_build(trips.where("trip_start_timestamp < TIMESTAMP_NTZ'2024-01-04'"))
    both = [dims.location_dimension(prior, trips, s).withColumn("strategy", F.lit(s)) for s in ("rebuild", "incremental")]
    return both[0].unionByName(both[1])


_REGION_COLUMNS = "region_id, region, west, east, south, north, geometry_wkt"


@query("dim_regions_build", f"SELECT {_REGION_COLUMNS} FROM regions")
def dim_regions_build(spark, sf):
    return dims.regions_build(td.boxed_traffic(spark, sf)).select(*_REGION_COLUMNS.split(", "))


@query("dim_regions_update", f"SELECT {_REGION_COLUMNS} FROM regions")
def dim_regions_update(spark, sf):
    """The dimension of the first day's readings, extended by all others, those without a time included."""
    traffic, first = td.boxed_traffic(spark, sf), "coalesce(time < TIMESTAMP_NTZ'2024-01-02', false)"
    early, late = traffic.where(first), traffic.where(f"NOT {first}")
    return dims.regions_update(dims.regions_build(early), late).select(*_REGION_COLUMNS.split(", "))


def _area_sql(west: str, south: str, east: str, north: str) -> str:
    corners = [_utm(x, y) for x, y in ((west, south), (east, south), (east, north), (west, north))]
    twice = " + ".join(
        f"({x1} * {y2} - {x2} * {y1})" for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1])
    )
    return f"(abs({twice}) / 2 / 1e6)"


_AREA = _area_sql("west", "south", "east", "north")


@query(
    "dim_regions_export",
    f"SELECT {_REGION_COLUMNS}, round({_AREA}, 2) AS area_km2, 'b1' AS batch_id, 'EPSG:4326' AS crs FROM regions",
)
def dim_regions_export(spark, sf):
    return dims.regions_export(dims.regions_build(td.boxed_traffic(spark, sf)), "b1")


# A stored table and a later batch of changed and new rows, split by digits of the trip id: every row is
# in one of them or in both.
_STORED = "substring(trip_id, 1, 1) NOT IN ('0', '1', '2', '3')"
_BATCH = f"(substring(trip_id, 2, 1) < '8' OR NOT {_STORED})"
_KEPT = (
    "percent_time_chicago, percent_distance_chicago, pickup_community_area, dropoff_community_area, "
    "additional_charges, pickup_location_id, dropoff_location_id"
)
_CHANGED = (
    "trip_start_timestamp, trip_end_timestamp, trip_seconds, trip_miles, fare, tip, trip_total, "
    "shared_trip_authorized, trips_pooled, rate_per_mile, duration_minutes, batch_id"
)
_TRIP_BATCH_SQL = f"""
    SELECT * REPLACE (trip_start_timestamp + INTERVAL 1 DAY AS trip_start_timestamp, fare + 1 AS fare,
        'b1' AS batch_id, pickup_community_area + 100 AS pickup_community_area, CAST(NULL AS DOUBLE) AS tip)
    FROM fact_trips WHERE {_BATCH}"""


def _merged_sql(target: str, source: str, key: str, changed: str, kept: str, coalesced: bool = False) -> str:
    def new(c: str) -> str:
        both = f"coalesce(s.{c}, t.{c})" if coalesced else f"CASE WHEN s.{key} IS NOT NULL THEN s.{c} ELSE t.{c} END"
        return f"{both} AS {c}"

    columns = [f"coalesce(t.{key}, s.{key}) AS {key}", *(new(c) for c in changed.split(", "))]
    columns += [f"CASE WHEN t.{key} IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in kept.split(", ")]
    return f"SELECT {', '.join(columns)} FROM ({target}) t FULL JOIN ({source}) s ON t.{key} = s.{key}"


def _trip_batch(trips: DataFrame) -> DataFrame:
    return trips.where(_BATCH).withColumns(
        {
            "trip_start_timestamp": instants.after(col("trip_start_timestamp"), "86400"),
            "fare": col("fare") + 1,
            "batch_id": F.lit("b1"),
            "pickup_community_area": col("pickup_community_area") + 100,
            "tip": F.lit(None).cast("double"),
        }
    )


_UPSERTED_TRIPS = _merged_sql(f"SELECT * FROM fact_trips WHERE {_STORED}", _TRIP_BATCH_SQL, "trip_id", _CHANGED, _KEPT)


@query("upsert_fact_trips", _UPSERTED_TRIPS)
def upsert_fact_trips(spark, sf):
    trips = fact_trips(spark, sf)
    return facts.upsert_trips(trips.where(_STORED), _trip_batch(trips))


@query("upsert_fact_trips_stored", _UPSERTED_TRIPS)
def upsert_fact_trips_stored(spark, sf):
    """The same merge into a table partitioned by day; changed rows move to their new day."""
    wh, trips = _warehouse(spark, "facts", "fact_tables.fact_trips"), fact_trips(spark, sf)
    wh.upsert("fact_tables.fact_trips", trips.where(_STORED))
    wh.upsert("fact_tables.fact_trips", _trip_batch(trips))
    return wh.read("fact_tables.fact_trips").drop("created_at", "event_date")


_TRAFFIC_SPLIT = "CAST(record_id AS INT) % 3 <> 0"
_TRAFFIC_BATCH = "(CAST(record_id AS INT) % 2 = 0 OR CAST(record_id AS INT) % 3 = 0)"


@query(
    "upsert_fact_traffic",
    _merged_sql(
        f"SELECT * FROM fact_traffic WHERE {_TRAFFIC_SPLIT}",
        f"""SELECT * REPLACE (speed / 2 AS speed, region_id + 100 AS region_id, num_reads + 1 AS num_reads, 'b1' AS batch_id)
            FROM fact_traffic WHERE {_TRAFFIC_BATCH}""",
        "record_id", "speed, bus_count, num_reads, batch_id", "time, region_id",
    ),
)
def upsert_fact_traffic(spark, sf):
    rows = fact_traffic(spark, sf)
    batch = rows.where(_TRAFFIC_BATCH).withColumns(
        {"speed": col("speed") / 2, "region_id": col("region_id") + 100, "num_reads": col("num_reads") + 1, "batch_id": F.lit("b1")}
    )
    return facts.upsert_traffic(rows.where(_TRAFFIC_SPLIT), batch)


@query(
    "upsert_fact_weather",
    _merged_sql(
        "SELECT * FROM fact_weather WHERE station_id <> 'Estacion_A'",
        """SELECT * REPLACE (temp - 10 AS temp, datetime + INTERVAL 1 DAY AS datetime, 'Fog' AS conditions, 'b1' AS batch_id)
           FROM fact_weather WHERE day(datetime) > 10 OR station_id = 'Estacion_A'""",
        "record_id", "temp, feelslike, precipprob, windspeed, winddir, conditions, batch_id", "datetime, station_id",
    ),
)
def upsert_fact_weather(spark, sf):
    rows = fact_weather(spark, sf)
    batch = rows.where("day(datetime) > 10 OR station_id = 'Estacion_A'").withColumns(
        {
            "temp": col("temp") - 10,
            "datetime": instants.after(col("datetime"), "86400"),
            "conditions": F.lit("Fog"),
            "batch_id": F.lit("b1"),
        }
    )
    return facts.upsert_weather(rows.where("station_id <> 'Estacion_A'"), batch)


@query(
    "upsert_dim_locations",
    _merged_sql(
        "SELECT * FROM locations WHERE location_id < 'a'",
        """SELECT * REPLACE (CASE WHEN location_id < '5' THEN longitude + 1 END AS longitude, 'moved' AS source_type,
               CAST(NULL AS VARCHAR) AS batch_id, upper(original_text) AS original_text)
           FROM locations WHERE location_id > '3'""",
        "location_id", "longitude, latitude, source_type, batch_id", "original_text", coalesced=True,
    ),
)
def upsert_dim_locations(spark, sf):
    rows = locations(spark, sf)
    batch = rows.where("location_id > '3'").withColumns(
        {
            "longitude": F.when(col("location_id") < "5", col("longitude") + 1),
            "source_type": F.lit("moved"),
            "batch_id": F.lit(None).cast("string"),
            "original_text": F.upper("original_text"),
        }
    )
    return dims.upsert_locations(rows.where("location_id < 'a'"), batch)


@query(
    "upsert_dim_regions",
    _merged_sql(
        f"SELECT *, round({_AREA}, 2) AS area_km2, 'EPSG:4326' AS crs, 'b0' AS batch_id FROM regions WHERE region_id <= 20",
        f"""SELECT * REPLACE (CASE WHEN region_id % 2 = 0 THEN region || ' (new)' END AS region, west - 1 AS west),
            round({_AREA}, 2) AS area_km2, 'EPSG:4326' AS crs, 'b1' AS batch_id FROM regions WHERE region_id > 10""",
        "region_id", "region, geometry_wkt, batch_id", "west, east, south, north, area_km2, crs", coalesced=True,
    ),
)
def upsert_dim_regions(spark, sf):
    rows = regions(spark, sf)
    batch = rows.where("region_id > 10").drop("crs").withColumns(
        {
            "region": F.when(col("region_id") % 2 == 0, F.concat("region", F.lit(" (new)"))),
            "west": col("west") - 1,
            "batch_id": F.lit("b1"),
        }
    )
    return dims.upsert_regions(rows.where("region_id <= 20"), batch)


@query(
    "derive_rate_per_mile",
    """SELECT trip_id, CASE WHEN trip_miles > 0 THEN fare / trip_miles ELSE 0 END AS rate_per_mile FROM staged_trips""",
)
def derive_rate_per_mile(spark, sf):
    return td.staged_trips(spark, sf).select("trip_id", facts.rate_per_mile().alias("rate_per_mile"))


@query("derive_duration_minutes", "SELECT trip_id, trip_seconds / 60.0::DOUBLE AS duration_minutes FROM staged_trips")
def derive_duration_minutes(spark, sf):
    return td.staged_trips(spark, sf).select("trip_id", facts.duration_minutes().alias("duration_minutes"))


# == aggregations, windows, sets =================================================================

_HOURLY = """
    SELECT date_trunc('hour', trip_start_timestamp) AS trip_hour, pickup_community_area, count(trip_id) AS total_trips,
        floor(avg(rate_per_mile) * 1e8::DOUBLE + 0.5::DOUBLE) / 1e8::DOUBLE AS avg_rate_per_mile,
        floor(avg(duration_minutes) * 1e8::DOUBLE + 0.5::DOUBLE) / 1e8::DOUBLE AS avg_duration_minutes
    FROM fact_trips WHERE pickup_community_area IS NOT NULL GROUP BY 1, 2"""


def _rounded(df: DataFrame) -> DataFrame:
    """Averages to eight places, halves up: their last digits depend on the order of the additions."""
    places_ = {c: F.expr(f"floor({c} * 1e8D + 0.5D) / 1e8D") for c in ("avg_rate_per_mile", "avg_duration_minutes")}
    return df.withColumns(places_)


@query("agg_hourly_pickup", _HOURLY)
def agg_hourly_pickup(spark, sf):
    return _rounded(marts.hourly_pickup(fact_trips(spark, sf)))


@query("agg_count_gate", "SELECT 'staged trips' AS name, count(*) AS n_rows FROM staged_trips")
def agg_count_gate(spark, sf):
    n = checks.count_gate(td.staged_trips(spark, sf), "staged trips")
    return spark.createDataFrame([("staged trips", n)], "name string, n_rows bigint")


@query("agg_sum_area", f"SELECT round(sum({_AREA}), 2) AS area_km2 FROM regions")
def agg_sum_area(spark, sf):
    return polygon_areas(regions(spark, sf), "region_id").agg(F.bround(F.sum("km2"), 2).alias("area_km2"))


@query("agg_union_geometry", "SELECT location_id FROM in_city")
def agg_union_geometry(spark, sf):
    """Locations inside the union of the landed boundary polygons, their shared edges dissolved."""
    whole = dims.city_boundary_table(td.city_polygons(spark))
    return within_pairs(locations(spark, sf), "location_id", whole, "boundary_id").select("location_id")


_BOXES = """SELECT s_nationkey AS nation, (s_suppkey * 37 % 100) / 10.0::DOUBLE AS x0, (s_suppkey * 61 % 100) / 10.0::DOUBLE AS y0,
    (s_suppkey * 37 % 100 + 10 + s_suppkey % 5 * 8) / 10.0::DOUBLE AS x1, (s_suppkey * 61 % 100 + 12 + s_suppkey % 7 * 9) / 10.0::DOUBLE AS y1 FROM supplier"""


@query(
    "union_of_overlaps",
    f"""WITH b AS ({_BOXES}),
        xs AS (SELECT nation, x0 AS xa, lead(x0) OVER (PARTITION BY nation ORDER BY x0) AS xb FROM (SELECT nation, x0 FROM b UNION SELECT nation, x1 FROM b)),
        ys AS (SELECT nation, y0 AS ya, lead(y0) OVER (PARTITION BY nation ORDER BY y0) AS yb FROM (SELECT nation, y0 FROM b UNION SELECT nation, y1 FROM b))
        SELECT nation, round(sum((xb - xa) * (yb - ya)), 6) AS area FROM xs JOIN ys USING (nation) WHERE EXISTS (SELECT 1 FROM b
            WHERE b.nation = xs.nation AND x0 <= xa AND x1 >= xb AND y0 <= ya AND y1 >= yb) GROUP BY nation""",
)
def union_of_overlaps(spark, sf):
    """The area of the union of each nation's boxes, one a supplier, which overlap, touch and lie inside each other."""
    boxes = td.table(spark, sf, "supplier").select(
        col("s_nationkey").alias("nation"), ((col("s_suppkey") * 37 % 100) / 10).alias("x0"), ((col("s_suppkey") * 61 % 100) / 10).alias("y0"),
        ((col("s_suppkey") * 37 % 100 + 10 + col("s_suppkey") % 5 * 8) / 10).alias("x1"), ((col("s_suppkey") * 61 % 100 + 12 + col("s_suppkey") % 7 * 9) / 10).alias("y1"),
    )
    whole = dissolve(boxes.select("nation", wkt_rectangle(col("x0"), col("y0"), col("x1"), col("y1")).alias("geometry_wkt")), "nation")
    # Shells run counter-clockwise and holes clockwise.
    return polygon_edges(whole, "nation").groupBy("nation").agg(F.round(F.sum(col("x1") * col("y2") - col("x2") * col("y1")) / 2, 6).alias("area"))


@query(
    "spjoin_partly_shared",
    """SELECT location_id FROM locations WHERE (longitude > -87.86 AND longitude < -87.7 AND latitude > 41.69 AND latitude < 41.99)
        OR (longitude > -87.7 AND longitude < -87.52 AND latitude > 41.75 AND latitude < 41.9)
        OR (longitude = -87.7 AND latitude > 41.75 AND latitude < 41.9)""",
)
def spjoin_partly_shared(spark, sf):
    """Locations inside two parts of one geometry that have a piece of an edge in common."""
    wide = "((-87.86 41.69, -87.7 41.69, -87.7 41.99, -87.86 41.99, -87.86 41.69))"
    low = "((-87.7 41.75, -87.52 41.75, -87.52 41.9, -87.7 41.9, -87.7 41.75))"
    both = spark.createDataFrame([(1, f"MULTIPOLYGON ({wide}, {low})")], "poly int, geometry_wkt string")
    return within_pairs(locations(spark, sf), "location_id", both, "poly").select("location_id")


_SKYLINE = """(SELECT 1 AS poly, x AS x1, y AS y1, coalesce(lead(x) OVER o, first_value(x) OVER o) AS x2,
        coalesce(lead(y) OVER o, first_value(y) OVER o) AS y2
    FROM (SELECT c_custkey AS k, -87.9::DOUBLE + c_custkey::DOUBLE / 5000::DOUBLE AS x,
            41.75::DOUBLE + (c_custkey * 37 % 100)::DOUBLE / 500::DOUBLE AS y FROM customer
        UNION ALL SELECT 0, -87.9::DOUBLE, 41.6::DOUBLE
        UNION ALL SELECT max(c_custkey) + 1, -87.9::DOUBLE + (max(c_custkey) + 1)::DOUBLE / 5000::DOUBLE, 41.6::DOUBLE FROM customer)
    WINDOW o AS (ORDER BY k))"""


@query("spjoin_many_edges", f"SELECT DISTINCT location_id FROM ({_inside('locations', _SKYLINE)})")
def spjoin_many_edges(spark, sf):
    """Locations inside one polygon with a corner for every customer."""
    k = td.table(spark, sf, "customer").select(col("c_custkey").cast("bigint").alias("k"))
    corners = k.selectExpr("k", "-87.9D + k / 5000D AS x", "41.75D + (k * 37 % 100) / 500D AS y")
    corners = corners.unionAll(spark.range(1).selectExpr("0", "-87.9D", "41.6D"))
    corners = corners.unionAll(k.agg(F.max("k").alias("k")).selectExpr("k + 1", "-87.9D + (k + 1) / 5000D", "41.6D"))
    ring = corners.agg(F.array_sort(F.collect_list(F.struct("k", "x", "y"))).alias("p"))
    text = "concat('POLYGON ((', array_join(transform(concat(p, slice(p, 1, 1)), c -> concat(c.x, ' ', c.y)), ', '), '))')"
    skyline = ring.selectExpr("1 AS poly", f"{text} AS geometry_wkt")
    return within_pairs(locations(spark, sf), "location_id", skyline, "poly").select("location_id")


@query("win_started_cum", "SELECT trip_id, n_started FROM windowed")
def win_started_cum(spark, sf):
    trips = fact_trips(spark, sf).select("trip_id", "trip_start_timestamp")
    return counts.started_up_to(trips, "trip_start_timestamp", "n_started").select("trip_id", "n_started")


@query("win_ended_before_end", "SELECT trip_id, n_ended FROM windowed")
def win_ended_before_end(spark, sf):
    trips = fact_trips(spark, sf).select("trip_id", "trip_end_timestamp")
    return counts.ended_before_end(trips, "trip_end_timestamp", "n_ended").select("trip_id", "n_ended")


@query("win_active_trips", "SELECT trip_id, n_started - n_ended AS active_trips_total FROM windowed")
def win_active_trips(spark, sf):
    trips = fact_trips(spark, sf).select("trip_id", "trip_start_timestamp", "trip_end_timestamp")
    return counts.active_rows(trips, "trip_start_timestamp", "trip_end_timestamp").select("trip_id", "active_trips_total")


@query("win_recent_pickups_30m", "SELECT trip_id, n_recent AS trips_from_pickup_loc_last_30m FROM windowed")
def win_recent_pickups_30m(spark, sf):
    trips = fact_trips(spark, sf).select("trip_id", "pickup_location_id", "trip_start_timestamp")
    name = "trips_from_pickup_loc_last_30m"
    return counts.recent_rows(trips, "pickup_location_id", "trip_start_timestamp", name).select("trip_id", name)


@query(
    "win_recent_events_by_type",
    """SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY ts
        RANGE BETWEEN INTERVAL '30 minutes' PRECEDING AND INTERVAL '1 second' PRECEDING) AS n_recent FROM events""",
)
def win_recent_events_by_type(spark, sf):
    """The same count with a fifth of all rows under each key."""
    events = td.table(spark, sf, "events").select("event_id", "event_type", "ts")
    return counts.recent_rows(events, "event_type", "ts", "n_recent").select("event_id", "n_recent")


@query(
    "set_stack_columns",
    """SELECT pickup_centroid_location AS original_text FROM centroid_trips
       UNION ALL SELECT dropoff_centroid_location FROM centroid_trips""",
)
def set_stack_columns(spark, sf):
    trips = td.centroid_trips(spark, sf)
    return trips.select(col("pickup_centroid_location").alias("original_text")).unionAll(
        trips.select(col("dropoff_centroid_location").alias("original_text"))
    )


@query(
    "set_stack_frames",
    "SELECT record_id, region_id, speed FROM fact_traffic UNION ALL SELECT record_id, NULL, temp FROM fact_weather",
)
def set_stack_frames(spark, sf):
    weather = fact_weather(spark, sf).select(col("temp").alias("speed"), "record_id")
    return fact_traffic(spark, sf).select("record_id", "region_id", "speed").unionByName(weather, allowMissingColumns=True)


@query("set_distinct_rows", "SELECT original_text FROM centroid_texts")
def set_distinct_rows(spark, sf):
    return dims.stacked_centroids(td.centroid_trips(spark, sf))


# == scalar functions ============================================================================


@query("cast_timestamp", "SELECT trip_id, trip_start_timestamp FROM staged_trips")
def cast_timestamp(spark, sf):
    return td.raw_trips(spark, sf).select(
        "trip_id", typing.cast_timestamp(col("trip_start_timestamp")).alias("trip_start_timestamp")
    )


@query(
    "cast_int_rounded",
    """SELECT record_id, CAST(bus_count AS BIGINT) AS bus_count,
        CAST(round_even(east, 0) AS BIGINT) AS east, 9007199254740993 + 1000 * CAST(record_id AS BIGINT) AS long_number FROM raw_traffic""",
)
def cast_int_rounded(spark, sf):
    return td.raw_traffic(spark, sf).select(
        "record_id",
        typing.cast_int_rounded(col("bus_count")).alias("bus_count"),
        typing.cast_int_rounded(col("east")).alias("east"),
        # Text of whole numbers that no double holds.
        typing.cast_int_rounded((F.lit(9007199254740993) + 1000 * col("record_id").cast("bigint")).cast("string")).alias("long_number"),
    )


@query(
    "cast_double",
    f"""SELECT record_id, speed, west, CASE WHEN regexp_matches(code, '{NUMBER}') THEN TRY_CAST(trim(code) AS DOUBLE) END
        AS code FROM (SELECT *, list_extract(['1.0f', ' 7 ', '1e3', '', '.5', '-2.', '0x1F', '12.xx'],
            CAST(CAST(record_id AS INT) % 8 AS INT) + 1) AS code FROM raw_traffic)""",
)
def cast_double(spark, sf):
    codes = F.array(*[F.lit(v) for v in ("1.0f", " 7 ", "1e3", "", ".5", "-2.", "0x1F", "12.xx")])
    return td.raw_traffic(spark, sf).select(
        "record_id",
        typing.cast_double(col("speed")).alias("speed"),
        typing.cast_double(col("west")).alias("west"),
        typing.cast_double(F.get(codes, col("record_id").cast("int") % 8)).alias("code"),
    )


@query(
    "cast_bool_map",
    """SELECT trip_id, shared_trip_authorized,
        CASE e % 8 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN true WHEN 3 THEN false WHEN 4 THEN false
            WHEN 5 THEN false END AS worded,
        CASE e % 3 WHEN 0 THEN false WHEN 1 THEN true END AS numbered
       FROM staged_trips JOIN (SELECT sha1(e::VARCHAR) AS trip_id, e FROM e) USING (trip_id)""",
)
def cast_bool_map(spark, sf):
    words = F.array(*[F.lit(v) for v in ("true", "True", "1", "false", "False", "0", "yes", "TRUE")])
    numbered = td.raw_trips(spark, sf).join(
        td.table(spark, sf, "events").select(F.sha1(col("event_id").cast("string")).alias("trip_id"), "event_id"), "trip_id"
    )
    return numbered.select(
        "trip_id",
        typing.cast_bool_map(col("shared_trip_authorized")).alias("shared_trip_authorized"),
        typing.cast_bool_map(F.get(words, (col("event_id") % 8).cast("int"))).alias("worded"),
        typing.cast_bool_map((col("event_id") % 3).cast("double")).alias("numbered"),
    )


@query("cast_string", "SELECT event_id::VARCHAR AS event_id, value::VARCHAR AS value FROM events")
def cast_string(spark, sf):
    return td.table(spark, sf, "events").select(
        typing.cast_string(col("event_id")).alias("event_id"), typing.cast_string(col("value")).alias("value")
    )


@query("cast_frame", "SELECT record_id, time, region_id, speed, region, bus_count, num_reads, batch_id FROM traffic")
def cast_frame(spark, sf):
    return typing.cast_frame(extracts.add_batch_id(td.raw_traffic(spark, sf), "b0"), TRAFFIC).select(*_TRAFFIC_OUT)


@query("hash_id", "SELECT doc_id, left(sha1(text), 16) AS id16, left(sha1(text), 8) AS id8 FROM documents")
def hash_id(spark, sf):
    return td.table(spark, sf, "documents").select(
        "doc_id", places.hash_id(col("text")).alias("id16"), places.hash_id(col("text"), 8).alias("id8")
    )


@query(
    "geojson_point",
    """SELECT t.trip_id, l.longitude AS lon, l.latitude AS lat FROM centroid_trips t
       LEFT JOIN locations l ON t.pickup_centroid_location = l.original_text""",
)
def geojson_point(spark, sf):
    return td.centroid_trips(spark, sf).select("trip_id", places.geojson_point(col("pickup_centroid_location")).alias("p")).select(
        "trip_id", "p.lon", "p.lat"
    )


@query("date_hour_trunc", "SELECT event_id, date_trunc('hour', ts) AS hour FROM events")
def date_hour_trunc(spark, sf):
    return td.table(spark, sf, "events").select("event_id", instants.hour_trunc(col("ts")).alias("hour"))


@query(
    "date_parts",
    """SELECT event_id, CAST(extract(hour FROM ts) AS INT) AS start_hour, CAST(extract(dow FROM ts) AS INT) AS day_of_week,
        CAST(extract(month FROM ts) AS INT) AS month_of_trip FROM events""",
)
def date_parts(spark, sf):
    ts = col("ts")
    return td.table(spark, sf, "events").select(
        "event_id",
        instants.start_hour(ts).alias("start_hour"),
        instants.day_of_week(ts).alias("day_of_week"),
        instants.month_of(ts).alias("month_of_trip"),
    )


@query(
    "date_epoch_diff",
    """SELECT trip_id, round(abs(epoch_us(trip_end_timestamp) - epoch_us(trip_start_timestamp)) / 1e6, 6) AS seconds
       FROM staged_trips""",
)
def date_epoch_diff(spark, sf):
    gap = instants.epoch_diff(col("trip_end_timestamp"), col("trip_start_timestamp"))
    return td.staged_trips(spark, sf).select("trip_id", F.round(gap, 6).alias("seconds"))


@query(
    "date_from_iso",
    """SELECT trip_id, CAST(trip_start_timestamp AS DATE) AS day,
        coalesce(CAST(trip_start_timestamp AS DATE), DATE '2025-09-01') AS day_or_default FROM staged_trips""",
)
def date_from_iso(spark, sf):
    day = instants.date_from_iso(col("trip_start_timestamp"))
    default = instants.date_from_iso(F.lit(extracts.START_DATE))
    return td.raw_trips(spark, sf).select("trip_id", day.alias("day"), F.coalesce(day, default).alias("day_or_default"))


@query("str_record_key", "SELECT record_id FROM weather")
def str_record_key(spark, sf):
    return td.staged_weather(spark, sf).select(places.record_key(col("station_id"), col("datetime").cast("date")).alias("record_id"))


@query("str_latlon", "SELECT location_id, latitude || ',' || longitude AS latlon FROM locations WHERE longitude IS NOT NULL")
def str_latlon(spark, sf):
    placed = locations(spark, sf).where("longitude IS NOT NULL")
    return placed.select("location_id", places.latlon_text(col("latitude"), col("longitude")).alias("latlon"))


@query(
    "math_sqrt_power",
    """SELECT location_id, round(sqrt(power(-87.6298 - longitude, 2) + power(41.8781 - latitude, 2)), 9) AS distance
       FROM locations""",
)
def math_sqrt_power(spark, sf):
    distance = euclid(F.lit(-87.6298), F.lit(41.8781), col("longitude"), col("latitude"))
    return locations(spark, sf).select("location_id", F.round(distance, 9).alias("distance"))


@query(
    "null_coalesce_case",
    """SELECT trip_id, coalesce(fare, tip) AS paid, CASE WHEN trip_miles > 5 THEN 'far' WHEN trip_miles > 0 THEN 'near' ELSE 'none' END
        AS reach, trip_end_timestamp IS NOT NULL AS is_closed, trip_id LIKE '%a0' AS is_sampled FROM staged_trips
        WHERE trip_start_timestamp BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-30'""",
)
def null_coalesce_case(spark, sf):
    trips = extracts.in_closed_range(td.staged_trips(spark, sf), "trip_start_timestamp", "2024-01-02", "2024-01-30")
    return trips.select(
        "trip_id",
        F.coalesce("fare", "tip").alias("paid"),
        F.when(col("trip_miles") > 5, "far").when(col("trip_miles") > 0, "near").otherwise("none").alias("reach"),
        col("trip_end_timestamp").isNotNull().alias("is_closed"),
        col("trip_id").like("%a0").alias("is_sampled"),
    )


@query(
    "geo_wkt_parse",
    """SELECT region_id, west AS x1, south AS y1, east AS x2, south AS y2 FROM regions
       UNION ALL SELECT region_id, east, south, east, north FROM regions
       UNION ALL SELECT region_id, east, north, west, north FROM regions
       UNION ALL SELECT region_id, west, north, west, south FROM regions""",
)
def geo_wkt_parse(spark, sf):
    return polygon_edges(regions(spark, sf), "region_id").select("region_id", "x1", "y1", "x2", "y2")


@query("geo_wkt_format", "SELECT record_id, CASE WHEN west IS NOT NULL THEN geometry_wkt END AS geometry_wkt FROM raw_traffic LEFT JOIN regions USING (region_id, west)")
def geo_wkt_format(spark, sf):
    box = [typing.cast_double(col(c)) for c in ("west", "south", "east", "north")]
    return td.raw_traffic(spark, sf).select("record_id", wkt_rectangle(*box).alias("geometry_wkt"))


@query(
    "geo_point",
    "SELECT location_id, 'POINT (' || longitude || ' ' || latitude || ')' AS geometry_wkt FROM locations",
)
def geo_point(spark, sf):
    return locations(spark, sf).select("location_id", wkt_point(col("longitude"), col("latitude")).alias("geometry_wkt"))


_UX, _UY = _utm("longitude", "latitude")


@query("geo_utm16n", f"SELECT location_id, round({_UX}, 3) AS easting, round({_UY}, 3) AS northing FROM locations")
def geo_utm16n(spark, sf):
    at = locations(spark, sf).select("location_id", utm16n("longitude", "latitude").alias("at"))
    return at.select("location_id", F.round("at.x", 3).alias("easting"), F.round("at.y", 3).alias("northing"))


@query("geo_area_km2", f"SELECT region_id, round({_AREA}, 2) AS area_km2 FROM regions")
def geo_area_km2(spark, sf):
    return polygon_areas(regions(spark, sf), "region_id").select("region_id", F.bround("km2", 2).alias("area_km2"))


# == spatial construction and checks =============================================================


@query(
    "stations_table",
    f"""SELECT station_id, station_id AS station_name, {_DECIMALS},
        'POINT (' || longitude || ' ' || latitude || ')' AS geometry_wkt, 'EPSG:4326' AS crs FROM sites""",
)
def stations_table(spark, sf):
    return dims.stations_table(td.sites(spark, sf))


# Rectangles, hole and wedge of the test boundary, by the same shoelace formula.
_WEDGE = [_utm("-87.9", "41.68"), _utm("-87.87", "41.68"), _utm("-87.885", "41.72")]
_WEDGE_AREA = (
    "(abs("
    + " + ".join(f"({x1} * {y2} - {x2} * {y1})" for (x1, y1), (x2, y2) in zip(_WEDGE, _WEDGE[1:] + _WEDGE[:1]))
    + ") / 2 / 1e6)"
)
_CITY_AREA = (
    _area_sql("-87.86", "41.69", "-87.7", "41.99")
    + " + " + _area_sql("-87.7", "41.69", "-87.52", "41.99")
    + " - " + _area_sql("-87.8", "41.85", "-87.76", "41.88")
    + " + " + _WEDGE_AREA
)


@query(
    "city_boundary_table",
    f"""SELECT l.location_id, 'Chicago' AS city_name, CAST(round({_CITY_AREA}, 2) AS DECIMAL(10,2)) AS area_km2, 'EPSG:4326' AS crs
        FROM in_city l""",
)
def city_boundary_table(spark, sf):
    """The one-row boundary, joined to every location inside it."""
    city = boundary(spark, sf)
    inside = within_pairs(locations(spark, sf), "location_id", city, "boundary_id")
    return inside.join(city, "boundary_id").select("location_id", "city_name", "area_km2", "crs")


# Corners of a zone are centres of circles through three sites, crossings of a bisector with the frame, or
# corners of the frame: those with no site nearer than the zone's own. Metres from a point in the city.
_ZONES = f"""WITH p AS (SELECT station_id AS id, {_utm('longitude', 'latitude')[0]} - 445000 AS x,
        {_utm('longitude', 'latitude')[1]} - 4635000 AS y FROM sites WHERE longitude IS NOT NULL),
    b AS (SELECT {_utm('x1', 'y1')[0]} - 445000 AS x, {_utm('x1', 'y1')[1]} - 4635000 AS y FROM city_edges),
    g AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, greatest(max(x) - min(x), max(y) - min(y)) AS m FROM p),
    f AS (SELECT least(x0 - m, (SELECT min(x) FROM b)) AS x0, greatest(x1 + m, (SELECT max(x) FROM b)) AS x1,
        least(y0 - m, (SELECT min(y) FROM b)) AS y0, greatest(y1 + m, (SELECT max(y) FROM b)) AS y1 FROM g),
    two AS (SELECT a.id, a.x, a.y, c.id AS jd, c.x - a.x AS ux, c.y - a.y AS uy FROM p a JOIN p c ON a.id <> c.id),
    three AS (SELECT u.id, u.x, u.y, 2 * (u.ux * v.uy - u.uy * v.ux) AS d, u.ux AS ux, u.uy AS uy, v.ux AS vx, v.uy AS vy,
        u.ux ** 2 + u.uy ** 2 AS bb, v.ux ** 2 + v.uy ** 2 AS cc FROM two u JOIN two v ON u.id = v.id AND u.jd < v.jd),
    spots AS (
        SELECT id, x, y, x + (vy * bb - uy * cc) / d AS px, y + (ux * cc - vx * bb) / d AS py FROM three WHERE d <> 0
        UNION ALL SELECT id, x, y, w.v, y + ((ux ** 2 + uy ** 2) / 2 - ux * (w.v - x)) / uy
            FROM two, (SELECT x0 AS v FROM f UNION ALL SELECT x1 FROM f) w WHERE uy <> 0
        UNION ALL SELECT id, x, y, x + ((ux ** 2 + uy ** 2) / 2 - uy * (w.v - y)) / ux, w.v
            FROM two, (SELECT y0 AS v FROM f UNION ALL SELECT y1 FROM f) w WHERE ux <> 0
        UNION ALL SELECT id, x, y, w.v, z.v FROM p, (SELECT x0 AS v FROM f UNION ALL SELECT x1 FROM f) w,
            (SELECT y0 AS v FROM f UNION ALL SELECT y1 FROM f) z),
    corners AS (SELECT DISTINCT id, x, y, round(px, 4) AS px, round(py, 4) AS py FROM spots s, f
        WHERE px BETWEEN f.x0 - 1e-5 AND f.x1 + 1e-5 AND py BETWEEN f.y0 - 1e-5 AND f.y1 + 1e-5 AND NOT EXISTS (SELECT 1 FROM p k
            WHERE sqrt((k.x - px) ** 2 + (k.y - py) ** 2) < sqrt((s.x - px) ** 2 + (s.y - py) ** 2) - 1e-5)),
    rings AS (SELECT id, px, py, coalesce(lead(px) OVER w, first_value(px) OVER w) AS qx, coalesce(lead(py) OVER w, first_value(py) OVER w) AS qy
        FROM corners WINDOW w AS (PARTITION BY id ORDER BY atan2(py - y, px - x)))
    SELECT id AS station_id, round(abs(sum(px * qy - qx * py)) / 2e6, 2) AS area_km2, count(*) AS n_corners FROM rings GROUP BY id"""


@query("voronoi_zones", f"SELECT * FROM ({_ZONES})")
def voronoi_zones_query(spark, sf):
    zones_ = voronoi_zones(td.sites(spark, sf), boundary(spark, sf))
    return zones_.select("station_id", "area_km2", (F.regexp_count("geometry_wkt", F.lit(","))).cast("bigint").alias("n_corners"))


def _check(name: str, table: str, bad: str) -> str:
    return f"SELECT '{name}' AS rule, count(*) AS n_rows, count(*) FILTER (WHERE {bad}) AS n_bad FROM {table}"


def _measured(name: str, table: DataFrame, bad: DataFrame) -> DataFrame:
    """One row: the rule, the rows it was applied to, and the rows that break it."""
    flagged = table.select(F.lit(0).alias("bad")).unionAll(bad.select(F.lit(1).alias("bad")))
    one = F.when(col("bad") == 0, 1).otherwise(0)
    return flagged.agg(
        F.lit(name).alias("rule"),
        F.coalesce(F.sum(one), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum("bad"), F.lit(0)).cast("bigint").alias("n_bad"),
    )


@query(
    "check_stations_range",
    _check("station range", "sites", "longitude NOT BETWEEN -180 AND 180 OR latitude NOT BETWEEN -90 AND 90"),
)
def check_stations_range(spark, sf):
    stations = dims.stations_table(td.sites(spark, sf))
    return _measured("station range", stations, checks.station_range_rows(stations))


@query("check_area_positive", _check("area positive", "regions", "abs((east - west) * (north - south)) <= 0"))
def check_area_positive(spark, sf):
    rows = regions(spark, sf)
    return _measured("area positive", rows, checks.area_rows(rows))


@query(
    "check_unique_key",
    """SELECT 'region of a reading' AS rule, (SELECT count(*) FROM fact_traffic) AS n_rows,
        (SELECT count(*) FROM (SELECT region_id, time FROM fact_traffic GROUP BY ALL HAVING count(*) > 1)) AS n_bad
       UNION ALL SELECT 'record of a reading', (SELECT count(*) FROM fact_traffic), 0""",
)
def check_unique_key(spark, sf):
    rows = fact_traffic(spark, sf)
    return _measured("region of a reading", rows, checks.duplicate_key_rows(rows, "region_id", "time")).unionAll(
        _measured("record of a reading", rows, checks.duplicate_key_rows(rows, "record_id"))
    )


@query(
    "check_foreign_key",
    """SELECT 'trips.pickup' AS rule, (SELECT count(*) FROM staged_trips) AS n_rows,
        (SELECT count(*) FROM staged_trips WHERE pickup_location_id NOT IN (SELECT location_id FROM in_city)) AS n_bad
       UNION ALL SELECT 'traffic.region', (SELECT count(*) FROM fact_traffic),
        (SELECT count(*) FROM fact_traffic WHERE region_id NOT IN (SELECT region_id FROM regions))""",
)
def check_foreign_key(spark, sf):
    trips, traffic = td.staged_trips(spark, sf), fact_traffic(spark, sf)
    in_city = locations(spark, sf).join(invalid(spark, sf).select("location_id"), "location_id", "left_anti")
    return _measured(
        "trips.pickup", trips, checks.orphan_rows(trips, "pickup_location_id", in_city, "location_id")
    ).unionAll(_measured("traffic.region", traffic, checks.orphan_rows(traffic, "region_id", regions(spark, sf), "region_id")))


@query(
    "check_nonempty_extract",
    f"""SELECT trip_id FROM centroid_trips WHERE trip_start_timestamp BETWEEN {START} AND {END}
        AND percent_time_chicago = 1 AND pickup_centroid_location IS NOT NULL""",
)
def check_nonempty_extract(spark, sf):
    extract = extracts.extract_trips(td.raw_trips(spark, sf), td.START, td.END, "b0")
    checks.require_rows(extract, "trips extract")
    return extract.select("trip_id")


@query("check_nonempty_dims", "SELECT 'locations' AS dim, count(*) AS n_rows FROM locations UNION ALL SELECT 'regions', count(*) FROM regions")
def check_nonempty_dims(spark, sf):
    out = []
    for name, dim in (("locations", locations(spark, sf)), ("regions", regions(spark, sf))):
        checks.require_rows(dim, name)
        out.append(dim.agg(F.lit(name).alias("dim"), F.count(F.lit(1)).alias("n_rows")))
    return out[0].unionAll(out[1])


@query("geo_crs_check", "SELECT 'crs' AS rule, (SELECT count(*) FROM regions) + (SELECT count(*) FROM invalid) AS n_rows, 0 AS n_bad")
def geo_crs_check(spark, sf):
    tagged = regions(spark, sf).select("crs").unionAll(invalid(spark, sf).select("crs"))
    dims.require_crs(tagged)
    return _measured("crs", tagged, checks.crs_rows(tagged, "EPSG:4326"))


@query(
    "geo_reproject",
    """SELECT region_id, 'EPSG:4326' AS crs, round(west, 9) AS west, round(south, 9) AS south, round(east, 9) AS east, round(north, 9) AS north FROM regions""",
)
def geo_reproject(spark, sf):
    """The regions' rectangles in metres, and back in degrees: the corners as they were, to a nanodegree."""
    back = dims.in_degrees(reprojected(regions(spark, sf).select("region_id", "geometry_wkt", "crs"), "EPSG:26916"))[0]
    ends = polygon_edges(back, "region_id").groupBy("region_id").agg(
        F.round(F.min("x1"), 9).alias("west"), F.round(F.min("y1"), 9).alias("south"), F.round(F.max("x1"), 9).alias("east"), F.round(F.max("y1"), 9).alias("north")
    )
    return ends.join(back.select("region_id", "crs"), "region_id")


# == marts and runs ==============================================================================


@query("mart_hourly_pickup", _HOURLY)
def mart_hourly_pickup(spark, sf):
    wh = _warehouse(spark, "hourly", "datamarts.dm_trips_hourly_pickup_stats")
    wh.replace("datamarts.dm_trips_hourly_pickup_stats", marts.hourly_pickup(fact_trips(spark, sf)))
    return _rounded(wh.read("datamarts.dm_trips_hourly_pickup_stats"))


@query("mart_trips_enriched", f"SELECT {', '.join(marts.ENRICHED)} FROM enriched")
def mart_trips_enriched(spark, sf):
    return marts.trips_enriched(fact_trips(spark, sf), mapped(spark, sf), fact_traffic(spark, sf), fact_weather(spark, sf))


@query("mart_ml_base", "SELECT * FROM ml_base")
def mart_ml_base(spark, sf):
    return marts.ml_base(fact_trips(spark, sf), mapped(spark, sf), fact_traffic(spark, sf), fact_weather(spark, sf))


@query("mart_ml_base_from_enriched", "SELECT * FROM ml_base")
def mart_ml_base_from_enriched(spark, sf):
    return marts.ml_base_from_mart(fact_trips(spark, sf), enriched(spark, sf))


@query("mart_refresh", "SELECT * FROM ml_base")
def mart_refresh(spark, sf):
    """Facts into tables, all marts refreshed, the feature table read back."""
    wh = _warehouse(spark, "marts")
    wh.upsert("fact_tables.fact_trips", fact_trips(spark, sf))
    wh.upsert("fact_tables.fact_traffic", fact_traffic(spark, sf))
    wh.upsert("fact_tables.fact_weather", fact_weather(spark, sf))
    wh.replace("dim_spatial.mapped_locations", mapped(spark, sf))
    jobs.refresh_marts(wh)
    return wh.read("datamarts.ml_base_table")


def _landed(spark: SparkSession, sf: str) -> jobs.Landed:
    """The three feeds as landed JSON, read back as raw frames."""
    trips, traffic, weather = (new_folder(spark, f"landed-{n}") for n in ("trips", "traffic", "weather"))
    landing.land_by_day(td.raw_trips(spark, sf), "trip_start_timestamp", trips)
    landing.land_by_day(td.raw_traffic(spark, sf), "time", traffic)
    td.weather_payloads(spark, sf).write.partitionBy("station_id").text(weather)
    return jobs.Landed(
        landing.read_records(spark, trips, landing.TRIP_FIELDS),
        landing.read_records(spark, traffic, landing.TRAFFIC_FIELDS),
        landing.read_weather(spark, weather),
    )


def _extracted(last: str) -> dict[str, str]:
    """Overrides: what the extracts of a run up to ``last`` (excluded) let through."""
    return {
        "centroid_trips": f"""
            SELECT * FROM ({CTES['centroid_trips']}) WHERE trip_start_timestamp >= {START} AND trip_start_timestamp < {last}
                AND percent_time_chicago = 1 AND pickup_centroid_location IS NOT NULL""",
        "raw_traffic": f"SELECT * FROM ({CTES['raw_traffic']}) WHERE time >= {START} AND time < {last}",
        "weather": f"SELECT * FROM ({CTES['weather']}) WHERE datetime >= {START} AND datetime < {last}",
    }


@query("pipe_coldstart", "SELECT * FROM ml_base", **_extracted("TIMESTAMP '2024-01-31'"))
def pipe_coldstart(spark, sf):
    wh = _warehouse(spark, "coldstart")
    jobs.coldstart(
        wh, _landed(spark, sf), dims.default_stations(spark), td.city_polygons(spark),
        "2024-01-01T00:00:00", "2024-01-30T23:59:59.999999", "cold__try1",
    )
    return wh.read("datamarts.ml_base_table")


@query("pipe_incremental", "SELECT * FROM ml_base", **_extracted("TIMESTAMP '2024-01-31'"))
def pipe_incremental(spark, sf):
    """A cold start and the day after it."""
    wh, landed = _warehouse(spark, "daily"), _landed(spark, sf)
    jobs.coldstart(
        wh, landed, dims.default_stations(spark), td.city_polygons(spark),
        "2024-01-01T00:00:00", "2024-01-29T23:59:59.999999", "cold__try1",
    )
    jobs.incremental(
        wh, landed, "2024-01-30T00:00:00", "2024-01-31T00:00:00", "day30__try1"
    )
    return wh.read("datamarts.ml_base_table")
