"""The two runs: the one-off cold start and the daily increment."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from tripmill.operators.checks import area_rows, count_gate, orphan_rows, require_none, require_rows, station_range_rows
from tripmill.operators.zones import voronoi_zones
from tripmill.plans import dims, extracts, facts, marts
from tripmill.plans.extracts import add_batch_id
from tripmill.plans.schemas import TRAFFIC
from tripmill.sources import landing
from tripmill.sources.warehouse import Warehouse


@dataclass
class Landed:
    """Raw frames of the feeds, as read by ``sources.landing``."""

    trips: DataFrame
    traffic: DataFrame
    weather: DataFrame


def coldstart(
    wh: Warehouse,
    landed: Landed,
    stations: DataFrame,
    boundary: DataFrame,
    start: str,
    end: str,
    batch_id: str,
    trip_suffix: str | None = None,
    traffic_limit: int | None = None,
) -> int:
    """Everything from scratch for ``[start, end]``; returns the number of staged trips.

    All landed rows are taken, unless a sample of trips or a number of readings is asked for.
    The fact window is closed one minute after ``end``, so that the last minute is kept.
    """
    wh.create()
    city = dims.city_boundary_table(boundary)
    points = dims.stations_table(stations)
    require_none(station_range_rows(points), "station coordinates out of range")
    require_none(area_rows(city), "boundary area is not positive")
    zones = dims.zones_table(voronoi_zones(points, city))
    require_none(area_rows(zones), "zone area is not positive")
    require_none(orphan_rows(zones, "station_id", points, "station_id"), "zone of an unknown station")
    wh.replace("dim_spatial.chicago_city_boundary", city)
    wh.replace("dim_spatial.weather_stations_points", points)
    wh.replace("dim_spatial.weather_voronoi_zones", zones)
    _stage(wh, landed, start, end, start, end, batch_id, "rebuild", trip_suffix, traffic_limit)
    n = count_gate(wh.read("staging.stg_raw_trips"), "staging.stg_raw_trips")
    _spatial(wh)
    _facts(wh, start, _shift(end, minutes=1))
    refresh_marts(wh)
    return n


def incremental(
    wh: Warehouse,
    landed: Landed,
    start: str,
    end: str,
    batch_id: str,
    trip_suffix: str | None = None,
    traffic_limit: int | None = None,
) -> int:
    """One interval ``[start, end)``: extracts are closed one second before ``end``, weather one day."""
    _stage(
        wh, landed, start, _shift(end, seconds=-1), start, _shift(end, days=-1), batch_id, "incremental", trip_suffix,
        traffic_limit,
    )
    n = count_gate(wh.read("staging.stg_raw_trips"), "staging.stg_raw_trips")
    _spatial(wh)
    _facts(wh, start, end)
    refresh_marts(wh)
    return n


def populate_facts(wh: Warehouse, start: str, end: str) -> None:
    """Run an interval's merge again, for late rows; repeating it changes nothing but audit times."""
    _facts(wh, start, end)


def _shift(text: str, **delta: float) -> str:
    return (datetime.fromisoformat(text) + timedelta(**delta)).isoformat()


def _stage(
    wh: Warehouse, landed: Landed, start: str, end: str, first_day: str, last_day: str, batch_id: str, strategy: str,
    trip_suffix: str | None, traffic_limit: int | None,
) -> None:
    trips = _extract(wh, "trips", batch_id, extracts.extract_trips(landed.trips, start, end, batch_id, trip_suffix))
    traffic = _extract(
        wh, "traffic", batch_id, extracts.extract_traffic(landed.traffic, start, end, batch_id, traffic_limit)
    )
    weather = _extract(wh, "weather", batch_id, extracts.extract_weather(landed.weather, first_day, last_day, batch_id))

    # The stored dimension takes over what a prior extract file would hold, so each batch describes
    # its own locations and regions and the merge decides what changes.
    locations = add_batch_id(dims.location_dimension(None, trips, strategy), batch_id)
    wh.upsert("dim_spatial.trips_locations", locations, mode="coalesce")
    regions = dims.regions_export(dims.region_dimension(None, traffic, strategy), batch_id)
    wh.upsert("dim_spatial.traffic_regions", regions, mode="coalesce")

    wh.append("staging.stg_raw_trips", dims.hash_location_keys(trips))
    wh.append("staging.stg_raw_traffic", traffic.select(*TRAFFIC))
    wh.append("staging.stg_raw_weather", facts.weather_staging(weather))


def _extract(wh: Warehouse, feed: str, batch_id: str, rows: DataFrame) -> DataFrame:
    """The typed extract as a parquet folder of its own: raw text is parsed once per run."""
    folder = f"{wh.root}/extracts/{feed}/{batch_id}"
    landing.write_extract(rows, folder)
    stored = landing.read_extract(wh.spark, folder)
    require_rows(stored, f"{feed} extract")
    return stored


def _spatial(wh: Warehouse) -> None:
    locations = wh.read("dim_spatial.trips_locations")
    boundary = wh.read("dim_spatial.chicago_city_boundary")
    zones = wh.read("dim_spatial.weather_voronoi_zones")
    regions = wh.read("dim_spatial.traffic_regions")
    require_rows(boundary, "city boundary")
    require_rows(zones, "weather zones")
    boundary, zones, regions = dims.in_degrees(boundary, zones, regions)
    wh.replace("dim_spatial.mapped_locations", dims.map_locations(locations, regions, zones))
    wh.replace("dim_spatial.invalid_locations", dims.invalid_locations(locations, boundary))


def _facts(wh: Warehouse, start: str, end: str) -> None:
    def window(table: str) -> DataFrame:
        # The day predicate prunes partitions; the exact window is applied by the plan.
        return wh.read(table).where(f"event_date BETWEEN DATE'{start[:10]}' AND DATE'{end[:10]}'")

    invalid = wh.read("dim_spatial.invalid_locations").select("location_id")
    trips = facts.trip_rows(window("staging.stg_raw_trips"), invalid, start, end)
    traffic = facts.traffic_rows(window("staging.stg_raw_traffic"), start, end)
    weather = facts.weather_rows(window("staging.stg_raw_weather"), start, end)
    # All rows are checked before the first table changes.
    for rows, column, parent, key in (
        (trips, "pickup_location_id", "trips_locations", "location_id"),
        (trips, "dropoff_location_id", "trips_locations", "location_id"),
        (traffic, "region_id", "traffic_regions", "region_id"),
        (weather, "station_id", "weather_stations_points", "station_id"),
    ):
        require_none(orphan_rows(rows.select(column), column, wh.read(f"dim_spatial.{parent}"), key), f"{column} is not in {parent}")
    wh.upsert("fact_tables.fact_trips", extracts.add_created_at(trips))
    wh.upsert("fact_tables.fact_traffic", traffic)
    wh.upsert("fact_tables.fact_weather", weather)


def refresh_marts(wh: Warehouse) -> None:
    """All three marts anew from the facts; traffic, weather and counts are looked up once for two of them."""
    trips, mapped = wh.read("fact_tables.fact_trips"), wh.read("dim_spatial.mapped_locations")
    traffic, weather = wh.read("fact_tables.fact_traffic"), wh.read("fact_tables.fact_weather")
    wide = wh.scratch("described_trips", marts.described_trips(trips, mapped, traffic, weather))
    wh.replace("datamarts.fact_trips_with_traffic_weather", wide.select(*marts.ENRICHED))
    wh.replace("datamarts.dm_trips_hourly_pickup_stats", marts.hourly_pickup(trips))
    wh.replace("datamarts.ml_base_table", marts.features(wide))
