from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tripmill.catalogue import entries
from tripmill.operators.checks import CheckFailed
from tripmill.plans import dims, extracts, jobs
from tripmill.session import new_folder, shared_folder
from tripmill.sources import landing
from tripmill.sources.warehouse import Warehouse

DAY = dt.datetime(2024, 1, 1)


@pytest.fixture
def wh(spark):
    folder = new_folder(spark, "test")
    house = Warehouse(spark, folder, prefix=f"t{folder[-8:]}_")
    house.create()
    yield house
    house.drop()


def test_records_as_array_lines_and_error_body(spark, tmp_path):
    records = [
        {"trip_id": "a", "fare": "1.5", "pickup_centroid_location": {"type": "Point", "coordinates": [-87.6, 41.8]}, "other": 1},
        {"trip_id": "b", "shared_trip_authorized": True},
    ]
    (tmp_path / "array").mkdir(), (tmp_path / "lines").mkdir(), (tmp_path / "error").mkdir()
    (tmp_path / "array" / "r.json").write_text(json.dumps(records))
    (tmp_path / "lines" / "r.json").write_text("\n".join(json.dumps(r) for r in records))
    (tmp_path / "error" / "r.json").write_text(json.dumps({"message": "no"}))
    a = landing.read_records(spark, str(tmp_path / "array"), landing.TRIP_FIELDS, whole_files=True)
    b = landing.read_records(spark, str(tmp_path / "lines"), landing.TRIP_FIELDS)
    assert a.columns == landing.TRIP_FIELDS and set(dict(a.dtypes).values()) == {"string"}
    for df in (a, b):
        first, second = df.orderBy("trip_id").collect()
        assert first.fare == "1.5" and second.shared_trip_authorized == "true" and second.fare is None
        assert json.loads(first.pickup_centroid_location) == records[0]["pickup_centroid_location"]
    assert landing.read_records(spark, str(tmp_path / "error"), landing.TRIP_FIELDS, whole_files=True).isEmpty()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        landing.read_extract(spark, str(tmp_path / "gone"))


def test_weather_payload_shapes(spark, tmp_path):
    day = {"datetime": "2025-09-01", "temp": 22.5, "feelslike": 21, "precipprob": 0, "windspeed": 12.3, "winddir": 180, "conditions": "Clear"}
    for station, payload in (("A", {"days": [day, {**day, "datetime": "2025-09-02"}]}), ("B", [day]), ("C", {"error": "x"})):
        (tmp_path / f"station_id={station}").mkdir()
        (tmp_path / f"station_id={station}" / "r.json").write_text(json.dumps(payload))
    df = landing.read_weather(spark, str(tmp_path), whole_files=True)
    assert tuples(df, "record_id", "station_id", "temp") == [
        ("A_2025-09-01", "A", "22.5"), ("A_2025-09-02", "A", "22.5"), ("B_2025-09-01", "B", "22.5")
    ]


def traffic(spark, rows):
    return spark.createDataFrame(rows, "record_id string, time timestamp_ntz, region_id int, speed double")


def test_append_matches_columns_and_refuses_keys(spark, wh):
    table = "staging.stg_raw_traffic"
    wh.append(table, traffic(spark, [("a", DAY, 1, 1.0), ("n", None, 1, 1.0)]).withColumn("extra", F.lit(1)))
    row = wh.read(table).where("record_id = 'a'").first()
    assert row.bus_count is None and row.created_at is not None and row.event_date == DAY.date()
    for bad in ([("a", DAY, 2, 2.0)], [("b", DAY, 1, 1.0), ("b", DAY, 2, 2.0)], [(None, DAY, 1, 1.0)]):
        with pytest.raises(CheckFailed):
            wh.append(table, traffic(spark, bad))
    wh.append(table, traffic(spark, [("b", DAY, 2, 2.0)]))
    assert tuples(wh.read(table), "record_id", "speed") == [("a", 1.0), ("b", 2.0), ("n", 1.0)]


def test_replace_reads_its_own_table_and_checks_the_key(spark, wh):
    table = "dim_spatial.mapped_locations"
    rows = spark.createDataFrame([("x", 1, "S", "b"), ("y", 2, "S", "b")], "location_id string, region_id int, station_id string, batch_id string")
    wh.replace(table, rows)
    wh.replace(table, wh.read(table).where("region_id = 2"))
    assert tuples(wh.read(table), "location_id") == [("y",)]
    with pytest.raises(CheckFailed):
        wh.replace(table, rows.unionAll(rows))
    assert tuples(wh.read(table), "location_id") == [("y",)]  # the failed load changed nothing
    with pytest.raises(ValueError):
        wh.replace("fact_tables.fact_trips", rows)


def trip(spark, rows):
    return spark.createDataFrame(rows, "trip_id string, trip_start_timestamp timestamp_ntz, fare double, pickup_community_area int")


def test_upsert_by_day_moves_rows_and_drops_empty_days(spark, wh):
    table, d = "fact_tables.fact_trips", dt.timedelta(days=1)
    wh.upsert(table, trip(spark, [("a", DAY, 1.0, 1), ("b", DAY + d, 2.0, 2), ("c", DAY + 2 * d, 3.0, 3), ("z", None, 9.0, 9)]))
    untouched = [r[0] for r in wh.read(table).where("trip_id = 'c'").select(F.input_file_name()).collect()]
    wh.upsert(table, trip(spark, [("a", DAY + d, 10.0, 99), ("new", DAY + 5 * d, 5.0, 5)]))
    got = tuples(wh.read(table), "trip_id", "event_date", "fare", "pickup_community_area")
    assert got == sorted(
        [
            ("a", (DAY + d).date(), 10.0, 1), ("b", (DAY + d).date(), 2.0, 2), ("c", (DAY + 2 * d).date(), 3.0, 3),
            ("new", (DAY + 5 * d).date(), 5.0, 5), ("z", None, 9.0, 9),
        ],
        key=repr,
    )
    assert [r[0] for r in wh.read(table).where("trip_id = 'c'").select(F.input_file_name()).collect()] == untouched
    days = {r[0] for r in spark.sql(f"SHOW PARTITIONS {wh.name(table)}").collect()}
    assert "event_date=2024-01-01" not in days and len(days) == 4
    wh.upsert(table, trip(spark, [("z", DAY, 1.0, 1)]))  # from no day to a day
    assert tuples(wh.read(table).where("trip_id = 'z'"), "event_date", "pickup_community_area") == [(DAY.date(), 9)]
    with pytest.raises(CheckFailed):
        wh.upsert(table, trip(spark, [("q", DAY, 1.0, 1), ("q", DAY, 2.0, 1)]))


def test_a_merge_that_stops_half_way_is_finished_on_opening(spark, wh, monkeypatch):
    table, d = "fact_tables.fact_trips", dt.timedelta(days=1)
    wh.upsert(table, trip(spark, [("m1", DAY, 1.0, 1), ("m2", DAY + d, 2.0, 2), ("m3", DAY + 2 * d, 3.0, 3)]))
    wh.create(table)  # nothing to finish
    whole, switched = wh.read(table).count(), []
    plain = Warehouse._switch_days

    def stops(self, table, switches):
        plain(self, table, switches[:1])
        switched.extend(switches)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(Warehouse, "_switch_days", stops)
    with pytest.raises(RuntimeError):
        wh.upsert(table, trip(spark, [("m1", DAY + 2 * d, 10.0, 1), ("m3", DAY, 30.0, 3)]))
    assert len(switched) == 2
    monkeypatch.setattr(Warehouse, "_switch_days", plain)
    again = Warehouse(spark, wh.root, wh.prefix)
    again.create(table)
    rows = {r["trip_id"]: (r["event_date"], r["fare"]) for r in again.read(table).where("trip_id LIKE 'm%'").collect()}
    assert rows == {"m1": ((DAY + 2 * d).date(), 10.0), "m2": ((DAY + d).date(), 2.0), "m3": (DAY.date(), 30.0)}
    assert again.read(table).count() == whole


def test_an_extract_reads_its_days_only(spark, sf):
    folder = new_folder(spark, "by-day")
    landing.land_by_day(entries.td.raw_trips(spark, sf), "trip_start_timestamp", folder)
    raw = landing.read_records(spark, folder, landing.TRIP_FIELDS)
    assert raw.count() == spark.read.parquet(f"{sf}/events.parquet").count()
    one = extracts.extract_trips(raw, "2024-01-03T00:00:00", "2024-01-03T23:59:59", "b")
    days = {f.split("landed_day=")[1][:10] for f in one.inputFiles()}
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(landed_day" in text and len(days) > 20
    files = [r[0] for r in raw.where("landed_day = DATE'2024-01-03'").select(F.input_file_name()).distinct().collect()]
    assert files and all("landed_day=2024-01-03" in f for f in files)
    flat = extracts.extract_trips(entries.td.raw_trips(spark, sf), "2024-01-03T00:00:00", "2024-01-03T23:59:59", "b")
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, flat.collect()), key=repr)


def test_an_unknown_region_fails_the_load(spark, wh, monkeypatch):
    with pytest.raises(CheckFailed, match="region_id is not in traffic_regions"):
        wh.create()
        wh.append("staging.stg_raw_traffic", traffic(spark, [("unknown-region", DAY, 4711, 1.0)]))
        jobs._facts(wh, DAY.date().isoformat() + "T00:00:00", (DAY + dt.timedelta(days=1)).date().isoformat() + "T00:00:00")


def test_traffic_upsert_keeps_time(spark, wh):
    table = "fact_tables.fact_traffic"
    wh.upsert(table, traffic(spark, [("a", DAY, 1, 1.0)]))
    wh.upsert(table, traffic(spark, [("a", DAY + dt.timedelta(days=3), 7, 5.0)]))
    assert tuples(wh.read(table), "time", "region_id", "speed", "event_date") == [(DAY, 1, 5.0, DAY.date())]


def test_shared_folder_comes_from_the_session(spark):
    assert spark.conf.get("spark.checkpoint.dir") == shared_folder(spark)
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_runs_and_repeats(spark, sf):
    """Cold start, one day more, and the same merge once again: only audit times differ."""
    folder = new_folder(spark, "runs")
    house = Warehouse(spark, folder, prefix=f"r{folder[-8:]}_")
    landed = entries._landed(spark, sf)
    boundary = entries.td.city_polygons(spark)
    options = dict(trip_suffix=None, traffic_limit=None)
    n = jobs.coldstart(
        house, landed, dims.default_stations(spark), boundary, "2024-01-01T00:00:00", "2024-01-02T23:59:00", "cold", **options
    )
    assert n == house.read("staging.stg_raw_trips").count() > 0
    before = house.read("fact_tables.fact_trips").count()
    m = jobs.incremental(house, landed, "2024-01-03T00:00:00", "2024-01-04T00:00:00", "day3", **options)
    assert m > n and house.read("fact_tables.fact_trips").count() > before

    def content(table):
        return tuples(house.read(table).drop("created_at"))

    tables = ("fact_tables.fact_trips", "fact_tables.fact_traffic", "fact_tables.fact_weather")
    first = {t: content(t) for t in tables}
    jobs.populate_facts(house, "2024-01-03T00:00:00", "2024-01-04T00:00:00")
    assert {t: content(t) for t in tables} == first
    assert house.read("datamarts.ml_base_table").count() == house.read("fact_tables.fact_trips").count()
    with pytest.raises(CheckFailed):  # the same day may not be staged twice
        jobs.incremental(house, landed, "2024-01-03T00:00:00", "2024-01-04T00:00:00", "day3-again", **options)
    house.drop()
