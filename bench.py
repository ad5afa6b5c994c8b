"""Headline queries at one scale; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Dimensions and facts are built
first (timed as ``build_*``), as they are tables in practice. Each query is run twice to its last row into
a sink that drops the rows: ``queries`` has the first runs, ``warm`` the second ones. The value is the sum
of the builds and the first runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripmill.catalogue import testdata as td  # noqa: E402
from tripmill.catalogue.entries import QUERIES  # noqa: E402
from tripmill.session import local_session  # noqa: E402

HEADLINE = [
    "mart_hourly_pickup",
    "mart_trips_enriched",
    "mart_ml_base",
    "mart_ml_base_from_enriched",
    "asof_nearest_traffic",
    "asof_nearest_traffic_sliced",
    "asof_nearest_weather",
    "asof_nearest_event",
    "win_active_trips",
    "win_recent_pickups_30m",
    "win_recent_events_by_type",
    "join_anti_invalid",
    "upsert_fact_trips",
    "upsert_fact_traffic",
    "dim_locations_build",
    "map_location_keys",
    "map_locations",
    "spanti_city_boundary",
    "nearest_site",
    "proj_trip_columns",
    "src_json_records",
    "topk_earliest_traffic",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, partitions=cpus)
    times: dict[str, float] = {}
    for name in td.BUILDERS:
        t = time.perf_counter()
        td.stored(spark, sf, name)
        times[f"build_{name}"] = round(time.perf_counter() - t, 3)
    warm: dict[str, float] = {}
    for name in HEADLINE:
        for kept in (times, warm):
            t = time.perf_counter()
            run(QUERIES[name](spark, sf))
            kept[name] = round(time.perf_counter() - t, 3)
    total = round(sum(times.values()), 3)
    out = {"metric": "builds and headline queries, first runs", "value": total, "unit": "sec", "queries": times, "warm": warm}
    print(json.dumps(out | {"warm_total": round(sum(warm.values()), 3), "sf": sf.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
