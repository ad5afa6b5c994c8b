from __future__ import annotations

import datetime as dt
import random

import pytest

from tripmill.operators import slices
from tripmill.operators.asof import asof_nearest

T0 = dt.datetime(2024, 1, 1, 12)


def at(seconds, micros=0):
    return T0 + dt.timedelta(seconds=seconds, microseconds=micros)


def run(spark, probes, readings, **options):
    left = spark.createDataFrame(probes, "id int, k string, t timestamp_ntz")
    right = spark.createDataFrame(readings, "rec string, k string, t timestamp_ntz, v double")
    found = asof_nearest(left, right, "k", "t", "t", "rec", {"rec": "near", "v": "value"}, **options)
    assert found.columns == ["id", "k", "t", "near", "value"]
    return {r["id"]: r["near"] for r in found.collect()}


def brute(probes, readings):
    out = {}
    for i, k, t in probes:
        mine = [r for r in readings if r[1] is not None and r[1] == k and r[2] is not None]
        out[i] = min(mine, key=lambda r: (abs(r[2] - t), r[2], r[0]))[0] if mine and t is not None else None
    return out


CUTS = [T0.replace(tzinfo=dt.UTC).timestamp() + s for s in (10, 120, 160, 900)]


@pytest.mark.parametrize("cuts", [None, CUTS])
def test_edges(spark, cuts):
    readings = [
        ("r10", "a", at(0), 1.0), ("r1", "a", at(100), 2.0), ("r0", "a", at(100), 3.0), ("r2", "a", at(200), 4.0),
        ("r9", "b", at(50), 5.0), ("r3", None, at(1), 6.0), ("r4", "a", None, 7.0),
    ]
    probes = [
        (0, "a", at(100)),  # hit, two readings at the instant
        (1, "a", at(150)),  # equally far: the earlier one
        (2, "a", at(150, 1)),
        (3, "a", at(149, 999999)),
        (4, "a", at(-5000)), (5, "a", at(5000)),  # before and after all
        (6, "b", at(10**7)),  # no tolerance
        (7, "c", at(0)), (8, None, at(0)), (9, "a", None),
    ]
    got = run(spark, probes, readings, cuts=cuts)
    assert got == {0: "r0", 1: "r0", 2: "r2", 3: "r0", 4: "r10", 5: "r2", 6: "r9", 7: None, 8: None, 9: None}


@pytest.mark.parametrize("rows", [30, slices.SLICE_ROWS])
def test_skewed_random_against_brute_force(spark, monkeypatch, rows):
    """One key holds most rows, one instant a third of the probes, and readings come in bursts."""
    monkeypatch.setattr(slices, "SLICE_ROWS", rows)
    rng = random.Random(11)

    def when():
        return at(rng.choice([rng.randrange(0, 50), rng.randrange(0, 100_000)]), rng.randrange(0, 3))

    readings = [(f"r{i}", rng.choice("aaaaab"), when(), float(i)) for i in range(400)]
    probes = [(i, rng.choice("aaaaabc"), at(25) if i % 3 == 0 else when()) for i in range(900)]
    assert run(spark, probes, readings) == brute(probes, readings)


@pytest.mark.parametrize("n", [2, 3, 40])
def test_bursts_of_microseconds(spark, n):
    """Readings that span fewer microseconds than there are readings, asked long before and after."""
    readings = [(f"r{i}", "a", at(0, i % 3), 0.0) for i in range(n)]
    probes = [(0, "a", at(100)), (1, "a", at(-100)), (2, "a", at(0, 1)), (3, "a", at(0, 7))]
    assert run(spark, probes, readings) == brute(probes, readings)


def test_no_readings(spark):
    assert run(spark, [(0, "a", at(0))], [("r", "zz", at(0), 1.0)]) == {0: None}


def test_cuts_follow_the_rows(spark):
    """A third of the rows within one second of a year: its slices are cut as finely as its rows need."""
    times = [(at(i * 30_000),) for i in range(1000)] + [(at(77, i * 2000),) for i in range(500)] + [(at(5),)] * 300
    df = spark.createDataFrame(times, "t timestamp_ntz")
    cuts = slices.time_cuts([(df, df["t"])], rows=50)
    held = slices.with_slice(df, df["t"], cuts).groupBy(slices.SLICE, "t").count().groupBy(slices.SLICE).agg({"count": "max", "*": "count"}).collect()
    assert cuts == sorted(set(cuts)) and len(cuts) > 20
    assert all(r["count(1)"] <= 50 for r in held)
    assert slices.time_cuts([(df.limit(0), df["t"])]) == []


def test_tables_are_computed_twice_at_most(spark, monkeypatch):
    """Once for the points of both tables, from which slices, order and ends come, and once for the rows that are answered."""
    monkeypatch.setattr(slices, "SLICE_ROWS", 50)
    passed = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    probes = [(i, "k", at(i * 7 % 400)) for i in range(400)]
    left = spark.createDataFrame(probes, "id int, k string, t timestamp_ntz").mapInArrow(seen, "id int, k string, t timestamp_ntz")
    right = spark.createDataFrame([(f"r{i}", "k", at(i * 3)) for i in range(100)], "rec string, k string, t timestamp_ntz")
    found = asof_nearest(left, right, "k", "t", "t", "rec", {"rec": "near"})
    assert found.count() == 400 and len(found.select("near").collect()) == 400
    assert passed.value <= 3 * 400  # found is run twice here
