from __future__ import annotations

import datetime as dt
import random

import pytest

from tripmill.operators import counts

T0 = dt.datetime(2024, 1, 1, 12)


def at(seconds, micros=0):
    return T0 + dt.timedelta(seconds=seconds, microseconds=micros)


def trips(spark, rows):
    return spark.createDataFrame(rows, "id int, loc string, s timestamp_ntz, e timestamp_ntz")


def brute(rows):
    """started, ended, recent per row, straight from the frame definitions; nulls sort last."""
    out = {}
    for i, loc, s, e in rows:
        started = sum(1 for r in rows if s is None or (r[2] is not None and r[2] <= s))
        ended = len(rows) if e is None else sum(1 for r in rows if r[3] is not None and r[3] <= e - dt.timedelta(seconds=1))
        recent = 0
        if s is not None:
            lo, hi = s - dt.timedelta(minutes=30), s - dt.timedelta(seconds=1)
            recent = sum(1 for r in rows if r[1] == loc and r[2] is not None and lo <= r[2] <= hi)
        out[i] = (started, ended, recent)
    return out


def run(df, cuts=None):
    a = counts.started_up_to(df, "s", "a", cuts)
    b = counts.ended_before_end(a, "e", "b", cuts)
    c = counts.recent_rows(b, "loc", "s", "c", cuts=cuts)
    assert c.columns[:4] == ["id", "loc", "s", "e"] or set(c.columns) == {"id", "loc", "s", "e", "a", "b", "c"}
    return {r["id"]: (r["a"], r["b"], r["c"]) for r in c.collect()}


def test_frame_edges(spark):
    rows = [
        (0, "x", at(0), at(10)),
        (1, "x", at(0), at(10)),  # same instant: not recent
        (2, "x", at(1), at(11)),  # exactly 1 s later
        (3, "x", at(0, 999999), at(5000)),  # less than 1 s later
        (4, "x", at(1800), None),  # exactly 30 min later, no end
        (5, "x", at(1800, 1), at(1900)),  # 30 min and 1 µs later
        (6, "y", at(900), at(901)),
        (7, None, at(900), at(902)),
        (8, None, at(901), None),
    ]
    got = run(trips(spark, rows))
    assert got == brute(rows)
    assert (got[1][2], got[2][2], got[3][2], got[4][2], got[5][2]) == (0, 2, 0, 4, 2)
    assert got[4][1] == len(rows)


def test_active_can_be_negative(spark):
    rows = [(0, "x", at(0), at(1000))] + [(i, "x", at(10 + i), at(20 + i)) for i in range(1, 20)]
    df = counts.active_rows(trips(spark, rows), "s", "e")
    by_id = {r["id"]: r["active_trips_total"] for r in df.collect()}
    want = {i: s - e for i, (s, e, _) in brute(rows).items()}
    assert by_id == want and min(by_id.values()) < 0


@pytest.mark.parametrize("spread", [40, 100_000])
def test_random_with_a_hot_key_and_instant(spark, spread):
    rng = random.Random(spread)
    rows = []
    for i in range(700):
        s = at(25) if i % 3 == 0 else at(rng.randrange(0, spread), rng.randrange(0, 2))
        e = None if i % 31 == 0 else s + dt.timedelta(seconds=rng.randrange(0, 4000))
        rows.append((i, rng.choice(["hot", "hot", "a", "b", None]), s, e))
    assert run(trips(spark, rows)) == brute(rows)


def test_cuts_do_not_change_the_result(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), at(rng.randrange(0, 9000)), at(rng.randrange(0, 9000))) for i in range(200)]
    base = T0.replace(tzinfo=dt.UTC).timestamp()
    for cuts in ([], [base + 10.0], [base + float(k) for k in range(0, 9000, 300)]):
        assert run(trips(spark, rows), cuts) == brute(rows)


def test_no_task_orders_all_rows(spark):
    """Windows run inside slices, over one row per slice, and over one row per wide slice."""
    df = trips(spark, [(0, "x", at(0), at(1))])
    plan = counts.started_up_to(df, "s", "n")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert len(windows) == 3 and all("windowspecdefinition(_slice" in line for line in windows)


def test_slices_and_wide_slices(spark):
    """Instants in one slice, in many, over centuries and before 1970; a third of the rows in one second."""
    rng = random.Random(7)
    hot = dt.datetime(2024, 5, 1, 12)
    starts = [hot + dt.timedelta(microseconds=rng.randrange(10**6)) for _ in range(150)]
    starts += [hot + dt.timedelta(seconds=rng.randrange(-300, 300)) for _ in range(150)]
    starts += [dt.datetime(1700, 1, 1) + dt.timedelta(days=rng.randrange(150_000), microseconds=rng.randrange(10**9)) for _ in range(150)]
    df = trips(spark, [(i, rng.choice("xy"), s, s) for i, s in enumerate(starts)])
    got = {r[0]: r["n"] for r in counts.started_up_to(df, "s", "n").collect()}
    assert got == {i: sum(o <= s for o in starts) for i, s in enumerate(starts)}
    ended = {r[0]: r["n"] for r in counts.ended_before_end(df, "e", "n").collect()}
    assert ended == {i: sum(o <= s - dt.timedelta(seconds=1) for o in starts) for i, s in enumerate(starts)}
