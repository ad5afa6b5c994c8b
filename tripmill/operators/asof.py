"""Nearest-in-time join: to each left row, the one right row of its key with the least time distance.

Either direction, no tolerance. Equal distances go to the earlier reading, then to the smallest
``order`` column. Left rows without a key, a time or any reading of their key keep nulls.

Distinct left instants and readings are put in order inside ``(key, slice)`` groups, and the last
reading before and first reading after each slice are carried into it. There is one plan for tables of
any size; which side of a join is sent to all tasks is left to Spark's measured sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.instants import distance
from tripmill.operators.slices import SLICE, time_cuts, with_slice
from tripmill.session import stored


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    order: str,
    payload: dict[str, str],
    cuts: list[float] | None = None,
) -> DataFrame:
    """``left`` plus the ``payload`` columns (right name -> output name) of the nearest reading.

    ``cuts`` are the slices' limits in seconds; any give the same rows.
    """
    readings = _one_per_instant(right, key, right_time, order, list(payload))
    found = _by_slices(left, readings, key, left_time, cuts)
    out = [F.col("_best")["row"][src].alias(name) for src, name in payload.items()]
    return found.select(*[F.col(c) for c in left.columns], *out)


def _one_per_instant(right: DataFrame, key: str, time: str, order: str, payload: list[str]) -> DataFrame:
    """Columns ``_k, _rt, _row``; of several readings at one instant the smallest ``order`` stays."""
    row = F.struct(F.col(order).alias("_order"), *[F.col(c) for c in payload])
    return (
        right.where(F.col(key).isNotNull() & F.col(time).isNotNull())
        .select(F.col(key).alias("_k"), F.col(time).alias("_rt"), row.alias("_row"))
        .groupBy("_k", "_rt")
        .agg(F.min("_row").alias("_row"))
    )


def _nearer(t: Column, back: Column, ahead: Column) -> Column:
    """The better of two ``(rt, row)`` structs, of which ``back`` is not later than ``t`` and ``ahead`` not earlier."""
    return F.when(back.isNull() | (distance(t, ahead["rt"]) < distance(t, back["rt"])), ahead).otherwise(back)


def _reading() -> Column:
    return F.struct(F.col("_rt").alias("rt"), F.col("_row").alias("row"))


def _by_slices(
    left: DataFrame, readings: DataFrame, key: str, left_time: str, cuts: list[float] | None
) -> DataFrame:
    asked = (
        left.where(F.col(key).isNotNull() & F.col(left_time).isNotNull())
        .select(F.col(key).alias("_k"), F.col(left_time).alias("_t"))
        .distinct()
    )
    reading = _reading()
    nothing = F.lit(None).cast(readings.select(reading.alias("r")).schema["r"].dataType)
    points = readings.select("_k", F.col("_rt").alias("_t"), reading.alias("r"), F.lit(0).alias("asked")).unionAll(
        asked.select("_k", "_t", nothing.alias("r"), F.lit(1).alias("asked"))
    )
    # Read by the cuts, the order and the ends: what both tables come from is not computed again for each.
    points = stored(points, "asof-points")
    points = with_slice(points, F.col("_t"), time_cuts([(points, F.col("_t"))]) if cuts is None else cuts)
    group = Window.partitionBy("_k", SLICE)
    # A reading sorts before a probe of the same instant in both directions. The backward look is a
    # descending order: a frame that ends at the last row would be re-read for every row.
    up = group.orderBy("_t", "asked").rowsBetween(Window.unboundedPreceding, 0)
    down = group.orderBy(F.desc("_t"), "asked").rowsBetween(Window.unboundedPreceding, 0)
    near = points.select(
        "_k",
        SLICE,
        "_t",
        "asked",
        F.last("r", ignorenulls=True).over(up).alias("back"),
        F.last("r", ignorenulls=True).over(down).alias("ahead"),
    ).where("asked = 1")

    ends = points.groupBy("_k", SLICE).agg(F.min("r").alias("first"), F.max("r").alias("last"))
    slices_up = Window.partitionBy("_k").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    slices_down = Window.partitionBy("_k").orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "_k",
        SLICE,
        F.last("last", ignorenulls=True).over(slices_up).alias("carry_back"),
        F.last("first", ignorenulls=True).over(slices_down).alias("carry_ahead"),
    )
    best = near.join(carried, ["_k", SLICE]).select(
        "_k",
        "_t",
        _nearer(F.col("_t"), F.coalesce("back", "carry_back"), F.coalesce("ahead", "carry_ahead")).alias("_best"),
    )
    return left.join(best, (left[key] == best["_k"]) & (left[left_time] == best["_t"]), "left")
