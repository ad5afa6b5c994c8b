"""Counts of rows up to, or within, a time range, without one task ordering a whole table.

The plain forms are ``COUNT(*) OVER (ORDER BY t RANGE ...)``, which sorts everything in one task, and
``... PARTITION BY key ...``, which does so for a hot key. Here rows are first reduced to one row per
instant, then summed on three levels: instants inside slices of time, slices inside wide slices, wide slices. Slices have
fixed limits (about a minute, and about two years), so nothing is counted or read beforehand, and what
one window holds is bounded by time, not by rows: 2^26 instants, 2^20 slices, 2^18 wide slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.instants import after, before, micros
from tripmill.operators.slices import SLICE, with_slice


#: Bits of the microseconds within a slice, and of the slices within a wide slice.
FINE, WIDE = 26, 20


def counts_up_to(
    events: DataFrame, probes: DataFrame | None, by: list[str], cuts: list[float] | None = None
) -> DataFrame:
    """For each distinct probe ``(*by, t)``: the number of events of the same ``by`` at or before ``t``.

    Both frames hold the columns ``by`` (never null) and ``t``. Null instants are left out. Without
    ``probes`` the events ask for themselves. ``cuts`` are limits of slices in seconds, instead of the fixed ones.
    """
    keys = [*by, "t"]
    events = events.select(*keys).where("t IS NOT NULL")
    marked = events.select(*keys, F.lit(1).alias("one"), F.lit(probes is None).alias("asked"))
    if probes is not None:
        asked = probes.select(*keys, F.lit(0).alias("one"), F.lit(True).alias("asked")).where("t IS NOT NULL")
        marked = marked.unionAll(asked)
    points = marked.groupBy(*keys).agg(F.sum("one").alias("n"), F.max("asked").alias("asked"))
    if cuts is None:
        points = points.withColumn(SLICE, F.shiftright(micros(F.col("t")), FINE))
    else:
        points = with_slice(points, F.col("t"), cuts).withColumn(SLICE, F.col(SLICE).cast("bigint"))
    inside = Window.partitionBy(*by, SLICE).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)

    def earlier(*groups: str, order: str) -> Column:
        window = Window.partitionBy(*by, *groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    slices = points.groupBy(*by, SLICE).agg(F.sum("n").alias("n"), F.max("asked").alias("asked"))
    slices = slices.withColumn("_slices", F.shiftright(SLICE, WIDE))
    wide = slices.groupBy(*by, "_slices").agg(F.sum("n").alias("n")).withColumn("_slice_top", F.pmod("_slices", F.lit(1)))
    wide = wide.select(*by, "_slices", earlier("_slice_top", order="_slices").alias("n_before"))
    slices = slices.withColumn("n_earlier", earlier("_slices", order=SLICE)).where("asked").join(wide, [*by, "_slices"])
    slices = slices.select(*by, SLICE, (F.col("n_earlier") + F.col("n_before")).alias("n_earlier"))
    return (
        points.withColumn("n", F.sum("n").over(inside))
        .where("asked")
        .join(slices, [*by, SLICE])
        .select(*keys, (F.col("n") + F.col("n_earlier")).alias("n_le"))
    )


def _lookup(df: DataFrame, counts: DataFrame, by: list[str], t: Column) -> DataFrame:
    """Left join the count columns on ``(*by, t)``; null where ``t`` is null."""
    right = counts.withColumnRenamed("t", "_t")
    return df.withColumn("_t", t).join(right, [*by, "_t"], "left").drop("_t")


def _whole_table_if_null(df: DataFrame, name: str, t: str) -> Column:
    """Null times sort last, so such a row has the whole table in its frame, its peers included."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    return F.when(F.col(t).isNull(), rows).otherwise(F.col(name)).alias(name)


def _started_counts(df: DataFrame, start: str, name: str, cuts: list[float] | None) -> DataFrame:
    points = df.select(F.col(start).alias("t"))
    return counts_up_to(points, None, [], cuts).withColumnRenamed("n_le", name)


def _ended_counts(df: DataFrame, end: str, name: str, cuts: list[float] | None) -> DataFrame:
    """Keyed by the instant one second before an end."""
    ends = df.select(F.col(end).alias("t"))
    return counts_up_to(ends, ends.select(before(F.col("t"), "1").alias("t")), [], cuts).withColumnRenamed("n_le", name)


_BY = ["_by", "_by_null"]


def _with_by(df: DataFrame, by: str) -> DataFrame:
    """The grouping column as two that are never null, so that null is a group like any other."""
    stand_in = F.lit(0).cast(df.schema[by].dataType)
    return df.withColumns({"_by": F.coalesce(F.col(by), stand_in), "_by_null": F.col(by).isNull()})


def _recent_counts(
    df: DataFrame, by: str, start: str, name: str, reach: int, gap: int, cuts: list[float] | None
) -> DataFrame:
    """Per ``(by, start)``: the count up to ``start - gap`` less the count to just before ``start - reach``."""
    gap_s, reach_s = f"{gap}", f"{reach}.000001"
    starts = _with_by(df.select(by, F.col(start).alias("t")), by).select(*_BY, "t")
    probes = starts.select(*_BY, F.explode(F.array(before(F.col("t"), gap_s), before(F.col("t"), reach_s))).alias("t"))
    counts = counts_up_to(starts, probes, _BY, cuts)
    # Both counts go back to the start they were asked for, so that the table is joined only once.
    moved = counts.select(
        *_BY,
        F.explode(
            F.array(
                F.struct(after(F.col("t"), gap_s).alias("t"), F.col("n_le").alias("v")),
                F.struct(after(F.col("t"), reach_s).alias("t"), (-F.col("n_le")).alias("v")),
            )
        ).alias("m"),
    )
    return moved.groupBy(*_BY, F.col("m.t").alias("t")).agg(F.sum("m.v").alias(name))


def started_up_to(df: DataFrame, start: str, name: str, cuts: list[float] | None = None) -> DataFrame:
    """Rows whose start is at or before this row's start, rows with the same start included."""
    out = _lookup(df, _started_counts(df, start, name, cuts), [], F.col(start))
    return out.select(*df.columns, _whole_table_if_null(df, name, start))


def ended_before_end(df: DataFrame, end: str, name: str, cuts: list[float] | None = None) -> DataFrame:
    """Rows that ended at least one second before this row's end."""
    out = _lookup(df, _ended_counts(df, end, name, cuts), [], before(F.col(end), "1"))
    return out.select(*df.columns, _whole_table_if_null(df, name, end))


def active_rows(
    df: DataFrame, start: str, end: str, name: str = "active_trips_total", cuts: list[float] | None = None
) -> DataFrame:
    """Started up to the row's start, less ended before the row's end. May be negative."""
    started = _lookup(df, _started_counts(df, start, "_started", cuts), [], F.col(start))
    both = _lookup(started, _ended_counts(df, end, "_ended", cuts), [], before(F.col(end), "1"))
    return both.select(*df.columns, _active(df, start, end).alias(name))


def _active(df: DataFrame, start: str, end: str) -> Column:
    return _whole_table_if_null(df, "_started", start) - _whole_table_if_null(df, "_ended", end)


def recent_rows(
    df: DataFrame,
    by: str,
    start: str,
    name: str,
    reach: int = 1800,
    gap: int = 1,
    cuts: list[float] | None = None,
) -> DataFrame:
    """Rows of the same ``by`` that started ``gap`` to ``reach`` seconds earlier, both ends included.

    Rows without a start are not counted and get 0; a null ``by`` is a group of its own.
    """
    found = _lookup(_with_by(df, by), _recent_counts(df, by, start, name, reach, gap, cuts), _BY, F.col(start))
    return found.select(*df.columns, F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name))


def active_and_recent_rows(
    df: DataFrame, start: str, end: str, by: str, active: str, recent: str, cuts: list[float] | None = None
) -> DataFrame:
    """:func:`active_rows` and :func:`recent_rows` together, with one join of ``df`` less.

    Both counts that hang on the start are first brought together per ``(by, start)``.
    """
    per_start = _recent_counts(df, by, start, recent, 1800, 1, cuts).join(
        _started_counts(df, start, "_started", cuts), "t"
    )
    found = _lookup(_with_by(df, by), per_start, _BY, F.col(start))
    found = _lookup(found, _ended_counts(df, end, "_ended", cuts), [], before(F.col(end), "1"))
    return found.select(
        *df.columns,
        _active(df, start, end).alias(active),
        F.coalesce(F.col(recent), F.lit(0).cast("bigint")).alias(recent),
    )
