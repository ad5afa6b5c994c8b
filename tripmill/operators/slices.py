"""Cutting time into slices that hold about the same number of rows each.

Ordered work (running counts, last-seen values) is done inside ``(key, slice)`` groups and carried
from slice to slice by a small summary. The cuts follow the number of rows, so a group stays a small
share of all rows even when one key, one day or one hour holds a third of them.
"""

from __future__ import annotations


from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.instants import seconds
from tripmill.session import stored

SLICE = "_slice"


#: A slice has about this many rows.
SLICE_ROWS = 200_000
#: Parts that a range of time is counted in at once, and the width that is not parted further.
PARTS, LEAST_WIDTH = 256, 1e-6


def time_cuts(frames: list[tuple[DataFrame, Column]], rows: int | None = None) -> list[float]:
    """Limits of slices with about ``rows`` rows each, over all frames together.

    Rows are counted by equal parts of the whole range, which map tasks combine, and parts with too
    many rows are counted again by finer parts. A range of equal instants stays whole. What reaches the
    driver is a number per part: parts are refined only where they hold more than a slice, so there are
    at most PARTS times as many as slices.
    """
    columns = [df.select(seconds(ts).alias("s")).where("s IS NOT NULL") for df, ts in frames]
    every = columns[0]
    for more in columns[1:]:
        every = every.unionAll(more)
    span = every.agg(F.min("s").alias("low"), F.max("s").alias("high"), F.count("*").alias("n")).first()
    most = rows or SLICE_ROWS
    if span["n"] <= most or span["low"] == span["high"]:
        return []
    spark, done = every.sparkSession, {}
    width, crowded = (span["high"] - span["low"]) / PARTS, [span["low"]]
    counted = every.withColumn("start", F.lit(span["low"]))
    while crowded:
        part = F.least(F.floor((F.col("s") - F.col("start")) / width), F.lit(PARTS - 1))
        parts = counted.groupBy((F.col("start") + part * width).alias("start")).count().collect()
        crowded = [r["start"] for r in parts if r["count"] > most and width > LEAST_WIDTH]
        done |= {r["start"]: r["count"] for r in parts if r["start"] not in set(crowded)}
        if crowded:
            # Only the rows of crowded parts are counted again.
            starts = spark.createDataFrame([(x,) for x in crowded], "start double")
            counted = counted.select("s", (F.col("start") + part * width).alias("start")).join(F.broadcast(starts), "start")
            width /= PARTS
    cuts, held = [], 0
    for start in sorted(done):
        if held and held + done[start] > most:
            cuts.append(start)
            held = 0
        held += done[start]
    return cuts


def with_slice(df: DataFrame, ts: Column, cuts: list[float]) -> DataFrame:
    """Add the slice number of ``ts`` (not null). It never falls as ``ts`` grows."""
    if not cuts:
        return df.withColumn(SLICE, F.lit(0.0))
    splits = [float("-inf"), *cuts, float("inf")]
    keyed = df.withColumn("_seconds", seconds(ts))
    return Bucketizer(splits=splits, inputCol="_seconds", outputCol=SLICE).transform(keyed).drop("_seconds")


def numbered(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows numbered from 1 in the order of ``key``, which is unique: numbered inside ranges, each after the rows of those before it.

    The number of rows of each range reaches the driver; there are as many ranges as shuffle partitions.
    """
    ranged = stored(df.repartitionByRange(key).withColumn("_range", F.spark_partition_id()), "ranges")
    offsets, before = [], 0
    for r in sorted(ranged.groupBy("_range").count().collect()):
        offsets.append((r["_range"], before))
        before += r["count"]
    after = df.sparkSession.createDataFrame(offsets, "_range int, _before long")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return ranged.withColumn(name, inside).join(F.broadcast(after), "_range").withColumn(name, F.col("_before") + F.col(name)).drop("_range", "_before")
