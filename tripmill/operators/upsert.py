"""Keyed upsert of a batch into a table, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(
    target: DataFrame, source: DataFrame, key: str, update: list[str], mode: str = "replace"
) -> DataFrame:
    """``target`` after ``source`` is merged into it on ``key``.

    A matched row takes the ``update`` columns from the source (``coalesce`` mode: only where the
    source is not null) and keeps its other columns. Unmatched source rows are inserted whole.
    Columns follow ``target``; the source must be unique on ``key``.

    Only the source can be the broadcast side of each join, so a small batch never shuffles the
    target.
    """
    new = source.select(key, *[F.col(c).alias(f"_new_{c}") for c in update], F.lit(True).alias("_hit"))
    joined = target.join(new, key, "left")

    def merged(name: str):
        if name not in update:
            return F.col(name)
        incoming = F.col(f"_new_{name}")
        if mode == "coalesce":
            return F.coalesce(incoming, F.col(name)).alias(name)
        return F.when(F.col("_hit"), incoming).otherwise(F.col(name)).alias(name)

    kept = joined.select(*[merged(c) for c in target.columns])
    present = target.select(key).join(source.select(key), key, "left_semi")
    fresh = source.join(present, key, "left_anti").select(*target.columns)
    return kept.unionByName(fresh)
