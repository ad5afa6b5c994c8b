"""Integrity checks. The ``*_rows`` functions return the offending rows; ``require_*`` raise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class CheckFailed(ValueError):
    """A load or a table breaks a rule it must keep."""


def duplicate_key_rows(df: DataFrame, *key: str) -> DataFrame:
    """Keys held by more than one row, with the number of rows. Null keys break a key as well."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    any_null = F.lit(False)
    for c in key:
        any_null = any_null | F.col(c).isNull()
    return counted.where((F.col("n_rows") > 1) | any_null)


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose non-null ``column`` is not a key of ``parent``."""
    keys = parent.select(F.col(parent_key).alias(column))
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def station_range_rows(stations: DataFrame) -> DataFrame:
    return stations.where(~(F.col("longitude").between(-180, 180) & F.col("latitude").between(-90, 90)))


def area_rows(table: DataFrame) -> DataFrame:
    """Rows with an area that is not positive; an unknown area passes."""
    return table.where(F.col("area_km2") <= 0)


def crs_rows(table: DataFrame, crs: str) -> DataFrame:
    return table.where(~F.col("crs").eqNullSafe(F.lit(crs)))


def require_none(bad: DataFrame, message: str) -> None:
    example = bad.limit(3).collect()
    if example:
        raise CheckFailed(f"{message}, for example {[r.asDict() for r in example]}")


def require_unique(df: DataFrame, *key: str, name: str = "table") -> None:
    require_none(duplicate_key_rows(df, *key), f"{name}: {', '.join(key)} is not a key")


def require_rows(df: DataFrame, name: str) -> None:
    if df.isEmpty():
        raise CheckFailed(f"{name} has no rows")


def count_gate(df: DataFrame, name: str) -> int:
    """The row count; raises when it is zero."""
    n = df.count()
    if n == 0:
        raise CheckFailed(f"{name} has no rows")
    return n
