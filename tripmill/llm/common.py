"""Word pattern, scratch tables and joins shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import new_folder

#: The white space of the contracts, as a character class of Java and RE2 patterns.
SPACE = r"\x20\x09-\x0D"
#: At most this many rows of hot keys are sent to every task: see ``join_groups``.
HOT_KEYS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back, so that lost executors cost one stage, not all."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Rows no model learns from: crc32 of the id's text has remainder 1 by 3. Null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of rows with one row per key, where a few keys may hold most of the rows.

    A key with over 1/HOT_KEYS of all rows is hot. There are fewer than HOT_KEYS of those whatever
    the data, so they are sent to every task and their rows are not shuffled; all others are joined
    by key. ``size`` is the column of ``groups`` with the key's number of rows. No key may be null.
    """
    total = groups.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    least = max(total // HOT_KEYS, 10_000)
    hot = groups.where(F.col(size) > least)
    names = hot.select(F.col(key).alias("_hot"))
    cold_rows = rows.join(F.broadcast(names), F.col(key) == F.col("_hot"), "left_anti")
    cold = cold_rows.join(groups.where(F.col(size) <= least), key)
    return cold.unionByName(rows.join(F.broadcast(hot), key))


def per_text(fn: Callable[[str | None], tuple], keep: list[str], names: Iterable[str]):
    """For ``mapInArrow``: the columns ``keep`` as they are, and what ``fn`` makes of each text.

    ``fn`` returns one value per name. Ids stay Arrow columns, so that nulls do not turn them to floats.
    """
    names = list(names)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 500):
                rows = part.slice(at, 500)
                made = [fn(x.as_py()) for x in rows.column("text")]
                columns = list(zip(*made, strict=True)) or [[] for _ in names]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(k) for k in keep] + [pa.array(c) for c in columns], names=keep + names
                )

    return batches
