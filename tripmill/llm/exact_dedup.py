"""Exact duplicates: groups by a 128-bit content hash, whose bytes are compared inside the group.

Texts are equal when identical after each run of white space has become one space; null counts as
empty, so null and empty texts are one group. The smallest id of a group stays. A null id is larger
than every other: it stays only where its group has no other. Of repeated rows with one id and equal
text, one stays. An empty table gives an empty result.

The bytes are compared by grouping on ``(hash, text)``: equal rows meet in the map tasks first, so a
group with a third of all rows is one row per task in the shuffle. Hashes that hold two texts are
looked up by text, all others by hash alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import SPACE, join_groups, stored


def normal_text(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " ")


def content_hash(normal: Column) -> Column:
    """128 bits, as hexadecimal text."""
    return F.md5(normal.cast("binary"))


def report(docs: DataFrame, hashed=content_hash) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``hashed`` may be replaced by a weaker hash; the result is the same.
    """
    texts = docs.select(F.col("doc_id"), normal_text(F.col("text")).alias("normal"))
    texts = texts.withColumn("hash", hashed(F.col("normal")))
    groups = texts.groupBy("hash", "normal").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = groups.withColumn("text_sha256", F.sha2(F.col("normal").cast("binary"), 256)).drop("normal")
    groups = stored(groups, "dedup-groups")
    shared = groups.groupBy("hash").agg(F.count("*").alias("texts"), F.sum("group_size").alias("rows"))
    collided = stored(shared.where("texts > 1").select("hash"), "dedup-collided")

    rows = stored(texts.select("doc_id", "hash").withColumn("row", F.monotonically_increasing_id()), "dedup-rows")
    single = groups.join(collided, "hash", "left_anti")
    found = join_groups(rows, single, "hash", "group_size").select("doc_id", "keep_id", "group_size", "text_sha256", "row")
    if not collided.isEmpty():
        # Two texts under one hash: their rows find the group by a digest of the whole text instead.
        both = texts.join(collided, "hash", "left_semi")
        both = both.select("doc_id", F.sha2(F.col("normal").cast("binary"), 256).alias("text_sha256"), F.monotonically_increasing_id().alias("row"))
        mixed = groups.join(collided, "hash", "left_semi").select("text_sha256", "keep_id", "group_size")
        found = found.unionByName(join_groups(both, mixed, "text_sha256", "group_size").select(found.columns))
    # Rows that repeat the id that stays: the first of them.
    found = found.withColumn("stays", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    first = found.where("stays").groupBy("doc_id", "text_sha256").agg(F.min("row").alias("first_row"), F.count("*").alias("n"))
    repeated = stored(first.where("n > 1").drop("n"), "dedup-repeated")
    if not repeated.isEmpty():
        keys = [F.col("doc_id").eqNullSafe(F.col("r_id")), F.col("text_sha256") == F.col("r_sha")]
        repeated = repeated.select(F.col("doc_id").alias("r_id"), F.col("text_sha256").alias("r_sha"), "first_row")
        found = found.join(repeated, keys, "left").withColumn("stays", F.expr("stays AND (first_row IS NULL OR first_row = row)"))
    return found.select("doc_id", "keep_id", "group_size", F.col("stays").alias("kept"), "text_sha256")


def keep(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: one shuffle, of rows already grouped per task."""
    columns = docs.columns
    text = F.col("text")
    normal = normal_text(text)
    rows = docs.select(
        content_hash(normal).alias("_hash"),
        normal.alias("_normal"),
        # The text travels once: only a text that differs from its normal form is carried beside it.
        F.struct(F.col("doc_id").isNull().alias("_no_id"), F.col("doc_id").alias("_id"), F.when(text != normal, text).alias("_raw")).alias("_order"),
        F.struct(
            F.when(text.isNull(), 0).when(text == normal, 1).otherwise(2).alias("_form"),
            F.when(text != normal, text).alias("_text"),
            F.struct(*[F.col(f"`{c}`") for c in columns if c != "text"]).alias("_rest"),
        ).alias("_row"),
    )
    best = rows.groupBy("_hash", "_normal").agg(F.min_by("_row", "_order").alias("_row"))
    text_back = F.when(F.col("_row._form") == 1, F.col("_normal")).when(F.col("_row._form") == 2, F.col("_row._text"))
    return best.select(*[text_back.alias(c) if c == "text" else F.col(f"_row._rest.`{c}`").alias(c) for c in columns])


ORACLE = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS normal FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY normal) AS keep_id, count(*) OVER (PARTITION BY normal) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY normal) AS kept, sha256(normal) AS text_sha256
FROM t
"""
