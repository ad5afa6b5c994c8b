"""Mixing sources to target weights by weighted sampling without replacement, in whole epochs first.

Every document gets an exponential key, -ln(u) / quality, with u in (0, 1) fixed by its id and text
(so reruns agree on any cluster). Taken in ascending order of the key, documents are a sample without
replacement with chances by quality (Efraimidis and Spirakis). A source's target buys as many complete
epochs of the source as it holds; what is left is spent on a prefix of the ascending keys. A document
is in the prefix if more than half of it is, so a source misses its target by half a document at most.

Defined results: null or blank texts have size 0, and 0 words are taken of them. A null source is a
source of its own, after all others. Null ids and repeated rows are documents like others; rows that
tie in key, id and text share one place each, in any order. Long texts are counted whole. Extra columns of any name are
carried along as they are. No rows: no result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import SPACE, stored

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: The mix has this many times the words of all documents, and no source more than LIMIT times its own.
SHARE, LIMIT = 1.5, 2
SYMBOLS = "#*$%&|<>"
LEAST_QUALITY = 0.05
#: About so many documents are ordered by one task at a time.
BUCKET_ROWS = 2_000
#: Qualities in one cell differ by less than this factor: fewer than 100 cells.
CELL = 1.05


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def quality(text: Column, size: Column) -> Column:
    """One less the number of symbols a word, between LEAST_QUALITY and 1."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.greatest(F.lit(LEAST_QUALITY), 1.0 - F.coalesce(symbols, F.lit(0)) / F.greatest(size, F.lit(1)))


def uniform(doc_id: Column, text: Column) -> Column:
    """In (0, 1), from 52 bits of a digest of the id and the text's digest."""
    digest = F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def targets(sizes: DataFrame) -> DataFrame:
    """Targets of the sources: by weight, none above its limit, the excess reshared by weight.

    Resharing until none is above ends where all sources below their limit have the same words a unit
    of weight. In the order of limit / weight the sources at their limit come first, so their number
    follows from running sums. One row per source is read here, not one per document.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    place = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (place + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * LIMIT)
    filling = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "*",
        F.coalesce(F.sum("limit").over(filling), F.lit(0)).alias("full"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0))).alias("rest"),
        (F.sum("source_size").over(everything) * SHARE).alias("wanted"),
    )
    level, ratio = (F.col("wanted") - F.col("full")) / F.col("rest"), F.col("limit") / F.col("weight")
    first = F.min(F.when(level <= ratio, F.struct(ratio.alias("ratio"), level.alias("level")))).over(everything)
    rows = rows.withColumn("level", first["level"])
    target = F.least(F.col("limit").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit").cast("double")))
    return rows.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, epochs, taken, and the row's place.

    ``row`` numbers the rows as read; ``epochs`` is how often the document is taken.
    """
    return allotted(stored(weighed(docs), "mix-sizes"))


def weighed(docs: DataFrame, *others: Column) -> DataFrame:
    """``others`` and, per document, doc_id, source, size, key and the cell of its quality."""
    size = words(F.col("text"))
    rows = docs.select(*others, "doc_id", "source", size.alias("size"), uniform(F.col("doc_id"), F.col("text")).alias("u"), quality(F.col("text"), size).alias("quality"))
    cell = F.floor(F.log(F.col("quality") / LEAST_QUALITY) / math.log(CELL)).cast("int")
    return rows.withColumn("key", -F.log("u") / F.col("quality")).withColumn("cell", cell).drop("u", "quality")


def share_below(cells: Column, key: Column) -> Column:
    """The share of a source's keys that are expected up to ``key``, by its rows in each cell of quality: rises with the key."""
    rate = lambda c: LEAST_QUALITY * F.pow(F.lit(CELL), c["cell"] + 0.5)
    rows = F.aggregate(cells, F.lit(0.0), lambda total, c: total + c["rows"])
    above = F.aggregate(cells, F.lit(0.0), lambda total, c: total + c["rows"] * F.exp(-key * rate(c)))
    return F.greatest(F.lit(0.0), 1.0 - above / rows)


def allotted(rows: DataFrame) -> DataFrame:
    """From rows with doc_id, source, size, key and cell; other columns are carried along."""
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    cells = cells.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum("rows").alias("source_rows"), F.sort_array(F.collect_list(F.struct("cell", "rows"))).alias("cells")
    )
    cells = stored(cells, "mix-sources")
    plan = targets(cells.select("source", "source_size"))
    plan = plan.join(cells.select(F.col("source").alias("s"), "source_rows", "cells"), F.col("s").eqNullSafe(F.col("source"))).drop("s")
    # A key's expected share is uniform: slices of it hold about BUCKET_ROWS documents each, whatever their qualities.
    slices = F.ceil(F.col("source_rows") / BUCKET_ROWS)
    plan = plan.select(
        F.col("source").alias("s"), "source_size", "target", slices.alias("slices"), "cells",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("whole"),
    )
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("slice", F.floor(share_below(F.col("cells"), F.col("key")) * F.col("slices"))).drop("cells", "cell")
    ahead = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ahead.select(F.col("source").alias("s"), F.col("slice").alias("b"), F.coalesce(F.sum("slice_size").over(before), F.lit(0)).alias("ahead"))
    rows = rows.join(ahead, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("b"))).drop("s", "b")
    within = Window.partitionBy("source", "slice").orderBy("key", F.col("doc_id").isNull(), "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("ahead") + F.sum("size").over(within)
    budget = F.col("target") - F.col("whole") * F.col("source_size")
    chosen = (F.col("size") > 0) & (end - F.col("size") / 2 < budget)
    rows = rows.withColumn("epochs", (F.col("whole") + F.when(chosen, 1).otherwise(0)).cast("long"))
    rows = rows.withColumn("taken", F.col("epochs") * F.col("size"))
    return rows.drop("slices", "slice", "whole", "ahead")


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of the mix: every document as often as it is taken, with its columns as they were.

    Documents of no words are never taken. Rows are ordered and counted without their texts; each text
    then moves once, to the task of its id, where it is repeated.
    """
    columns = docs.columns
    # The caller's columns travel as one, whatever their names.
    keyed = weighed(docs, F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    plan = allotted(stored(keyed.drop("row"), "mix-sizes")).where("epochs > 0")
    # Rows that tie in id, source and key are alike: they share the sum of what they got.
    plan = plan.groupBy("doc_id", "source", "key").agg(F.sum("epochs").alias("epochs"), F.count("*").alias("alike"))
    plan = plan.select(F.col("doc_id").alias("p_id"), F.col("source").alias("p_source"), F.col("key").alias("p_key"), "epochs", "alike")
    same = [F.col("doc_id").eqNullSafe(F.col("p_id")), F.col("source").eqNullSafe(F.col("p_source")), F.col("key") == F.col("p_key")]
    rows = keyed.join(plan, same).select("row", F.explode(F.expr("sequence(1, int(ceil(epochs / alike)))")).alias("copy"))
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')) AS symbols,
    (('0x' || substr(md5(doc_id::VARCHAR || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496 AS u
  FROM documents),
k AS (SELECT *, -ln(u) / greatest(0.05::DOUBLE, 1::DOUBLE - symbols::DOUBLE / greatest(size, 1)::DOUBLE) AS key FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM k GROUP BY source),
-- the common level: the only one at which all targets add up to the wanted words
level AS (
  SELECT max(l) AS level FROM (
    SELECT (SELECT (1.5 * sum(source_size) - sum(CASE WHEN 2 * source_size / weight < c.r THEN 2 * source_size ELSE 0 END))
        / nullif(sum(CASE WHEN 2 * source_size / weight < c.r THEN 0 ELSE weight END), 0) FROM s) AS l, c.r
    FROM (SELECT DISTINCT 2 * source_size / weight AS r FROM s) AS c) AS x WHERE l <= r
    AND l >= coalesce((SELECT max(2 * source_size / weight) FROM s WHERE 2 * source_size / weight < x.r), 0)),
t AS (SELECT s.source, source_size, least(2.0::DOUBLE * source_size, coalesce((SELECT level FROM level) * weight, 2.0::DOUBLE * source_size)) AS target FROM s),
e AS (
  SELECT k.doc_id, k.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS whole,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING) AS past
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  ((whole + CASE WHEN size > 0 AND past - size / 2 < target - whole * source_size THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM e
"""
