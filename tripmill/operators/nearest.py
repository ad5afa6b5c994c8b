"""Nearest site to each point, by straight-line distance; ties go to the smallest site id.

Sites are searched through a pyramid of grid cells: at each level a point keeps only the cells that can
still hold its nearest site, judged by the distance to one known site, so it never meets all sites. The
pyramid is as deep as the sites need: with LEAF_SITES sites or fewer there is no level at all. Which
side of a join is sent to all tasks is left to Spark's measured sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A cell with so many sites is not parted further, nor is one at the finest level.
LEAF_SITES = 16
FINEST = 24


def euclid(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt(F.pow(x1 - x2, 2) + F.pow(y1 - y2, 2))


def nearest_site(
    points: DataFrame, point: str, x: Column, y: Column, sites: DataFrame, site: str, sx: Column, sy: Column,
) -> DataFrame:
    """``points`` plus ``site`` and ``distance``; both null without coordinates or without sites.

    ``x, y`` and ``sx, sy`` are expressions in the same units (degrees, or projected metres).
    """
    spots = (
        sites.select(F.col(site).alias("_site"), sx.cast("double").alias("sx"), sy.cast("double").alias("sy"))
        .where("sx IS NOT NULL AND sy IS NOT NULL")
        .groupBy("sx", "sy")
        .agg(F.min("_site").alias("_site"))
    )
    placed = points.withColumns({"_x": x.cast("double"), "_y": y.cast("double")})
    found = _search(placed.where("_x IS NOT NULL AND _y IS NOT NULL").select(F.col(point).alias("_p"), "_x", "_y"), spots)
    found = found.select(F.col("_p").alias(point), F.col("best.site").alias(site), F.col("best.d").alias("distance"))
    return points.join(found, point, "left")


def _search(asked: DataFrame, spots: DataFrame) -> DataFrame:
    spots = spots.where("NOT isnan(sx) AND NOT isnan(sy)")
    box = spots.agg(F.min("sx"), F.min("sy"), F.max("sx"), F.max("sy")).first()
    if box[0] is None:
        box = (0.0, 0.0, 0.0, 0.0)
    x0, y0, side = box[0], box[1], (max(box[2] - box[0], box[3] - box[1]) or 1.0) * (1 + 1e-9)

    def cell(v: Column, origin: float, level: Column | int) -> Column:
        return F.floor((v - origin) / (F.lit(side) / F.pow(F.lit(2.0), F.lit(level) if isinstance(level, int) else level)))

    def cells_at(level: int) -> DataFrame:
        return spots.groupBy(cell(F.col("sx"), x0, level).alias("cx"), cell(F.col("sy"), y0, level).alias("cy"))

    # The first level whose fullest cell is a leaf: one row per level reaches the driver.
    level = F.col("level")
    every = spots.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(FINEST))))
    full = every.groupBy("level", cell(F.col("sx"), x0, level).alias("cx"), cell(F.col("sy"), y0, level).alias("cy")).count()
    fullest = {r["level"]: r["n"] for r in full.groupBy("level").agg(F.max("count").alias("n")).collect()}
    depth = next((k for k in sorted(fullest) if fullest[k] <= LEAF_SITES), FINEST if fullest else 0)

    front = asked.withColumns({"cx": F.lit(0).cast("bigint"), "cy": F.lit(0).cast("bigint")})
    for level in range(1, depth + 1):
        width = side / 2**level
        cells = (
            cells_at(level)
            .agg(F.min(F.struct("sx", "sy")).alias("known"))
            .select(
                F.col("cx").alias("nx"),
                F.col("cy").alias("ny"),
                F.floor(F.col("cx") / 2).alias("cx"),
                F.floor(F.col("cy") / 2).alias("cy"),
                "known",
            )
        )
        west, south = x0 + F.col("nx") * width, y0 + F.col("ny") * width
        dx = F.greatest(west - F.col("_x"), F.col("_x") - (west + width), F.lit(0.0))
        dy = F.greatest(south - F.col("_y"), F.col("_y") - (south + width), F.lit(0.0))
        front = (
            front.join(cells, ["cx", "cy"])
            .withColumn("least", F.sqrt(dx * dx + dy * dy))
            .withColumn(
                "most",
                F.min(euclid(F.col("_x"), F.col("_y"), F.col("known.sx"), F.col("known.sy"))).over(
                    Window.partitionBy("_p")
                ),
            )
            # A hair of slack, as both distances are rounded.
            .where(F.col("least") <= F.col("most") * (1 + 1e-9) + side * 1e-12)
            .select("_p", "_x", "_y", F.col("nx").alias("cx"), F.col("ny").alias("cy"))
        )
    leaves = spots.withColumns({"cx": cell(F.col("sx"), x0, depth), "cy": cell(F.col("sy"), y0, depth)})
    ranked = F.struct(
        euclid(F.col("_x"), F.col("_y"), F.col("sx"), F.col("sy")).alias("d"), F.col("_site").alias("site")
    )
    return front.join(leaves, ["cx", "cy"]).groupBy("_p").agg(F.min(ranked).alias("best"))
