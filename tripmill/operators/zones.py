"""Zones of influence of sites: Voronoi cells in UTM 16N, cut off by one frame around everything.

The frame is the box of the sites, widened on each side by its longer extent and then stretched to
hold the city. Cells are not clipped to the city itself.

Sites lie in square tiles. A site is cut by the sites of its own and the eight tiles around it; its cell is
settled when no other site can reach one of its corners, that is, when the circle around each corner
through the site lies within those tiles, or beyond all sites. Settled sites tell the sites whose cells
touch theirs, and leave; the others go on in tiles four times as wide. A site that was not told by a settled one
has no side in common with it, so each round only looks at the sites still left: mostly the outer ones of
dense spots, and in the end the outermost ones of all. Tiles with many sites are divided first, and their sites
settled in smaller tiles, so that a dense spot is not met as a whole by the sites around it.

Sites with equal coordinates have one cell. When no more than LAST sites are left, one task sees them all. Sites that
are all on one line touch the frame with every cell, stay to the last round and are compared with each
other there; any scatter ends that.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import geometry
from tripmill.functions.geometry import CRS, lonlat_from_utm16n, utm16n
from tripmill.operators.spatial import projected_edges
from tripmill.session import stored

#: Tiles hold about PER_TILE sites; those with more than CROWD are divided DIVIDE by DIVIDE; tiles grow by GROW.
PER_TILE, CROWD, DIVIDE, GROW = 16, 256, 8, 4
#: So many sites are compared with each other in one task.
LAST = 1_000
#: Metres: sites whose bisector is this near a corner are told; corners nearer than this are one.
NEAR = 1e-6

# The helpers travel with the task, so executors need no copy of this package.
for _module in (sys.modules[__name__], geometry):
    cloudpickle.register_pickle_by_value(_module)

SCHEMA = "station_id string, geometry_wkt string, area_km2 double, crs string"
#: Points are flat arrays x, y, x, y; ``told`` are settled sites next to a site, ``next`` the sites next to a settled one.
_LEFT = "x double, y double, depth int, ring array<double>, told array<double>"
_CUT = _LEFT + ", next array<double>, settled boolean"


def _cut(ring: np.ndarray, site: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The part of a convex ring (not closed) that is nearer to ``site`` than to ``other``."""
    normal = other - site
    side = (ring - (site + other) / 2) @ normal / np.hypot(*normal)
    side[np.abs(side) < NEAR] = 0  # on the bisector, as after an earlier cut by the same site
    if side.max() <= 0:
        return ring
    kept = []
    for i in range(len(ring)):
        j = (i + 1) % len(ring)
        if side[i] <= 0:
            kept.append(ring[i])
        if (side[i] < 0 < side[j]) or (side[j] < 0 < side[i]):
            kept.append(ring[i] + (ring[j] - ring[i]) * (side[i] / (side[i] - side[j])))
    return np.array(kept)


def _beyond(ring: np.ndarray, site: np.ndarray, others: np.ndarray) -> np.ndarray:
    """For each other site, how many metres the ring reaches beyond their bisector."""
    normal = others - site
    return ((ring[None, :, :] - ((site + others) / 2)[:, None, :]) * normal[:, None, :]).sum(axis=2).max(axis=1) / np.hypot(*normal.T)


def _cell(site: np.ndarray, others: np.ndarray, ring: np.ndarray) -> np.ndarray:
    """What of the ring is nearer to the site than to all others (none of which is the site)."""
    gaps = np.hypot(*(others - site).T)
    order = np.argsort(gaps, kind="stable")
    for k in order[:12]:
        ring = _cut(ring, site, others[k])
    # Sites more than twice as far as the farthest corner cannot cut the cell any more.
    far = 2 * np.hypot(*(ring - site).T).max()
    rest = order[12 : np.searchsorted(gaps[order], far, "right")]
    if len(rest):
        for k in rest[_beyond(ring, site, others[rest]) > NEAR]:
            ring = _cut(ring, site, others[k])
    return ring


def _one_corner(ring: np.ndarray) -> np.ndarray:
    """Corners that lie together are one."""
    apart = np.hypot(*(ring - np.roll(ring, 1, axis=0)).T) > NEAR
    return ring[apart] if apart.sum() > 2 else ring


def _settle(width: float, corner: tuple[float, float], box: tuple[float, ...], frame: np.ndarray):
    """Cells of the sites at home in a tile, cut by those seen from it."""

    def settle(key, home: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
        low = np.array([corner[0] + (key[0] - 1) * width, corner[1] + (key[1] - 1) * width])
        high = low + 3 * width
        around, rows = seen[["ox", "oy"]].to_numpy(dtype=float), []
        for row in home.itertuples(index=False):
            site = np.array([row.x, row.y])
            told = np.array(row.told, dtype=float).reshape(-1, 2)
            others = np.concatenate([around[(around != site).any(axis=1)], told])
            ring = frame if row.ring is None else np.array(row.ring, dtype=float).reshape(-1, 2)
            ring = _cell(site, others, ring)
            reach = np.hypot(*(ring - site).T)[:, None] + NEAR
            south, north = np.maximum(ring - reach, box[:2]), np.minimum(ring + reach, box[2:])
            settled = bool((south >= low).all() and (north <= high).all())
            near = others[_beyond(ring, site, others) > -NEAR].ravel() if settled and len(others) else np.empty(0)
            rows.append((row.x, row.y, row.depth, ring.ravel(), row.told, near, settled))
        return pd.DataFrame(rows, columns=["x", "y", "depth", "ring", "told", "next", "settled"])

    return settle


def _tile(v: str, start: float, width: float) -> Column:
    return F.floor((F.col(v) - F.lit(start)) / F.lit(width)).cast("bigint")


def _depths(spots: DataFrame, width: float, corner: tuple[float, float], least: float, crowd: int) -> tuple[DataFrame, int]:
    """Spots with ``depth``: how often their tile is divided until it has ``crowd`` spots at most."""
    left, done, depth = spots, None, 0
    while True:
        tiles = [_tile("x", corner[0], width).alias("tx"), _tile("y", corner[1], width).alias("ty")]
        crowded = stored(left.groupBy(*tiles).count().where(F.col("count") > crowd).select(F.col("tx").alias("cx"), F.col("ty").alias("cy")), "tiles")
        end = crowded.isEmpty() or width <= least
        if end and done is None:
            return left.withColumn("depth", F.lit(0)), 0
        in_crowded = (tiles[0] == F.col("cx")) & (tiles[1] == F.col("cy"))
        calm = left if end else left.join(crowded, in_crowded, "left_anti")
        calm = calm.withColumn("depth", F.lit(depth))
        done = calm if done is None else done.unionByName(calm)
        if end:
            return done, depth
        left = stored(left.join(crowded, in_crowded, "left_semi"), "crowded")
        width, depth = width / DIVIDE, depth + 1


def _cells(spots: DataFrame, box: tuple[float, ...], n: int, frame: np.ndarray, last: int, crowd: int) -> DataFrame:
    """``x, y, ring`` of all distinct spots."""
    corner, extent = box[:2], max(box[2] - box[0], box[3] - box[1])
    area = max((box[2] - box[0]) * (box[3] - box[1]), extent * extent / n)
    width, deepest = (area * PER_TILE / n) ** 0.5 or 1.0, 0
    if n > last:
        spots, deepest = _depths(spots, width, corner, extent * 2.0**-45, crowd)
    else:
        spots = spots.withColumn("depth", F.lit(0))
    left = spots.select("x", "y", "depth", F.lit(None).cast("array<double>").alias("ring"), F.array().cast("array<double>").alias("told"))
    left, rings, depth = stored(left, "sites"), None, deepest
    while n:
        # One task for the last sites; until then tiles, first the divided ones, then wider ones.
        step = 2 * extent + 1.0 if n <= last else width * (float(DIVIDE) ** -depth if depth > 0 else float(GROW) ** -depth)
        tx, ty = _tile("x", corner[0], step), _tile("y", corner[1], step)
        now = F.lit(True) if n <= last else F.col("depth") >= depth
        home = left.where(now).withColumns({"tx": tx, "ty": ty})
        seen = left.select(F.col("x").alias("ox"), F.col("y").alias("oy"), tx.alias("sx"), ty.alias("sy"))
        if n > last:
            for axis in ("sx", "sy"):
                seen = seen.withColumn(axis, F.explode(F.sequence(F.col(axis) - 1, F.col(axis) + 1)))
            tiles = home.select(F.col("tx").alias("sx"), F.col("ty").alias("sy")).distinct()
            seen = seen.join(tiles, ["sx", "sy"], "left_semi")
        pairs = home.groupBy("tx", "ty").cogroup(seen.groupBy("sx", "sy"))
        cut = stored(pairs.applyInPandas(_settle(step, corner, box, frame), _CUT), "cells")
        settled = cut.where("settled").select("x", "y", "ring")
        rings = settled if rings is None else rings.unionByName(settled)
        next_to = cut.where("settled").select("x", "y", F.posexplode("next").alias("at", "v"), "next").where("at % 2 = 0")
        told = next_to.groupBy(F.col("v").alias("x"), F.expr("next[at + 1]").alias("y")).agg(F.flatten(F.collect_list(F.array("x", "y"))).alias("more"))
        waiting = cut.where("NOT settled").drop("next", "settled")
        if n > last:
            waiting = waiting.unionByName(left.where(~now))
        left = waiting.join(told, ["x", "y"], "left").withColumn("told", F.concat("told", F.coalesce("more", F.array().cast("array<double>")))).drop("more")
        left = stored(left, "sites")
        n, depth = left.count(), depth - 1
    return rings


def voronoi_zones(stations: DataFrame, city: DataFrame | None = None, last: int = LAST, crowd: int = CROWD) -> DataFrame:
    """``station_id, geometry_wkt, area_km2, crs``: one zone per station, corners in lon/lat."""
    at = utm16n("CAST(longitude AS DOUBLE)", "CAST(latitude AS DOUBLE)")
    placed = stations.where("longitude IS NOT NULL AND latitude IS NOT NULL")
    placed = placed.select("station_id", at.alias("at")).select("station_id", "at.x", "at.y")
    sites = stored(placed, "stations")
    spots = stored(sites.select("x", "y").distinct(), "spots")
    found = spots.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y"), F.count("*")).first()
    if not found[4]:
        return stations.sparkSession.createDataFrame([], SCHEMA)
    box = tuple(found[:4])
    rings = _cells(spots, box, found[4], _frame(box, city), last, crowd)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                ring = _one_corner(np.array(row.ring, dtype=float).reshape(-1, 2))
                x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
                area = abs(np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y)) / 2 / 1e6
                lonlat = [lonlat_from_utm16n(*p) for p in [*ring, ring[0]]]
                text = ", ".join(f"{float(lon)!r} {float(lat)!r}" for lon, lat in lonlat)
                rows.append((row.station_id, f"POLYGON (({text}))", round(float(area), 2), CRS))
            yield pd.DataFrame(rows, columns=["station_id", "geometry_wkt", "area_km2", "crs"])

    return sites.join(rings, ["x", "y"]).select("station_id", "ring").mapInPandas(build, SCHEMA)


def _frame(box: tuple[float, ...], city: DataFrame | None) -> np.ndarray:
    low, high = np.array(box[:2]), np.array(box[2:])
    margin = (high - low).max()
    low, high = low - margin, high + margin
    if city is not None:
        edges = projected_edges(city, "boundary_id")
        found = edges.agg(F.min("x1"), F.min("y1"), F.max("x1"), F.max("y1")).first()
        if found[0] is not None:
            low, high = np.minimum(low, [found[0], found[1]]), np.maximum(high, [found[2], found[3]])
    return np.array([[low[0], low[1]], [high[0], low[1]], [high[0], high[1]], [low[0], high[1]]])
