"""The union of polygon parts as one geometry: inner edges gone, overlaps merged, rings closed again.

Edges of different parts of a geometry meet by grid cells and are cut where they cross, touch or run together. All
edges are turned so that the inside of their part is to the left. A piece is on the rim of the
union if no other part covers it and no part lies on its other side. At each corner a piece goes on in the
first piece clockwise, so that parts touching in a point stay apart; rings are then named and ordered by
pointer doubling, in as many joins as the longest ring has binary digits. Rings running counter-clockwise
are shells, the others holes of the smallest shell around them.

Points within TOLERANCE of an edge count as on it, so that pieces of slanted edges which two parts
have in common are recognised. No step holds a geometry in one task but the last, which writes its text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.geometry import wkt_of_parts, wkt_parts
from tripmill.operators.spatial import _cell, _level, polygon_edges, within_pairs
from tripmill.session import stored

#: In the units of the coordinates; a nanodegree is a tenth of a millimetre.
TOLERANCE, DIGITS = 1e-9, 9

_EDGE = ["x1", "y1", "x2", "y2"]


def _turned(edges: DataFrame, poly: str) -> DataFrame:
    """Edges with the inside of their part to the left: shells counter-clockwise, holes clockwise."""
    ring = [poly, "part", "ring"]
    twice = F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1"))
    turn = edges.groupBy(*ring).agg(((twice < 0) == (F.col("ring") == 0)).alias("turn"))
    one, two = F.struct("x1", "y1"), F.struct(F.col("x2").alias("x1"), F.col("y2").alias("y1"))
    start, end = F.when(F.col("turn"), two).otherwise(one), F.when(F.col("turn"), one).otherwise(two)
    named = edges.join(turn, ring).where("x1 <> x2 OR y1 <> y2").select(*ring, start.alias("s"), end.alias("e"))
    return named.select(*ring, F.col("s.x1").alias("x1"), F.col("s.y1").alias("y1"), F.col("e.x1").alias("x2"), F.col("e.y1").alias("y2"))


def _boxed(edges: DataFrame) -> DataFrame:
    return edges.withColumns(
        {
            "west": F.least("x1", "x2") - TOLERANCE, "east": F.greatest("x1", "x2") + TOLERANCE,
            "south": F.least("y1", "y2") - TOLERANCE, "north": F.greatest("y1", "y2") + TOLERANCE,
        }
    )


def _filed(boxed: DataFrame) -> DataFrame:
    for c, low, high in (("cx", "west", "east"), ("cy", "south", "north")):
        boxed = boxed.withColumn(c, F.explode(F.sequence(_cell(F.col(low), F.col("level")), _cell(F.col(high), F.col("level")))))
    return boxed


def _meetings(edges: DataFrame, poly: str) -> DataFrame:
    """Pairs of edges of different parts whose boxes meet, each pair once: ``a`` and ``b`` are numbers of edges.

    Edges are filed under cells of their own size; a smaller edge looks up the cells of every larger size in use.
    """
    boxed = _boxed(edges).withColumn("level", _level(F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south"))))
    levels = boxed.agg(F.collect_set("level")).scalar()
    asking = boxed.withColumnRenamed("level", "own").withColumn("level", F.explode(levels)).where("level >= own")
    held = _filed(boxed).select(*[F.col(c).alias(f"o_{c}") for c in [poly, "id", "part", "level", "cx", "cy", "west", "east", "south", "north", *_EDGE]])
    same = [F.col(c) == F.col(f"o_{c}") for c in (poly, "level", "cx", "cy")]
    met = _filed(asking).join(held, same).where("part <> o_part AND west <= o_east AND o_west <= east AND south <= o_north AND o_south <= north")
    pairs = met.select(
        F.least("id", "o_id").alias("a"), F.greatest("id", "o_id").alias("b"),
        F.when(F.col("id") < F.col("o_id"), F.struct(*_EDGE)).otherwise(F.struct(*[F.col(f"o_{c}").alias(c) for c in _EDGE])).alias("ea"),
        F.when(F.col("id") < F.col("o_id"), F.struct(*[F.col(f"o_{c}").alias(c) for c in _EDGE])).otherwise(F.struct(*_EDGE)).alias("eb"),
    )
    return pairs.dropDuplicates(["a", "b"])


def _cuts(pairs: DataFrame) -> DataFrame:
    """``id, x, y``: where an edge is cut. Both edges of a pair get the very same point."""
    length = {e: f"sqrt(power({e}.x2 - {e}.x1, 2) + power({e}.y2 - {e}.y1, 2))" for e in ("ea", "eb")}

    def off(e: str, x: str, y: str) -> str:
        return f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({e}.y2 - {e}.y1) * ({x} - {e}.x1)) / {length[e]}"

    def along(e: str, x: str, y: str) -> str:
        return f"(({e}.x2 - {e}.x1) * ({x} - {e}.x1) + ({e}.y2 - {e}.y1) * ({y} - {e}.y1)) / {length[e]}"

    def on(e: str, x: str, y: str) -> str:
        return f"(abs({off(e, x, y)}) <= {TOLERANCE} AND {along(e, x, y)} BETWEEN -{TOLERANCE} AND {length[e]} + {TOLERANCE})"

    touches = [("a", "ea", "eb.x1", "eb.y1"), ("a", "ea", "eb.x2", "eb.y2"), ("b", "eb", "ea.x1", "ea.y1"), ("b", "eb", "ea.x2", "ea.y2")]
    ends = [f"CASE WHEN {on(e, x, y)} THEN named_struct('id', {i}, 'x', {x}, 'y', {y}) END" for i, e, x, y in touches]
    turn = "((ea.x2 - ea.x1) * (eb.y2 - eb.y1) - (ea.y2 - ea.y1) * (eb.x2 - eb.x1))"
    share = f"(((eb.x1 - ea.x1) * (eb.y2 - eb.y1) - (eb.y1 - ea.y1) * (eb.x2 - eb.x1)) / {turn})"
    x, y = f"ea.x1 + {share} * (ea.x2 - ea.x1)", f"ea.y1 + {share} * (ea.y2 - ea.y1)"
    apart = f"sign({off('ea', 'eb.x1', 'eb.y1')}) * sign({off('ea', 'eb.x2', 'eb.y2')}) < 0 AND sign({off('eb', 'ea.x1', 'ea.y1')}) * sign({off('eb', 'ea.x2', 'ea.y2')}) < 0"
    untouched = "NOT (" + " OR ".join(on(e, px, py) for _, e, px, py in touches) + ")"
    crossing = [f"CASE WHEN {untouched} AND {apart} THEN named_struct('id', {i}, 'x', {x}, 'y', {y}) END" for i in ("a", "b")]
    return pairs.select(F.explode(F.expr(f"array_compact(array({', '.join([*ends, *crossing])}))")).alias("c")).select("c.*")


def _pieces(edges: DataFrame, cuts: DataFrame, poly: str) -> DataFrame:
    """Edges cut at their cuts, in order along the edge."""
    found = edges.join(cuts.groupBy("id").agg(F.collect_set(F.struct("x", "y")).alias("cuts")), "id", "left")
    away = F.expr("transform(cuts, c -> named_struct('d', (c.x - x1) * (x2 - x1) + (c.y - y1) * (y2 - y1), 'x', c.x, 'y', c.y))")
    inner = F.coalesce(F.transform(F.array_sort(away), lambda c: F.struct(c["x"].alias("x"), c["y"].alias("y"))), F.array().cast("array<struct<x:double,y:double>>"))
    first, last = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    chain = found.withColumns({"first": first, "last": last, "inner": inner})
    chain = chain.select(poly, "part", F.concat(F.array("first"), "inner", F.array("last")).alias("chain"))
    pieces = F.expr("transform(sequence(1, size(chain) - 1), i -> named_struct('x1', chain[i - 1].x, 'y1', chain[i - 1].y, 'x2', chain[i].x, 'y2', chain[i].y))")
    return chain.select(poly, "part", F.explode(pieces).alias("e")).select(
        poly, "part", "e.*", _corner("e.x1", "e.y1").alias("u"), _corner("e.x2", "e.y2").alias("v")
    ).where("u <> v")


def _corner(x: str, y: str) -> Column:
    """Points of one corner, rounded alike; minus zero is zero."""
    return F.struct((F.round(F.col(x), DIGITS) + 0.0).alias("x"), (F.round(F.col(y), DIGITS) + 0.0).alias("y"))


def _rim(pieces: DataFrame, parts: DataFrame, poly: str) -> DataFrame:
    """The pieces on the rim of the union, each once, with the inside to the left."""
    forth = F.col("u") < F.col("v")
    lines = pieces.groupBy(poly, F.least("u", "v").alias("p"), F.greatest("u", "v").alias("q")).agg(
        F.collect_set("part").alias("own"), F.max(forth).alias("forth"), F.max(~forth).alias("back"),
        F.min(F.struct("x1", "y1", "x2", "y2", "u", "v")).alias("e"),
    )
    # With parts on both sides a piece is inside the union.
    lines = lines.where("forth <> back").select(poly, "own", "e.*").withColumn("piece", F.monotonically_increasing_id())
    lines = stored(lines, "rim-lines")
    middle = lines.select(poly, "piece", ((F.col("x1") + F.col("x2")) / 2).alias("longitude"), ((F.col("y1") + F.col("y2")) / 2).alias("latitude"))
    # Only parts of the same geometry are looked up: what lies elsewhere in the table covers nothing.
    inside = within_pairs(middle, "piece", parts.select(poly, "whole", "geometry_wkt"), "whole", simple=True, by=poly)
    covered = inside.join(lines.select("piece", "own"), "piece").where(~F.array_contains("own", F.col("whole")))
    return lines.join(covered.select("piece").distinct(), "piece", "left_anti").drop("own")


def _next(rim: DataFrame, poly: str) -> DataFrame:
    """``piece, next``: at each corner the first piece clockwise from where the piece came."""
    to = rim.select(poly, "piece", F.col("v").alias("at"), F.atan2(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2")).alias("back"))
    on = rim.select(F.col(poly).alias("_poly"), F.col("piece").alias("next"), F.col("u").alias("_at"), F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")).alias("out"))
    turn = F.pmod(F.col("back") - F.col("out"), F.lit(2 * math.pi))
    turn = F.when(turn <= 0, 2 * math.pi).otherwise(turn)
    met = to.join(on, (F.col(poly) == F.col("_poly")) & (F.col("at") == F.col("_at")))
    return met.groupBy("piece").agg(F.min_by("next", F.struct(turn, "next")).alias("next"))


def _ranked(links: DataFrame) -> DataFrame:
    """``piece, ring, ahead``: the ring's smallest piece, and how many steps it is ahead.

    After k rounds a piece knows the smallest of the 2^k pieces from itself on, and the piece after them.
    """
    known = stored(links.select("piece", F.col("next").alias("to"), F.col("piece").alias("ring"), F.lit(0).cast("bigint").alias("ahead")), "rings")
    span, changed = 1, True
    while changed:
        other = known.select(F.col("piece").alias("to"), F.col("to").alias("to2"), F.col("ring").alias("ring2"), (F.col("ahead") + span).alias("ahead2"))
        both = known.join(other, "to")
        nearer = F.col("ring2") < F.col("ring")
        known = both.select(
            "piece", F.col("to2").alias("to"), F.least("ring", "ring2").alias("ring"), F.when(nearer, F.col("ahead2")).otherwise(F.col("ahead")).alias("ahead"), nearer.alias("new")
        )
        known = stored(known, "rings")
        changed, span = not known.where("new").isEmpty(), span * 2
        known = known.drop("new")
    return known.select("piece", "ring", "ahead")


def dissolve(polygons: DataFrame, poly: str, wkt: str = "geometry_wkt") -> DataFrame:
    """``poly, geometry_wkt``: the union of all polygon parts with one value of ``poly``.

    Text that is no polygon adds nothing; an id without any part has no row.
    """
    named, poly = poly, "_of"
    parts = polygons.where(F.col(named).isNotNull()).select(F.col(named).alias(poly), F.explode(wkt_parts(wkt)).alias("rings"))
    parts = parts.distinct().withColumn("part", F.monotonically_increasing_id())
    parts = parts.select(poly, "part", F.col("part").alias("whole"), wkt_of_parts("array(rings)").alias("geometry_wkt"))
    parts = stored(parts, "union-parts")
    edges = polygon_edges(parts.drop(poly).withColumnRenamed("part", "p"), "p").drop("part").withColumnRenamed("p", "part").where("x1 <> x2 OR y1 <> y2")
    edges = _turned(edges.join(parts.select(poly, "part"), "part"), poly)
    edges = stored(edges.withColumn("id", F.monotonically_increasing_id()), "union-edges")
    rim = stored(_rim(_pieces(edges, _cuts(_meetings(edges, poly)), poly), parts, poly), "union-rim")
    ranked = _ranked(_next(rim, poly))

    # The smallest piece comes first, then those from which it is farthest ahead.
    order = F.struct((F.col("ahead") > 0).alias("later"), (-F.col("ahead")).alias("place"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    rings = rim.join(ranked, "piece").groupBy(poly, "ring").agg(
        F.array_sort(F.collect_list(order)).alias("points"),
        (F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("area"),
        F.min(F.struct("piece", ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))).alias("middle"),
    )
    rings = rings.withColumn("points", F.expr("transform(concat(points, slice(points, 1, 1)), p -> named_struct('x', p.x, 'y', p.y))"))
    rings = stored(rings, "union-rings")
    shells, holes = rings.where("area > 0"), rings.where("area < 0")
    bodies = shells.select(poly, F.col("ring").alias("shell"), wkt_of_parts("array(array(points))").alias("geometry_wkt"))
    spots = holes.select(poly, "ring", F.col("middle.x").alias("longitude"), F.col("middle.y").alias("latitude"))
    around = within_pairs(spots, "ring", bodies, "shell", simple=True, by=poly).withColumnRenamed("ring", "hole")
    around = around.join(shells.select(F.col("ring").alias("shell"), "area"), "shell")
    around = around.join(holes.select(F.col("ring").alias("hole"), "points"), "hole")
    around = around.groupBy("hole").agg(F.min_by(F.struct("shell", "points"), F.struct("area", "shell")).alias("h"))
    inner = around.groupBy(F.col("h.shell").alias("ring")).agg(F.array_sort(F.collect_list("h.points")).alias("inner"))
    whole = shells.join(inner, "ring", "left").withColumn("rings", F.concat(F.array("points"), F.coalesce("inner", F.expr("cast(array() as array<array<struct<x:double,y:double>>>)"))))
    whole = whole.groupBy(poly).agg(F.array_sort(F.collect_list("rings")).alias("parts"))
    return whole.select(F.col(poly).alias(named), wkt_of_parts("parts").alias("geometry_wkt"))
