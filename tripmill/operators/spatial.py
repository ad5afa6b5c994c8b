"""Point-in-polygon joins: ``within`` means strictly inside, as boundary points are not within.

Polygons are cut into bands of about BAND_EDGES edge ends each, level ones or, where far fewer edges reach
into them, upright ones, and each band is filed under the grid cells its box touches, at levels whose cells are at least as wide and as high as the box but no
more than twice that: a thin band lies in thin cells, so a band is filed at most four times and a cell
holds few bands of a part. A point looks up one cell per pair of levels in use. The lookup is an
equi-join that Spark may broadcast, sort-merge or split for skew by the sizes it measures. No point
meets a polygon whose box is not near it, and edges stay inside an array, so no (point, edge) rows are
made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.geometry import ring_edges, utm16n, wkt_parts
from tripmill.session import stored

BAND_EDGES = 64
FLOOR_LEVEL = -40  # boxes without extent


def polygon_edges(polygons: DataFrame, poly: str, wkt: str = "geometry_wkt") -> DataFrame:
    """The edge table: ``poly, part, ring, x1, y1, x2, y2``; ring 0 is the shell, the others holes."""
    parts = polygons.where(F.col(wkt).isNotNull()).select(poly, F.posexplode(wkt_parts(wkt)).alias("part", "rings"))
    rings = parts.select(poly, "part", F.posexplode("rings").alias("ring", "points"))
    return rings.select(poly, "part", "ring", F.explode(ring_edges("points")).alias("e")).select(
        poly, "part", "ring", "e.*"
    )


def projected_edges(polygons: DataFrame, poly: str, wkt: str = "geometry_wkt") -> DataFrame:
    """The edge table in UTM 16N metres."""
    one, two = utm16n("x1", "y1"), utm16n("x2", "y2")
    return polygon_edges(polygons, poly, wkt).select(
        poly, "part", "ring", one["x"].alias("x1"), one["y"].alias("y1"), two["x"].alias("x2"), two["y"].alias("y2")
    )


def polygon_areas(polygons: DataFrame, poly: str, wkt: str = "geometry_wkt") -> DataFrame:
    """``poly, km2``: planar area in UTM 16N, shells less holes, not rounded."""
    twice = F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1"))
    rings = projected_edges(polygons, poly, wkt).groupBy(poly, "part", "ring").agg((F.abs(twice) / 2).alias("m2"))
    signed = F.when(F.col("ring") == 0, F.col("m2")).otherwise(-F.col("m2"))
    return rings.groupBy(poly).agg((F.sum(signed) / 1_000_000).alias("km2"))


def _line(digits: int = 9) -> Column:
    """The line that carries an edge, rounded: slope and height, or the x of an upright one."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    slope = F.when(dx != 0, dy / dx)
    height = F.when(dx != 0, F.col("y1") - slope * F.col("x1")).otherwise(F.col("x1"))
    # Minus zero is zero.
    return F.struct((F.round(slope, digits) + 0.0).alias("slope"), (F.round(height, digits) + 0.0).alias("height"))


def _split_edges(edges: DataFrame, poly: str) -> DataFrame:
    """Edges cut where edges of other parts on the same line begin or end.

    Parts of one geometry that touch along a piece of an edge then have that piece in common.
    """
    lined = edges.withColumn("line", _line())
    end = F.explode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))))
    ends = lined.select(F.col(poly).alias("_poly"), F.col("line").alias("_line"), F.col("part").alias("_part"), end.alias("at")).distinct()
    ends = ends.select("_poly", "_line", "_part", "at.x", "at.y")
    # Strictly between the edge's ends along the axis it is longer on.
    along = F.abs(F.col("x2") - F.col("x1")) >= F.abs(F.col("y2") - F.col("y1"))

    def between(v: str, a: str, b: str) -> Column:
        return (F.col(v) > F.least(a, b)) & (F.col(v) < F.greatest(a, b))

    cut = (F.col(poly) == F.col("_poly")) & F.col("line").eqNullSafe(F.col("_line")) & (F.col("part") != F.col("_part"))
    cut = cut & F.when(along, between("x", "x1", "x2")).otherwise(between("y", "y1", "y2"))
    own = [poly, "part", "ring", "x1", "y1", "x2", "y2"]
    cuts = lined.join(ends, cut).groupBy(*own).agg(F.collect_set(F.struct("x", "y")).alias("cuts"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in own]
    found = edges.join(cuts.select(*[F.col(c).alias(f"_{c}") for c in own], "cuts"), same, "left").select(*own, "cuts")
    first, last = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    away = F.expr("transform(cuts, c -> named_struct('d', abs(c.x - x1) + abs(c.y - y1), 'x', c.x, 'y', c.y))")
    inner = F.coalesce(F.transform(F.array_sort(away), lambda c: F.struct(c["x"].alias("x"), c["y"].alias("y"))), F.array().cast("array<struct<x:double,y:double>>"))
    chain = found.withColumn("chain", F.concat(F.array(first), inner, F.array(last)))
    pieces = F.explode(F.expr("transform(sequence(1, size(chain) - 1), i -> named_struct('x1', chain[i - 1].x, 'y1', chain[i - 1].y, 'x2', chain[i].x, 'y2', chain[i].y))"))
    return chain.select(poly, "part", "ring", pieces.alias("e")).select(poly, "part", "ring", "e.*")


def _marked_edges(edges: DataFrame, poly: str) -> DataFrame:
    """Edges with ``shared``: the edge lies between two parts of the same geometry.

    The union of touching parts has no boundary there.
    """
    edges = _split_edges(edges, poly)
    one = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))
    two = F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    same_side = Window.partitionBy(poly, F.least(one, two), F.greatest(one, two))
    return edges.withColumn("shared", F.count(F.lit(1)).over(same_side) % 2 == 0)


def _laid_parts(edges: DataFrame, poly: str) -> DataFrame:
    """Per part: its box, the axis its bands follow with the limits on it, and into how many buckets it is counted.

    Bands are ``upright`` where they are reached by fewer edges than level ones, by a factor of two. That asks for closed
    rings: every corner is then an end of an even number of edges.
    """

    def corner(x: str, y: str) -> Column:
        return F.bit_xor(F.xxhash64(F.col(x) + 0.0, F.col(y) + 0.0))

    ends = edges.withColumns({"across": F.abs(F.col("x2") - F.col("x1")), "rise": F.abs(F.col("y2") - F.col("y1"))})
    parts = ends.groupBy(poly, "part").agg(
        F.min(F.least("x1", "x2")).alias("west"), F.max(F.greatest("x1", "x2")).alias("east"),
        F.min(F.least("y1", "y2")).alias("south"), F.max(F.greatest("y1", "y2")).alias("north"),
        F.sum("across").alias("across"), F.sum("rise").alias("rise"), F.count(F.lit(1)).alias("n"),
        ((corner("x1", "y1") == corner("x2", "y2")) & (F.count(F.col("across") + F.col("rise")) == F.count(F.lit(1)))).alias("closed"),
    )
    fewer = 2 * F.col("across") * (F.col("north") - F.col("south")) < F.col("rise") * (F.col("east") - F.col("west"))
    parts = parts.withColumn("upright", F.coalesce(F.col("closed") & (F.col("n") > BAND_EDGES) & fewer, F.lit(False)))
    lowest, highest = (F.when(F.col("upright"), F.col(x)).otherwise(F.col(y)) for x, y in (("west", "south"), ("east", "north")))
    buckets = F.greatest(F.lit(1), F.expr(f"n div {BAND_EDGES * BAND_EDGES}")).cast("int")
    return parts.select(poly, "part", "upright", lowest.alias("lowest"), highest.alias("highest"), buckets.alias("buckets"))


def _bucket(v: str) -> Column:
    """The bucket of a value on the bands' axis; it never falls as the value grows."""
    share = (F.col(v) - F.col("lowest")) / (F.col("highest") - F.col("lowest"))
    inside = F.least(F.floor(share * F.col("buckets")), F.col("buckets") - 1)
    return F.when(F.col(v).isNotNull() & (F.col("highest") > F.col("lowest")), inside).otherwise(0).cast("int")


def polygon_bands(polygons: DataFrame, poly: str, wkt: str = "geometry_wkt", simple: bool = False) -> DataFrame:
    """Per polygon part, bands with the edges that reach into them, and the box of those.

    Limits ``lo`` and ``hi`` are ends of edges, in y or, of ``upright`` bands, in x: a band is ``[lo, hi)``, the last one
    ``[lo, hi]``. A part is counted by equal buckets, so that no task holds it whole. The parts of ``simple`` geometries have
    no edges in common, so none are looked for.
    """
    # The text is parsed once.
    edges = stored(polygon_edges(polygons, poly, wkt), "edges")
    edges = edges.withColumn("shared", F.lit(False)) if simple else stored(_marked_edges(edges, poly), "marked-edges")
    part, parts = [poly, "part"], _laid_parts(edges, poly)
    at = {f"a{i}": F.when(F.col("upright"), F.col(f"x{i}")).otherwise(F.col(f"y{i}")) for i in (1, 2)}
    laid = edges.join(parts, part).withColumns(at).withColumns({"low": F.least("a1", "a2"), "high": F.greatest("a1", "a2")})

    ranked = laid.withColumn("bucket", _bucket("a1"))
    ranked = ranked.withColumn("n", F.row_number().over(Window.partitionBy(*part, "bucket").orderBy("a1")))
    cuts = ranked.where(f"n % {BAND_EDGES} = 1 AND a1 > lowest AND a1 < highest")
    cuts = cuts.groupBy(*part, "bucket").agg(F.array_sort(F.collect_set("a1")).alias("cuts"))
    every = parts.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)))
    every = every.join(cuts, [*part, "bucket"], "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<double>")))
    earlier = Window.partitionBy(*part).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    every = every.withColumn("before", F.coalesce(F.sum(F.size("cuts")).over(earlier), F.lit(0)).cast("int"))

    starts = every.select(*part, "highest", "before", F.posexplode("cuts").alias("place", "lo"))
    starts = starts.select(*part, (F.col("before") + F.col("place") + 1).alias("band"), "lo", "highest")
    starts = starts.unionAll(parts.select(*part, F.lit(0).alias("band"), F.col("lowest").alias("lo"), "highest"))
    after = F.lead("lo").over(Window.partitionBy(*part).orderBy("band"))
    limits = starts.select(*part, "band", "lo", F.coalesce(after, "highest").alias("hi"), after.isNull().alias("top"))

    spread = laid
    for end in ("low", "high"):
        held = every.select(*part, F.col("bucket").alias(f"{end}_bucket"), F.col("cuts").alias(f"{end}_cuts"), F.col("before").alias(f"{end}_before"))
        spread = spread.withColumn(f"{end}_bucket", _bucket(end)).join(held, [*part, f"{end}_bucket"])
    low, high = (F.col(f"{end}_before") + F.expr(f"size(filter({end}_cuts, c -> c <= {end}))") for end in ("low", "high"))
    spread = spread.select(*part, "upright", "x1", "y1", "x2", "y2", "shared", F.explode(F.sequence(low, high)).alias("band"))
    bands = spread.groupBy(*part, "band").agg(
        F.collect_list(F.struct("x1", "y1", "x2", "y2", "shared")).alias("edges"),
        F.first("upright").alias("upright"),
        F.min(F.least("x1", "x2")).alias("west"), F.max(F.greatest("x1", "x2")).alias("east"),
        F.min(F.least("y1", "y2")).alias("south"), F.max(F.greatest("y1", "y2")).alias("north"),
    )
    bands = bands.join(limits, [*part, "band"])
    across = {c: F.when(F.col("upright"), F.col(limit)).otherwise(F.col(c)) for c, limit in (("west", "lo"), ("east", "hi"))}
    along = {c: F.when(F.col("upright"), F.col(c)).otherwise(F.col(limit)) for c, limit in (("south", "lo"), ("north", "hi"))}
    return bands.withColumns(across | along)


def _level(extent: Column) -> Column:
    """The grid level whose cells are as large as the extent, less than twice as large at most."""
    return F.when(extent > 0, F.ceil(F.log2(extent))).otherwise(F.lit(FLOOR_LEVEL)).cast("int")


def filed_bands(bands: DataFrame) -> DataFrame:
    """Bands with ``lx, ly, cx, cy``: the cells that their boxes touch, at levels of their own width and height."""
    filed = bands.withColumns({"lx": _level(F.col("east") - F.col("west")), "ly": _level(F.col("north") - F.col("south"))})
    for c, level, low, high in (("cx", "lx", "west", "east"), ("cy", "ly", "south", "north")):
        filed = filed.withColumn(c, F.explode(F.sequence(_cell(F.col(low), F.col(level)), _cell(F.col(high), F.col(level)))))
    return filed


def _cell(v: Column, level: Column) -> Column:
    return F.floor(v / F.pow(F.lit(2.0), level))


# Edges a ray from (px, py) to the east crosses; half-open in y, so that corners count once.
_CROSSED = """filter(edges, e -> CASE WHEN (e.y1 > py) != (e.y2 > py)
    THEN px < e.x1 + (py - e.y1) / (e.y2 - e.y1) * (e.x2 - e.x1) ELSE false END)"""

# The same of the edges of an upright band, all others put in by a detour: the ray stops at q = (hi, py), beyond which as
# many edges cross it, but for an even number, as cross the line from q straight down, and those are in the band. Whether q
# is to the left of an edge settles both for that edge, so that rounding cannot part them.
_LEFT = "(e.x2 - e.x1) * (py - e.y1) - (e.y2 - e.y1) * (hi - e.x1) > 0"
_BEYOND = f"""CASE WHEN (e.y1 > py) = (e.y2 > py) THEN false WHEN (e.x1 >= hi) = (e.x2 >= hi) THEN e.x1 >= hi
    ELSE ({_LEFT}) = (e.y2 > e.y1) END"""
_BELOW = f"""CASE WHEN (e.x1 >= hi) = (e.x2 >= hi) THEN false WHEN (e.y1 > py) = (e.y2 > py) THEN e.y1 <= py
    ELSE ({_LEFT}) = (e.x2 > e.x1) END"""
_CROSSED_UPRIGHT = f"""filter(edges, e -> (CASE WHEN (e.y1 > py) != (e.y2 > py)
    THEN px < e.x1 + (py - e.y1) / (e.y2 - e.y1) * (e.x2 - e.x1) ELSE false END) != (({_BEYOND}) != ({_BELOW})))"""

# Edges that (px, py) lies on, ends included.
_TOUCHED = """filter(edges, e -> px BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
    AND py BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)
    AND (e.x2 - e.x1) * (py - e.y1) - (e.y2 - e.y1) * (px - e.x1) = 0)"""


def within_pairs(
    points: DataFrame, point: str, polygons: DataFrame, poly: str, wkt: str = "geometry_wkt",
    lon: str = "longitude", lat: str = "latitude", simple: bool = False, by: str | None = None,
) -> DataFrame:
    """Distinct ``(point, poly)`` where the point lies strictly inside the polygon.

    ``point`` is the unique id of a point; points without finite coordinates are in nothing. ``simple`` states
    that no two parts of a geometry touch along edges, as in single polygons and dissolved ones. With ``by``, a column of
    both tables, one value for a ``poly``, points only meet polygons that have the same value of it.
    """
    filed = filed_bands(stored(polygon_bands(polygons, poly, wkt, simple), "bands"))
    owner = [] if by is None else [by]
    filed = filed if by is None else filed.join(polygons.select(poly, by).distinct(), poly)
    # The pairs of levels in use, as a value that the plan computes: nothing reaches the driver.
    levels = filed.agg(F.collect_set(F.struct("lx", "ly"))).scalar()
    finite = ~F.isnan(F.col(lon).cast("double")) & ~F.isnan(F.col(lat).cast("double"))
    finite = finite & (F.abs(F.col(lon).cast("double")) < float("inf")) & (F.abs(F.col(lat).cast("double")) < float("inf"))
    placed = (
        points.where(finite)
        .select(*owner, F.col(point).alias("_point"), F.col(lon).cast("double").alias("px"), F.col(lat).cast("double").alias("py"))
        .withColumn("level", F.explode(levels))
        .select(*owner, "_point", "px", "py", "level.lx", "level.ly")
        .withColumn("cx", _cell(F.col("px"), F.col("lx")))
        .withColumn("cy", _cell(F.col("py"), F.col("ly")))
    )
    px, py = F.col("px"), F.col("py")
    at = F.when(F.col("upright"), px).otherwise(py)
    own_band = (at >= F.col("lo")) & ((at < F.col("hi")) | F.col("top") & (at <= F.col("hi")))
    in_box = px.between(F.col("west"), F.col("east")) & py.between(F.col("south"), F.col("north"))
    met = placed.join(filed, [*owner, "lx", "ly", "cx", "cy"]).where(in_box & own_band)
    judged = met.withColumn("touching", F.expr(_TOUCHED)).select(
        "_point",
        poly,
        F.expr(f"size(touching) = 0 AND size(CASE WHEN upright THEN {_CROSSED_UPRIGHT} ELSE {_CROSSED} END) % 2 = 1").alias("inside"),
        F.expr("exists(touching, e -> e.shared)").alias("on_shared"),
        F.expr("exists(touching, e -> NOT e.shared)").alias("on_rim"),
    )
    verdict = judged.groupBy("_point", poly).agg(
        F.max("inside").alias("inside"), F.max("on_shared").alias("on_shared"), F.max("on_rim").alias("on_rim")
    )
    return verdict.where("inside OR (on_shared AND NOT on_rim)").select(F.col("_point").alias(point), poly)


def join_within(points: DataFrame, point: str, polygons: DataFrame, poly: str, **options) -> DataFrame:
    """Left join: ``points`` plus the id of each polygon they lie in, null where there is none.

    Overlapping polygons give several rows for a point.
    """
    return points.join(within_pairs(points, point, polygons, poly, **options), point, "left")


def outside_of(points: DataFrame, point: str, polygons: DataFrame, poly: str, **options) -> DataFrame:
    """Points that lie in none of the polygons; points without coordinates are among them."""
    inside = within_pairs(points, point, polygons, poly, **options).select(point).distinct()
    return points.join(inside, point, "left_anti")
