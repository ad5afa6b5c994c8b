"""Polygons as text and as arrays, and the UTM-16N projection.

A *ring* is an array of ``(x, y)`` structs, closed (last point equals first). A geometry is an
array of parts; a part is an array of rings, the shell first and its holes after it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRS = "EPSG:4326"

# GRS80 ellipsoid and UTM zone 16 north.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
SCALE = 0.9996
FALSE_EASTING = 500000.0
CENTRAL_MERIDIAN = -87.0

_n = FLATTENING / (2 - FLATTENING)
_RADIUS = SEMI_MAJOR / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
_ECC = 2 * math.sqrt(_n) / (1 + _n)
# Krueger's series to third order in the third flattening (Karney 2011, eqs. 35, 36; Kawase 2011).
_ALPHA = (
    _n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16,
    13 * _n**2 / 48 - 3 * _n**3 / 5,
    61 * _n**3 / 240,
)
_BETA = (
    _n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96,
    _n**2 / 48 + _n**3 / 15,
    17 * _n**3 / 480,
)
_DELTA = (
    2 * _n - 2 * _n**2 / 3 - 2 * _n**3,
    7 * _n**2 / 3 - 8 * _n**3 / 5,
    56 * _n**3 / 15,
)


def utm16n_sql(lon: str, lat: str) -> str:
    """Struct ``(x, y)`` in metres of two expressions in degrees, as SQL text: it is one formula."""
    sin_phi = f"sin(radians({lat}))"
    t = f"sinh(atanh({sin_phi}) - {_ECC!r}D * atanh({_ECC!r}D * {sin_phi}))"
    lam = f"radians({lon} - ({CENTRAL_MERIDIAN}D))"
    xi = f"atan2({t}, cos({lam}))"
    eta = f"atanh(sin({lam}) / sqrt(1 + {t} * {t}))"
    east = " + ".join([eta, *(f"{a!r}D * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, a in enumerate(_ALPHA, 1))])
    north = " + ".join([xi, *(f"{a!r}D * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, a in enumerate(_ALPHA, 1))])
    k = f"{SCALE * _RADIUS!r}D"
    return f"named_struct('x', {FALSE_EASTING}D + {k} * ({east}), 'y', {k} * ({north}))"


def utm16n(lon: str, lat: str) -> Column:
    """Struct ``(x, y)`` in metres of two columns in degrees."""
    return F.expr(utm16n_sql(lon, lat))


#: The first eccentricity of the ellipsoid.
_E = math.sqrt(FLATTENING * (2 - FLATTENING))


def lonlat_sql(x: str, y: str) -> str:
    """Struct ``(x, y)`` in degrees of two expressions in metres, as SQL text: the way back from :func:`utm16n_sql`.

    The latitude comes from the conformal one by steps that each leave less than a hundredth of the error.
    """
    k = f"{SCALE * _RADIUS!r}D"
    xi0, eta0 = f"(({y}) / {k})", f"((({x}) - {FALSE_EASTING}D) / {k})"
    xi = " - ".join([xi0, *(f"{b!r}D * sin({2 * j} * {xi0}) * cosh({2 * j} * {eta0})" for j, b in enumerate(_BETA, 1))])
    eta = " - ".join([eta0, *(f"{b!r}D * cos({2 * j} * {xi0}) * sinh({2 * j} * {eta0})" for j, b in enumerate(_BETA, 1))])
    chi = f"(sin({xi}) / cosh({eta}))"
    level, sin_phi = f"atanh({chi})", chi
    for _ in range(6):
        sin_phi = f"tanh({level} + {_E!r}D * atanh({_E!r}D * {sin_phi}))"
    return f"named_struct('x', {CENTRAL_MERIDIAN}D + degrees(atan2(sinh({eta}), cos({xi}))), 'y', degrees(asin({sin_phi})))"


#: Degrees, and metres of UTM zone 16 north.
UTM_CRS = "EPSG:26916"


def reprojected(df: DataFrame, to: str = CRS, wkt: str = "geometry_wkt") -> DataFrame:
    """Rows with their geometry text, POINT or polygons, in the system ``to``, each from the system its ``crs`` names.

    Systems are EPSG:4326 and EPSG:26916; rows in another one have a null geometry and keep their ``crs``. Rows that are in
    ``to`` already keep their text as it is.
    """
    if to not in (CRS, UTM_CRS):
        raise ValueError(f"unknown system {to}")
    other, formula = (UTM_CRS, lonlat_sql) if to == CRS else (CRS, utm16n_sql)
    move = formula("p.x", "p.y")
    form = r"r'(?i)^\s*POINT\s*\(\s*([^\s()]+)\s+([^\s()]+)\s*\)\s*$'"
    x, y = (f"try_cast(regexp_extract({wkt}, {form}, {i}) AS DOUBLE)" for i in (1, 2))
    spot = F.expr(f"CASE WHEN {wkt} RLIKE {form} THEN array(named_struct('x', {x}, 'y', {y})) END")
    rows = df.withColumns({"_parts": wkt_parts(wkt), "_spot": spot})
    rows = rows.withColumns(
        {
            "_parts": F.expr(f"transform(_parts, part -> transform(part, ring -> transform(ring, p -> {move})))"),
            "_spot": F.expr(f"element_at(transform(_spot, p -> {move}), 1)"),
        }
    )
    point = wkt_point(F.col("_spot.x"), F.col("_spot.y"))
    moved = F.when(F.col("_parts").isNotNull(), wkt_of_parts("_parts")).when(F.col("_spot").isNotNull(), point)
    text = F.when(F.col("crs") == to, F.col(wkt)).when(F.col("crs") == other, moved)
    crs = F.when(F.col("crs").isin(CRS, UTM_CRS), F.lit(to)).otherwise(F.col("crs"))
    return rows.withColumns({wkt: text, "crs": crs}).drop("_parts", "_spot")


def lonlat_from_utm16n(x: float, y: float) -> tuple[float, float]:
    """Inverse of :func:`utm16n` for one point; used on the few corners of a zone."""
    xi0, eta0 = y / (SCALE * _RADIUS), (x - FALSE_EASTING) / (SCALE * _RADIUS)
    xi, eta = xi0, eta0
    for j, b in enumerate(_BETA, start=1):
        xi -= b * math.sin(2 * j * xi0) * math.cosh(2 * j * eta0)
        eta -= b * math.cos(2 * j * xi0) * math.sinh(2 * j * eta0)
    chi = math.asin(math.sin(xi) / math.cosh(eta))
    phi = chi + sum(d * math.sin(2 * j * chi) for j, d in enumerate(_DELTA, start=1))
    lam = math.atan2(math.sinh(eta), math.cos(xi))
    return CENTRAL_MERIDIAN + math.degrees(lam), math.degrees(phi)


def wkt_point(lon: Column, lat: Column) -> Column:
    return F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def wkt_rectangle(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Corners in the order SW, SE, NE, NW, SW."""

    def corner(x: Column, y: Column) -> Column:
        return F.concat_ws(" ", x.cast("string"), y.cast("string"))

    corners = [corner(west, south), corner(east, south), corner(east, north), corner(west, north), corner(west, south)]
    return F.when(
        west.isNotNull() & south.isNotNull() & east.isNotNull() & north.isNotNull(),
        F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *corners), F.lit("))")),
    )


def wkt_parts(wkt: str) -> Column:
    """Geometry array of a column of POLYGON or MULTIPOLYGON text; null for other text."""
    xy = r"split(trim(p), r'\s+')"
    point = f"named_struct('x', try_cast(get({xy}, 0) AS DOUBLE), 'y', try_cast(get({xy}, 1) AS DOUBLE))"
    rings = r"regexp_extract_all(concat('(', part, ')'), r'\(([^()]+)\)', 1)"
    part = f"transform({rings}, ring -> transform(split(ring, ','), p -> {point}))"
    body = rf"CASE WHEN {wkt} RLIKE r'(?i)^\s*(MULTI)?POLYGON\s*\(' THEN {wkt} END"
    return F.expr(rf"transform(split({body}, r'\)\s*\)\s*,\s*\(\s*\('), part -> {part})")


def ring_edges(ring: str) -> Column:
    return F.expr(
        f"transform(slice({ring}, 2, size({ring}) - 1), (p, i) -> named_struct("
        f"'x1', get({ring}, i).x, 'y1', get({ring}, i).y, 'x2', p.x, 'y2', p.y))"
    )


def wkt_of_parts(parts: str) -> Column:
    """POLYGON text for one part, MULTIPOLYGON text for several."""
    ring = "concat('(', array_join(transform(ring, p -> concat(p.x, ' ', p.y)), ', '), ')')"
    part = f"concat('(', array_join(transform(part, ring -> {ring}), ', '), ')')"
    body = f"array_join(transform({parts}, part -> {part}), ', ')"
    return F.expr(f"CASE WHEN size({parts}) = 1 THEN concat('POLYGON ', {body}) ELSE concat('MULTIPOLYGON (', {body}, ')') END")
