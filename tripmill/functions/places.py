"""Identifiers and coordinates of trip locations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT_SCHEMA = "type string, coordinates array<double>"


def hash_id(text: Column, length: int = 16) -> Column:
    """First ``length`` hex characters of the SHA-1 of the text."""
    return F.substring(F.sha1(text.cast("string")), 1, length)


def geojson_point(text: Column) -> Column:
    """Struct ``(lon, lat)`` of a GeoJSON point; both null for anything else.

    Single-quoted text is read as well. WKT and other geometry types give nulls.
    """
    parsed = F.from_json(F.when(text.rlike(r"(?s)^\s*\{.*\}\s*$"), text), POINT_SCHEMA)
    good = (F.lower(parsed["type"]) == "point") & (F.size(parsed["coordinates"]) >= 2)
    return F.struct(
        F.when(good, F.get(parsed["coordinates"], 0)).alias("lon"),
        F.when(good, F.get(parsed["coordinates"], 1)).alias("lat"),
    )


def point_text(text: Column, form: str = "text") -> Column:
    """The spelling of a centroid that its id is computed from.

    ``text`` keeps the landed spelling. ``json`` and ``repr`` re-write a readable point with fixed
    spacing, double-quoted or single-quoted, so that spacing differences do not make new ids.
    """
    if form == "text":
        return text
    point = geojson_point(text)
    shapes = {
        "json": ('{{"type":"Point","coordinates":[', ",", "]}}"),
        "repr": ("{{'type': 'Point', 'coordinates': [", ", ", "]}}"),
    }
    head, comma, tail = (s.replace("{{", "{").replace("}}", "}") for s in shapes[form])
    rewritten = F.concat(
        F.lit(head), point["lon"].cast("string"), F.lit(comma), point["lat"].cast("string"), F.lit(tail)
    )
    return F.coalesce(rewritten, text)


def record_key(station: Column, when: Column) -> Column:
    return F.concat_ws("_", station, when.cast("string"))


def latlon_text(lat: Column, lon: Column) -> Column:
    return F.concat_ws(",", lat.cast("string"), lon.cast("string"))
