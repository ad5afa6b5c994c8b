"""Location, region, station, zone and boundary dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.geometry import CRS, reprojected, wkt_parts, wkt_point, wkt_rectangle
from tripmill.functions.places import geojson_point, hash_id, point_text
from tripmill.functions.typing import cast_double
from tripmill.operators.checks import crs_rows, require_none, require_rows
from tripmill.operators.overlay import dissolve
from tripmill.operators.slices import numbered
from tripmill.operators.spatial import outside_of, polygon_areas, within_pairs
from tripmill.operators.upsert import upsert
from tripmill.session import stored

PICKUP = "pickup_centroid_location"
DROPOFF = "dropoff_centroid_location"

# The weather stations.
STATIONS = [
    ("Estacion_A", -87.655, 41.970),
    ("Estacion_B", -87.755, 41.970),
    ("Estacion_C", -87.580, 41.790),
    ("Estacion_D", -87.670, 41.750),
]


# -- trip locations -----------------------------------------------------------------------------


def stacked_centroids(trips: DataFrame, pickup: str = PICKUP, dropoff: str = DROPOFF, form: str = "text") -> DataFrame:
    """Distinct centroid texts of both columns; a column that is absent counts as empty."""
    present = [c for c in (pickup, dropoff) if c in trips.columns]
    if not present:
        raise ValueError(f"neither {pickup} nor {dropoff} is a column")
    texts = F.explode(F.array(*[point_text(F.col(c), form) for c in present]))
    return trips.select(texts.alias("original_text")).where("original_text IS NOT NULL").distinct()


def _described(texts: DataFrame, id_len: int) -> DataFrame:
    rows = texts.select(
        hash_id(F.col("original_text"), id_len).alias("location_id"),
        "original_text",
        geojson_point(F.col("original_text")).alias("at"),
    ).select(
        "location_id",
        "original_text",
        F.col("at.lon").alias("longitude"),
        F.col("at.lat").alias("latitude"),
        F.lit("census_centroid").alias("source_type"),
    )
    # One row per id, as shortened ids of two texts can be equal: the smallest text stays.
    columns = [c for c in rows.columns if c not in ("location_id", "original_text")]
    row = F.struct("original_text", *columns)
    return rows.groupBy("location_id").agg(F.min_by(row, "original_text").alias("row")).select("location_id", "row.*")


def locations_build(
    trips: DataFrame, pickup: str = PICKUP, dropoff: str = DROPOFF, id_len: int = 16, form: str = "text"
) -> DataFrame:
    return _described(stacked_centroids(trips, pickup, dropoff, form), id_len)


def locations_update(
    existing: DataFrame, trips: DataFrame, pickup: str = PICKUP, dropoff: str = DROPOFF, id_len: int = 16, form: str = "text"
) -> DataFrame:
    """Existing rows as they are, plus the texts not seen before; an id already taken stays."""
    unseen = stacked_centroids(trips, pickup, dropoff, form).join(existing.select("original_text"), "original_text", "left_anti")
    added = _described(unseen, id_len).join(existing.select("location_id"), "location_id", "left_anti")
    return existing.unionByName(added, allowMissingColumns=True)


def location_dimension(
    prior: DataFrame | None, trips: DataFrame, strategy: str = "incremental", **options
) -> DataFrame:
    """``rebuild`` ignores the prior dimension; ``incremental`` extends it if there is one."""
    if strategy not in ("rebuild", "incremental"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "rebuild" or prior is None:
        return locations_build(trips, **options)
    return locations_update(prior, trips, **options)


def map_location_keys(
    trips: DataFrame, locations: DataFrame, pickup: str = PICKUP, dropoff: str = DROPOFF, form: str = "text"
) -> DataFrame:
    """Centroid texts replaced by location ids; a text the dimension does not hold gives null."""
    out = trips
    for text, key in ((pickup, "pickup_location_id"), (dropoff, "dropoff_location_id")):
        ids = locations.select(F.col("original_text").alias("_text"), F.col("location_id").alias(key))
        out = out.withColumn("_text", point_text(F.col(text), form)).join(ids, "_text", "left").drop("_text", text)
    return out


def hash_location_keys(trips: DataFrame, pickup: str = PICKUP, dropoff: str = DROPOFF, form: str = "text") -> DataFrame:
    """The same ids without a join, when every text is known to be in the dimension."""
    return trips.withColumns(
        {
            "pickup_location_id": hash_id(point_text(F.col(pickup), form)),
            "dropoff_location_id": hash_id(point_text(F.col(dropoff), form)),
        }
    ).drop(pickup, dropoff)


# -- traffic regions ----------------------------------------------------------------------------


def regions_build(traffic: DataFrame) -> DataFrame:
    """One rectangle per region; rows with a box limit that is not a number are left out.

    A region reported with two boxes keeps the smallest by (west, south, east, north).
    """
    box = [cast_double(F.col(c)).alias(c) for c in ("west", "east", "south", "north")]
    distinct = traffic.select("region_id", "region", *box).na.drop(subset=["west", "east", "south", "north"])
    least = F.min(F.struct("west", "south", "east", "north", "region")).alias("b")
    return (
        distinct.groupBy("region_id")
        .agg(least)
        .select("region_id", "b.region", "b.west", "b.east", "b.south", "b.north")
        .withColumn("geometry_wkt", wkt_rectangle(F.col("west"), F.col("south"), F.col("east"), F.col("north")))
    )


def regions_update(existing: DataFrame, traffic: DataFrame) -> DataFrame:
    """Existing regions as they are, plus those not seen before."""
    new = regions_build(traffic).join(existing.select("region_id"), "region_id", "left_anti")
    return existing.unionByName(new, allowMissingColumns=True)


def region_dimension(prior: DataFrame | None, traffic: DataFrame, strategy: str = "incremental") -> DataFrame:
    if strategy not in ("rebuild", "incremental"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "rebuild" or prior is None:
        return regions_build(traffic)
    return regions_update(prior, traffic)


def regions_export(regions: DataFrame, batch_id: str | None) -> DataFrame:
    """The dimension as it is stored, with the area of each region in square kilometres."""
    return regions.join(polygon_areas(regions, "region_id"), "region_id", "left").select(
        "region_id", "region", "west", "east", "south", "north", "geometry_wkt",
        F.bround("km2", 2).alias("area_km2"), F.lit(batch_id).cast("string").alias("batch_id"), F.lit(CRS).alias("crs"),
    )


# -- stations, zones, boundary --------------------------------------------------------------------


def default_stations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATIONS, "station_id string, longitude double, latitude double")


def stations_table(points: DataFrame) -> DataFrame:
    """Station rows of ``station_id, longitude, latitude``."""
    return points.select(
        "station_id",
        F.col("station_id").alias("station_name"),
        F.col("longitude").cast("decimal(10,7)").alias("longitude"),
        F.col("latitude").cast("decimal(10,7)").alias("latitude"),
        wkt_point(F.col("longitude"), F.col("latitude")).alias("geometry_wkt"),
        F.lit(CRS).alias("crs"),
    )


def zones_table(zones: DataFrame) -> DataFrame:
    """Zones numbered by station id, the area as a two-place decimal."""
    return numbered(zones, "station_id", "zone_id").select(
        F.col("zone_id").cast("int").alias("zone_id"), "station_id", "geometry_wkt", F.col("area_km2").cast("decimal(10,2)").alias("area_km2"), "crs"
    )


def stations_with_zones(stations: DataFrame, zones: DataFrame) -> DataFrame:
    z = zones.select("station_id", "zone_id", F.col("geometry_wkt").alias("zone_geometry"), "area_km2")
    s = stations.withColumnRenamed("geometry_wkt", "station_geometry").drop("crs", "updated_at")
    return s.join(z, "station_id", "left")


def city_boundary_table(polygons: DataFrame, city_name: str = "Chicago", source_url: str | None = None) -> DataFrame:
    """One row: the union of all landed polygons as one geometry without inner edges, with its area.

    ``polygons`` is the boundary as landed, rows of ``geometry_wkt``; they may touch and overlap.
    """
    landed = polygons.where(F.size(wkt_parts("geometry_wkt")) > 0).withColumn("boundary_id", F.lit(1))
    require_rows(landed, "city boundary")
    whole = stored(dissolve(landed, "boundary_id"), "boundary")
    area = polygon_areas(whole, "boundary_id").select("boundary_id", F.bround("km2", 2).cast("decimal(10,2)").alias("area_km2"))
    return whole.join(area, "boundary_id").select(
        "boundary_id",
        F.lit(city_name).alias("city_name"),
        "geometry_wkt",
        "area_km2",
        F.lit(CRS).alias("crs"),
        F.lit(source_url).cast("string").alias("source_url"),
    )


# -- locations against regions, zones and the boundary ----------------------------------------------


def require_crs(*tables: DataFrame) -> None:
    """All coordinates are EPSG:4326."""
    for t in tables:
        if "crs" in t.columns:
            require_none(crs_rows(t, CRS), f"crs is not {CRS}")


def in_degrees(*tables: DataFrame) -> list[DataFrame]:
    """The tables with all geometries in EPSG:4326: those in EPSG:26916 are re-projected, any other system is refused."""
    out = []
    for t in tables:
        if "crs" in t.columns and not crs_rows(t, CRS).isEmpty():
            # Stored: the formula is long, and lookups read their polygons several times.
            t = stored(reprojected(t), "degrees")
            require_crs(t)
        out.append(t)
    return out


def map_locations(locations: DataFrame, regions: DataFrame, zones: DataFrame) -> DataFrame:
    """``location_id, region_id, station_id, batch_id``, one row per location.

    A location in several regions or zones takes the smallest id of each. Regions are rectangles and zones convex, as
    built here: neither has parts that touch.
    """
    region = within_pairs(locations, "location_id", regions, "region_id", simple=True).groupBy("location_id").agg(
        F.min("region_id").alias("region_id")
    )
    zone = within_pairs(locations, "location_id", zones, "station_id", simple=True).groupBy("location_id").agg(
        F.min("station_id").alias("station_id")
    )
    return (
        locations.select("location_id", "batch_id")
        .join(region, "location_id", "left")
        .join(zone, "location_id", "left")
        .select("location_id", "region_id", "station_id", "batch_id")
    )


def invalid_locations(locations: DataFrame, boundary: DataFrame) -> DataFrame:
    """Locations outside the city, on its rim, or without coordinates; the boundary is dissolved, as built here."""
    out = outside_of(locations, "location_id", boundary, "boundary_id", simple=True)
    return out.select("location_id", "batch_id", "longitude", "latitude", F.lit(CRS).alias("crs"))


def upsert_locations(stored: DataFrame, batch: DataFrame) -> DataFrame:
    return upsert(stored, batch, "location_id", ["longitude", "latitude", "source_type", "batch_id"], "coalesce")


def upsert_regions(stored: DataFrame, batch: DataFrame) -> DataFrame:
    crs = F.coalesce(F.col("crs"), F.lit(CRS)) if "crs" in batch.columns else F.lit(CRS)
    return upsert(stored, batch.withColumn("crs", crs), "region_id", ["region", "geometry_wkt", "batch_id"], "coalesce")
