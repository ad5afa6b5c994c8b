"""Columns and types of every table."""

from __future__ import annotations

# Fixed values, here and below: names, types and order of columns.
# Raw feeds: column -> kind understood by ``cast_frame``. The order is the order of the extract.
TRIPS = {
    "trip_id": "string",
    "batch_id": "string",
    "trip_start_timestamp": "timestamp",
    "trip_end_timestamp": "timestamp",
    "pickup_community_area": "int",
    "dropoff_community_area": "int",
    "trips_pooled": "int",
    "trip_seconds": "double",
    "trip_miles": "double",
    "percent_time_chicago": "double",
    "percent_distance_chicago": "double",
    "fare": "double",
    "tip": "double",
    "additional_charges": "double",
    "trip_total": "double",
    "shared_trip_authorized": "boolean",
    "pickup_centroid_location": "string",
    "dropoff_centroid_location": "string",
}
TRAFFIC = {
    "time": "timestamp",
    "region_id": "int",
    "bus_count": "int",
    "num_reads": "int",
    "region": "string",
    "record_id": "string",
    "batch_id": "string",
    "speed": "double",
}
WEATHER = {
    "record_id": "string",
    "datetime": "timestamp",
    "station_id": "string",
    "temp": "double",
    "feelslike": "double",
    "precipprob": "double",
    "windspeed": "double",
    "winddir": "string",
    "conditions": "string",
    "batch_id": "string",
}
# Landed but not kept with the traffic readings: the box of the region.
TRAFFIC_BOX = ["west", "east", "south", "north"]

DAY = "event_date"  # partition column of the big tables

# Tables: Spark DDL. ``event_date`` is the day of the event time.
TABLES = {
    "staging.stg_raw_trips": """
        trip_id STRING, trip_start_timestamp TIMESTAMP_NTZ, trip_end_timestamp TIMESTAMP_NTZ,
        trip_seconds DOUBLE, trip_miles DOUBLE, percent_time_chicago DOUBLE,
        percent_distance_chicago DOUBLE, pickup_community_area INT, dropoff_community_area INT,
        fare DOUBLE, tip DOUBLE, additional_charges DOUBLE, trip_total DOUBLE,
        shared_trip_authorized BOOLEAN, trips_pooled INT, pickup_location_id STRING,
        dropoff_location_id STRING, created_at TIMESTAMP, batch_id STRING, event_date DATE""",
    "staging.stg_raw_traffic": """
        record_id STRING, time TIMESTAMP_NTZ, speed DOUBLE, region_id INT, region STRING,
        bus_count INT, num_reads INT, created_at TIMESTAMP, batch_id STRING, event_date DATE""",
    "staging.stg_raw_weather": """
        record_id STRING, datetime TIMESTAMP_NTZ, station_id STRING, temp DOUBLE, feelslike DOUBLE,
        precipprob DOUBLE, windspeed STRING, winddir DOUBLE, conditions STRING,
        created_at TIMESTAMP, batch_id STRING, event_date DATE""",
    "fact_tables.fact_trips": """
        trip_id STRING, trip_start_timestamp TIMESTAMP_NTZ, trip_end_timestamp TIMESTAMP_NTZ,
        trip_seconds INT, trip_miles DOUBLE, percent_time_chicago DOUBLE,
        percent_distance_chicago DOUBLE, pickup_community_area INT, dropoff_community_area INT,
        fare DOUBLE, tip DOUBLE, additional_charges DOUBLE, trip_total DOUBLE,
        shared_trip_authorized BOOLEAN, trips_pooled INT, pickup_location_id STRING,
        dropoff_location_id STRING, rate_per_mile DOUBLE, duration_minutes DOUBLE,
        created_at TIMESTAMP, batch_id STRING, event_date DATE""",
    "fact_tables.fact_traffic": """
        record_id STRING, time TIMESTAMP_NTZ, region_id INT, speed DOUBLE, bus_count INT,
        num_reads INT, created_at TIMESTAMP, batch_id STRING, event_date DATE""",
    "fact_tables.fact_weather": """
        record_id STRING, datetime TIMESTAMP_NTZ, station_id STRING, temp DOUBLE, feelslike DOUBLE,
        precipprob DOUBLE, windspeed STRING, winddir DOUBLE, conditions STRING,
        created_at TIMESTAMP, batch_id STRING, event_date DATE""",
    "dim_spatial.trips_locations": """
        location_id STRING, original_text STRING, longitude DOUBLE, latitude DOUBLE,
        source_type STRING, created_at TIMESTAMP, updated_at TIMESTAMP, batch_id STRING""",
    "dim_spatial.traffic_regions": """
        region_id INT, region STRING, west DOUBLE, east DOUBLE, south DOUBLE, north DOUBLE,
        geometry_wkt STRING, area_km2 DOUBLE, crs STRING, created_at TIMESTAMP,
        updated_at TIMESTAMP, batch_id STRING""",
    "dim_spatial.invalid_locations": """
        location_id STRING, batch_id STRING, longitude DOUBLE, latitude DOUBLE, crs STRING,
        created_at TIMESTAMP""",
    "dim_spatial.mapped_locations": """
        location_id STRING, region_id INT, station_id STRING, batch_id STRING,
        created_at TIMESTAMP, updated_at TIMESTAMP""",
    "dim_spatial.weather_stations_points": """
        station_id STRING, station_name STRING, longitude DECIMAL(10,7), latitude DECIMAL(10,7),
        geometry_wkt STRING, crs STRING, created_at TIMESTAMP, updated_at TIMESTAMP""",
    "dim_spatial.weather_voronoi_zones": """
        zone_id INT, station_id STRING, geometry_wkt STRING, area_km2 DECIMAL(10,2), crs STRING,
        created_at TIMESTAMP""",
    "dim_spatial.chicago_city_boundary": """
        boundary_id INT, city_name STRING, geometry_wkt STRING, area_km2 DECIMAL(10,2), crs STRING,
        source_url STRING, created_at TIMESTAMP""",
    "datamarts.dm_trips_hourly_pickup_stats": """
        trip_hour TIMESTAMP_NTZ, pickup_community_area INT, total_trips BIGINT,
        avg_rate_per_mile DOUBLE, avg_duration_minutes DOUBLE""",
    "datamarts.fact_trips_with_traffic_weather": """
        trip_id STRING, trip_start_timestamp TIMESTAMP_NTZ, pickup_location_id STRING,
        pickup_traffic_region_id INT, traffic_speed DOUBLE, traffic_num_reads INT,
        pickup_weather_station_id STRING, weather_temp DOUBLE, weather_feelslike DOUBLE,
        weather_windspeed STRING, weather_conditions STRING""",
    "datamarts.ml_base_table": """
        trip_id STRING, trip_start_timestamp TIMESTAMP_NTZ, trip_end_timestamp TIMESTAMP_NTZ,
        rate_per_mile DOUBLE, fare DOUBLE, duration_minutes DOUBLE, trip_miles DOUBLE,
        trip_total DOUBLE, start_hour INT, day_of_week INT, month_of_trip INT,
        pickup_location_id STRING, dropoff_location_id STRING, pickup_community_area INT,
        dropoff_community_area INT, pickup_traffic_speed DOUBLE, pickup_traffic_num_reads INT,
        pickup_weather_temp DOUBLE, pickup_weather_feelslike DOUBLE,
        pickup_weather_windspeed STRING, pickup_weather_conditions STRING,
        active_trips_total BIGINT, trips_from_pickup_loc_last_30m BIGINT""",
}

# The event time that ``event_date`` is the day of.
EVENT_TIME = {
    "staging.stg_raw_trips": "trip_start_timestamp",
    "staging.stg_raw_traffic": "time",
    "staging.stg_raw_weather": "datetime",
    "fact_tables.fact_trips": "trip_start_timestamp",
    "fact_tables.fact_traffic": "time",
    "fact_tables.fact_weather": "datetime",
}

KEYS = {
    "staging.stg_raw_trips": ["trip_id"],
    "staging.stg_raw_traffic": ["record_id"],
    "staging.stg_raw_weather": ["record_id"],
    "fact_tables.fact_trips": ["trip_id"],
    "fact_tables.fact_traffic": ["record_id"],
    "fact_tables.fact_weather": ["record_id"],
    "dim_spatial.trips_locations": ["location_id"],
    "dim_spatial.traffic_regions": ["region_id"],
    "dim_spatial.invalid_locations": ["location_id"],
    "dim_spatial.mapped_locations": ["location_id"],
    "dim_spatial.weather_stations_points": ["station_id"],
    "dim_spatial.weather_voronoi_zones": ["station_id"],
    "dim_spatial.chicago_city_boundary": ["boundary_id"],
    "datamarts.dm_trips_hourly_pickup_stats": ["trip_hour", "pickup_community_area"],
    "datamarts.fact_trips_with_traffic_weather": ["trip_id"],
    "datamarts.ml_base_table": ["trip_id"],
}

# Views: the tables they read, and their text.
VIEWS = {
    "dim_spatial.vw_stations_with_zones": (
        ["dim_spatial.weather_stations_points", "dim_spatial.weather_voronoi_zones"],
        """SELECT s.station_id, s.station_name, s.longitude, s.latitude, s.geometry_wkt AS station_geometry,
            z.zone_id, z.geometry_wkt AS zone_geometry, z.area_km2, s.created_at
        FROM {0} s LEFT JOIN {1} z ON s.station_id = z.station_id""",
    ),
}

# Upserts: the columns a matched row takes from the source. The others keep their stored value.
UPDATES = {
    "fact_tables.fact_trips": [
        "trip_start_timestamp", "trip_end_timestamp", "trip_seconds", "trip_miles", "fare", "tip",
        "trip_total", "shared_trip_authorized", "trips_pooled", "rate_per_mile", "duration_minutes",
        "batch_id", "created_at",
    ],
    "fact_tables.fact_traffic": ["speed", "bus_count", "num_reads", "batch_id", "created_at"],
    "fact_tables.fact_weather": [
        "temp", "feelslike", "precipprob", "windspeed", "winddir", "conditions", "batch_id", "created_at",
    ],
    "dim_spatial.trips_locations": ["longitude", "latitude", "source_type", "batch_id"],
    "dim_spatial.traffic_regions": ["region", "geometry_wkt", "batch_id"],
}
