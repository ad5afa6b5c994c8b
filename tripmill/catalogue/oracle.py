"""DuckDB SQL that says the same as each registered query.

Written against the given tables only. ``CTES`` holds the shared steps; ``sql`` puts the ones a
statement needs in front of it.
"""

from __future__ import annotations

import re

START, END = "TIMESTAMP '2024-01-01'", "TIMESTAMP '2024-02-01'"
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|Inf|infinity|Infinity)\s*$"


def _centroid(j: str) -> str:
    lat = f"(41660 + (({j}) * 7) % 360)"
    return (
        f"""('{{"type":"Point","coordinates":[-87.' || (900 - ({j}) % 400) || ',' || ({lat} // 1000)"""
        f""" || '.' || lpad(({lat} % 1000)::VARCHAR, 3, '0') || ']}}')"""
    )


def _lat3(expr: str) -> str:
    return f"(({expr}) // 1000) || '.' || lpad((({expr}) % 1000)::VARCHAR, 3, '0')"


def _utm(lon: str, lat: str) -> tuple[str, str]:
    """Easting and northing, GRS80, zone 16 north, by the transverse Mercator series."""
    f = 1 / 298.257222101
    n = f / (2 - f)
    radius = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    c = 2 * n**0.5 / (1 + n)
    a = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    s = f"sin(radians({lat}))"
    t = f"sinh(atanh({s}) - {c!r} * atanh({c!r} * {s}))"
    lam = f"radians(({lon}) + 87.0)"
    xi, eta = f"atan2({t}, cos({lam}))", f"atanh(sin({lam}) / sqrt(1 + {t} * {t}))"
    east = " + ".join([eta] + [f"{v!r} * cos({2*i+2} * {xi}) * sinh({2*i+2} * {eta})" for i, v in enumerate(a)])
    north = " + ".join([xi] + [f"{v!r} * sin({2*i+2} * {xi}) * cosh({2*i+2} * {eta})" for i, v in enumerate(a)])
    k = repr(0.9996 * radius)
    return f"(500000.0 + {k} * ({east}))", f"({k} * ({north}))"


def _inside(points: str, edges: str) -> str:
    """Points strictly inside the closed rings of ``edges``: odd crossings and on no edge."""
    return f"""
        SELECT p.location_id, e.poly FROM {points} p JOIN {edges} e ON p.longitude IS NOT NULL
        GROUP BY p.location_id, e.poly
        HAVING sum(CASE WHEN (e.y1 > p.latitude) <> (e.y2 > p.latitude)
                         AND p.longitude < e.x1 + (p.latitude - e.y1) / (e.y2 - e.y1) * (e.x2 - e.x1)
                        THEN 1 ELSE 0 END) % 2 = 1
           AND NOT bool_or(p.longitude BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                       AND p.latitude BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)
                       AND (e.x2 - e.x1) * (p.latitude - e.y1) - (e.y2 - e.y1) * (p.longitude - e.x1) = 0)"""


_X, _Y = _utm("longitude", "latitude")

CTES: dict[str, str] = {
    "e": "SELECT event_id AS e, user_id AS u, value AS v, ts, event_type FROM events",
    # Trips as staged, with the centroid texts.
    "centroid_trips": f"""
        SELECT sha1(e::VARCHAR) AS trip_id,
            CASE WHEN e % 101 <> 0 THEN CASE WHEN e % 2 = 0 THEN time_bucket(INTERVAL '15 minutes', ts) ELSE ts END END
                AS trip_start_timestamp,
            CASE WHEN e % 29 <> 0 THEN ts + to_microseconds(CAST(round(v * 1e7) AS BIGINT)) END AS trip_end_timestamp,
            CASE WHEN e % 103 <> 0 THEN v * 10 END AS trip_seconds,
            CASE WHEN e % 23 <> 0 THEN (e % 40) / 2.0::DOUBLE END AS trip_miles,
            CASE WHEN e % 5 = 0 THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS percent_time_chicago,
            CASE WHEN e % 3 = 0 THEN 0.9::DOUBLE ELSE 1.0::DOUBLE END AS percent_distance_chicago,
            CASE WHEN e % 17 <> 0 THEN CAST(u % 77 + 1 AS INT) END AS pickup_community_area,
            CAST((u * 3 + e) % 77 + 1 AS INT) AS dropoff_community_area,
            CASE WHEN e % 31 <> 0 AND e % 107 <> 0 THEN v / 4 END AS fare,
            (e % 7) * 0.5::DOUBLE AS tip,
            (e % 3) * 1.25::DOUBLE AS additional_charges,
            coalesce(CASE WHEN e % 31 <> 0 THEN v / 4 END, 0.0::DOUBLE) + (e % 7) * 0.5::DOUBLE
                + (e % 3) * 1.25::DOUBLE AS trip_total,
            CASE WHEN e % 109 <> 0 AND e % 19 <> 0 THEN e % 2 = 0 END AS shared_trip_authorized,
            CAST(e % 3 + 1 AS INT) AS trips_pooled,
            CASE WHEN e % 41 = 0 THEN 'POINT (-87.7 41.8)' WHEN e % 37 <> 0 THEN {_centroid('u')} END
                AS pickup_centroid_location,
            {_centroid('(u * 7 + e) % 1000')} AS dropoff_centroid_location,
            'b0' AS batch_id
        FROM e""",
    "staged_trips": """
        SELECT * EXCLUDE (pickup_centroid_location, dropoff_centroid_location),
            left(sha1(pickup_centroid_location), 16) AS pickup_location_id,
            left(sha1(dropoff_centroid_location), 16) AS dropoff_location_id
        FROM centroid_trips""",
    "centroid_texts": """
        SELECT DISTINCT original_text FROM (
            SELECT pickup_centroid_location AS original_text FROM centroid_trips
            UNION ALL SELECT dropoff_centroid_location FROM centroid_trips)
        WHERE original_text IS NOT NULL""",
    "locations": """
        SELECT left(sha1(original_text), 16) AS location_id, original_text,
            CASE WHEN original_text LIKE '{%' THEN CAST(json_extract(original_text, '$.coordinates[0]') AS DOUBLE) END
                AS longitude,
            CASE WHEN original_text LIKE '{%' THEN CAST(json_extract(original_text, '$.coordinates[1]') AS DOUBLE) END
                AS latitude,
            'census_centroid' AS source_type, 'b0' AS batch_id
        FROM centroid_texts""",
    "raw_traffic": f"""
        SELECT e::VARCHAR AS record_id,
            CASE WHEN e % 113 <> 0 THEN CASE WHEN e % 2 = 0 THEN time_bucket(INTERVAL '10 minutes', ts) ELSE ts END END AS time,
            CAST(u % 29 + 1 AS INT) AS region_id,
            CASE WHEN e % 127 <> 0 THEN v END AS speed,
            'Region ' || (u % 29 + 1) AS region,
            CAST(round_even((e % 50) + CASE WHEN e % 3 = 0 THEN 0.5 ELSE 0 END, 0) AS INT) AS bus_count,
            CAST(e % 500 AS INT) AS num_reads,
            CASE WHEN e % 97 <> 0 THEN CAST('-87.' || (900 - 70 * ((u % 29) % 6)) AS DOUBLE) END AS west,
            CAST('-87.' || (900 - 70 * ((u % 29) % 6 + 1)) AS DOUBLE) AS east,
            CAST({_lat3('41660 + 70 * ((u % 29) // 6)')} AS DOUBLE) AS south,
            CAST({_lat3('41660 + 70 * ((u % 29) // 6 + 1)')} AS DOUBLE) AS north
        FROM e WHERE event_type = 'error'""",
    "traffic": """
        SELECT record_id, time, region_id, speed, region, bus_count, num_reads, 'b0' AS batch_id FROM raw_traffic""",
    "regions": """
        SELECT DISTINCT region_id, region, west, east, south, north,
            format('POLYGON (({0} {1}, {2} {1}, {2} {3}, {0} {3}, {0} {1}))',
                west::VARCHAR, south::VARCHAR, east::VARCHAR, north::VARCHAR) AS geometry_wkt
        FROM raw_traffic WHERE west IS NOT NULL""",
    "weather": """
        SELECT s || '_' || CAST(d AS VARCHAR) AS record_id, CAST(d AS TIMESTAMP) AS datetime, s AS station_id,
            temp, feelslike, precipprob, CAST(windspeed AS VARCHAR) AS windspeed, winddir, conditions, 'b0' AS batch_id
        FROM (SELECT 'Estacion_' || substr('ABCD', CAST(u % 4 + 1 AS INT), 1) AS s, CAST(ts AS DATE) AS d,
                max(v) AS temp, min(v) AS feelslike, CAST(count(*) % 100 AS DOUBLE) AS precipprob,
                (count(*) % 300) / 10.0::DOUBLE AS windspeed, CAST(count(*) * 7 % 360 AS DOUBLE) AS winddir,
                CASE WHEN count(*) % 2 = 0 THEN 'Clear' ELSE 'Rain, Partially cloudy' END AS conditions
            FROM e GROUP BY 1, 2)""",
    # Outline of the city: the two halves as one rectangle, the hole, the wedge.
    "city_edges": """
        SELECT 1 AS poly, * FROM (VALUES
            (-87.86::DOUBLE, 41.69::DOUBLE, -87.7::DOUBLE, 41.69::DOUBLE), (-87.7, 41.69, -87.52, 41.69),
            (-87.52, 41.69, -87.52, 41.99), (-87.52, 41.99, -87.7, 41.99), (-87.7, 41.99, -87.86, 41.99),
            (-87.86, 41.99, -87.86, 41.69),
            (-87.8, 41.85, -87.76, 41.85), (-87.76, 41.85, -87.76, 41.88), (-87.76, 41.88, -87.8, 41.88),
            (-87.8, 41.88, -87.8, 41.85),
            (-87.9, 41.68, -87.87, 41.68), (-87.87, 41.68, -87.885, 41.72), (-87.885, 41.72, -87.9, 41.68)
        ) t(x1, y1, x2, y2)""",
    "in_city": _inside("locations", "city_edges"),
    "invalid": """
        SELECT location_id, longitude, latitude, 'EPSG:4326' AS crs, batch_id FROM locations
        WHERE location_id NOT IN (SELECT location_id FROM in_city)""",
    "stations": f"""
        SELECT station_id, {_X} AS x, {_Y} AS y FROM (VALUES
            ('Estacion_A', -87.655::DOUBLE, 41.970::DOUBLE), ('Estacion_B', -87.755, 41.970),
            ('Estacion_C', -87.580, 41.790), ('Estacion_D', -87.670, 41.750)) t(station_id, longitude, latitude)""",
    "point_region": """
        SELECT l.location_id, min(r.region_id) AS region_id FROM locations l LEFT JOIN regions r
            ON l.longitude > r.west AND l.longitude < r.east AND l.latitude > r.south AND l.latitude < r.north
        GROUP BY l.location_id""",
    # A point is in the zone of the station nearest to it in metres.
    "point_zone": f"""
        SELECT l.location_id,
            CASE WHEN l.longitude IS NOT NULL THEN arg_min(s.station_id, sqrt((l.x - s.x) ** 2 + (l.y - s.y) ** 2)) END
                AS station_id
        FROM (SELECT *, {_X} AS x, {_Y} AS y FROM locations) l CROSS JOIN stations s
        GROUP BY l.location_id, l.longitude""",
    "mapped": """
        SELECT l.location_id, r.region_id, z.station_id, l.batch_id
        FROM locations l JOIN point_region r USING (location_id) JOIN point_zone z USING (location_id)""",
    "good_trips": f"""
        SELECT * FROM staged_trips
        WHERE trip_start_timestamp >= {START} AND trip_start_timestamp < {END}
            AND fare IS NOT NULL AND fare > 0 AND trip_seconds > 60
            AND pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL""",
    "fact_trips": """
        SELECT * REPLACE (CAST(round_even(trip_seconds, 0) AS INT) AS trip_seconds),
            CASE WHEN trip_miles > 0 THEN fare / trip_miles ELSE 0 END AS rate_per_mile,
            trip_seconds / 60.0::DOUBLE AS duration_minutes
        FROM good_trips t
        WHERE NOT EXISTS (SELECT 1 FROM invalid i WHERE i.location_id = t.pickup_location_id)
          AND NOT EXISTS (SELECT 1 FROM invalid i WHERE i.location_id = t.dropoff_location_id)""",
    "fact_traffic": f"SELECT * EXCLUDE (region) FROM traffic WHERE time >= {START} AND time < {END}",
    "fact_weather": f"SELECT * FROM weather WHERE datetime >= {START} AND datetime < {END}",
    "enriched": """
        SELECT t.trip_id, t.trip_start_timestamp, t.pickup_location_id,
            a.region_id AS pickup_traffic_region_id, a.speed AS traffic_speed, a.num_reads AS traffic_num_reads,
            w.station_id AS pickup_weather_station_id, w.temp AS weather_temp, w.feelslike AS weather_feelslike,
            w.windspeed AS weather_windspeed, w.conditions AS weather_conditions
        FROM fact_trips t LEFT JOIN mapped m ON t.pickup_location_id = m.location_id
        LEFT JOIN LATERAL (
            SELECT * FROM fact_traffic f WHERE f.region_id = m.region_id
            ORDER BY abs(epoch_us(t.trip_start_timestamp) - epoch_us(f.time)), f.time, f.record_id LIMIT 1) a ON TRUE
        LEFT JOIN LATERAL (
            SELECT * FROM fact_weather f WHERE f.station_id = m.station_id
            ORDER BY abs(epoch_us(t.trip_start_timestamp) - epoch_us(f.datetime)), f.datetime, f.record_id LIMIT 1) w
            ON TRUE""",
    "windowed": """
        SELECT *,
            count(*) OVER (ORDER BY trip_start_timestamp NULLS LAST
                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_started,
            count(*) OVER (ORDER BY trip_end_timestamp NULLS LAST
                RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '1 second' PRECEDING) AS n_ended,
            count(*) OVER (PARTITION BY pickup_location_id ORDER BY trip_start_timestamp
                RANGE BETWEEN INTERVAL '30 minutes' PRECEDING AND INTERVAL '1 second' PRECEDING) AS n_recent
        FROM fact_trips""",
    "ml_base": """
        SELECT w.trip_id, w.trip_start_timestamp, w.trip_end_timestamp, w.rate_per_mile, w.fare, w.duration_minutes,
            w.trip_miles, w.trip_total,
            CAST(extract(hour FROM w.trip_start_timestamp) AS INT) AS start_hour,
            CAST(extract(dow FROM w.trip_start_timestamp) AS INT) AS day_of_week,
            CAST(extract(month FROM w.trip_start_timestamp) AS INT) AS month_of_trip,
            w.pickup_location_id, w.dropoff_location_id, w.pickup_community_area, w.dropoff_community_area,
            n.traffic_speed AS pickup_traffic_speed, n.traffic_num_reads AS pickup_traffic_num_reads,
            n.weather_temp AS pickup_weather_temp, n.weather_feelslike AS pickup_weather_feelslike,
            n.weather_windspeed AS pickup_weather_windspeed, n.weather_conditions AS pickup_weather_conditions,
            w.n_started - w.n_ended AS active_trips_total, w.n_recent AS trips_from_pickup_loc_last_30m
        FROM windowed w LEFT JOIN enriched n ON w.trip_id = n.trip_id""",
    "sites": """
        SELECT s_name AS station_id,
            CASE WHEN s_suppkey % 50 <> 49 THEN round(-87.9::DOUBLE + (s_suppkey * 37 % 1009) / 2500.0::DOUBLE, 6) END AS longitude,
            CASE WHEN s_suppkey % 50 <> 49 THEN round(41.66::DOUBLE + (s_suppkey * 101 % 997) / 2700.0::DOUBLE, 6) END AS latitude
        FROM supplier""",
}


def sql(statement: str, **override: str) -> str:
    """``statement`` after the CTEs it needs; ``override`` replaces the text of some of them."""
    ctes = {**CTES, **override}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\b\w+\b", text)):
            if word in ctes and word not in needed:
                needed.add(word)
                visit(ctes[word])

    visit(statement)
    head = ",\n".join(f"{name} AS ({text})" for name, text in ctes.items() if name in needed)
    return f"WITH {head}\n{statement}" if needed else statement
