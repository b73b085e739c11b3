"""SQL that computes each registered query from the given tables, for comparison.

The common tables below (``raw``, ``fact``, the dimensions, ``star`` ...) are prepended
as needed; surrogates are row numbers in natural-key order, as after one initial load.
"""

from __future__ import annotations

import re

RAW_COLUMNS = """source_shipment_id, company_name, industry, customer_country, customer_city,
  segment, contract_type, driver_name, license_type, experience_years, driver_rating,
  driver_country, plate_number, vehicle_type, capacity_kg, manufacture_year, mileage_km,
  origin_city,
  origin_country, destination_city, destination_country, distance_km, region, route_type,
  scheduled_pickup, actual_pickup, scheduled_delivery, actual_delivery, planned_duration_hrs,
  actual_duration_hrs, delay_minutes, is_delayed, status, weight_kg, cost_usd,
  fuel_consumed_liters, weather_condition, temperature_celsius, wind_speed_kmh,
  traffic_congestion_ratio, traffic_condition"""

EVENT_COLUMNS = """event_id, event_type, event_timestamp, shipment_id, status, origin_city,
  destination_city, vehicle_type, weight_kg, distance_km, revenue, is_delayed, delay_hours,
  driver_rating, temperature_c, humidity_pct"""

LISTING = """shipment_id, status, is_delayed, delay_minutes, cost_usd, weight_kg, distance_km,
  full_date, month_name, year, company_name, segment, driver_name, driver_rating, vehicle_type,
  origin_city, destination_city, region, route_type"""

EXPLORER = """shipment_id, full_date, status, delay_minutes, company_name, driver_name,
  vehicle_type, origin_city, destination_city, distance_km, cost_usd, weather_condition,
  traffic_condition"""

EXTRACT = """shipment_id, status, is_delayed, delay_minutes, cost_usd, weight_kg, distance_km,
  fuel_consumed_liters, weather_condition, temperature_celsius, wind_speed_kmh,
  traffic_congestion_ratio, traffic_condition, full_date, month, month_name, quarter, year,
  weekday, is_weekend, company_name, industry, segment, driver_name, driver_rating,
  vehicle_type, origin_city, destination_city, region, route_type"""

FACT = """shipment_id, source_shipment_id, customer_id, driver_id, vehicle_id, route_id, date_id,
  raw_file, planned_duration_hrs, actual_duration_hrs, delay_minutes, distance_km, weight_kg,
  cost_usd, fuel_consumed_liters, weather_condition, temperature_celsius, wind_speed_kmh,
  traffic_congestion_ratio, traffic_condition, status, is_delayed, scheduled_pickup,
  actual_pickup, scheduled_delivery, actual_delivery"""

# name -> body; a body may use the names before it
COMMON: dict[str, str] = {
    "lines": """
      SELECT l.*, o.o_orderdate, c.*, s.*, p.*, cn.n_name AS c_nation, sn.n_name AS s_nation,
        r.r_name,
        200 + (s.s_nationkey * 97 + c.c_nationkey * 61) % 2400 AS dist,
        (l.l_orderkey * 17 + l.l_linenumber) % 100 AS w,
        20 + (l.l_partkey * 13 + l.l_suppkey) % 81 AS ratio,
        (l.l_orderkey * 7 + l.l_linenumber * 13 + l.l_partkey * 29) % 100 AS u
      FROM lineitem l
      JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN nation cn ON c.c_nationkey = cn.n_nationkey
      JOIN region r ON cn.n_regionkey = r.r_regionkey
      JOIN supplier s ON l.l_suppkey = s.s_suppkey
      JOIN nation sn ON s.s_nationkey = sn.n_nationkey
      JOIN part p ON l.l_partkey = p.p_partkey""",
    "conditions": """
      SELECT *,
        CASE WHEN w < 40 THEN 'Clear' WHEN w < 65 THEN 'Cloudy' WHEN w < 83 THEN 'Rain'
          WHEN w < 90 THEN 'Heavy Rain' WHEN w < 96 THEN 'Fog' ELSE 'Snow' END AS weather,
        CASE WHEN ratio >= 80 THEN 'LOW' WHEN ratio >= 50 THEN 'MEDIUM' ELSE 'HIGH' END AS traffic
      FROM lines""",
    "delays": """
      SELECT *, CASE WHEN late THEN 31 + (l_orderkey * 5 + l_linenumber * 11) % 300
                     ELSE (l_orderkey * 3 + l_linenumber) % 31 END AS delay
      FROM (SELECT *, u < 10
          + CASE weather WHEN 'Clear' THEN 0 WHEN 'Cloudy' THEN 2 WHEN 'Rain' THEN 10
              WHEN 'Heavy Rain' THEN 20 WHEN 'Fog' THEN 15 ELSE 25 END
          + CASE traffic WHEN 'LOW' THEN 0 WHEN 'MEDIUM' THEN 8 ELSE 18 END
          + CASE WHEN dist > 2000 THEN 10 WHEN dist > 1000 THEN 5 ELSE 0 END AS late
        FROM conditions)""",
    "timed": """
      SELECT *,
        CAST(dist / 75.0 AS DECIMAL(6,2)) AS planned,
        CAST(CAST(dist / 75.0 AS DECIMAL(6,2)) + delay / 60.0 AS DECIMAL(6,2)) AS actual,
        o_orderdate + to_minutes(CAST(360 + (l_orderkey * 11 + l_linenumber) % 720 AS BIGINT))
          AS pickup
      FROM delays""",
    "raw": """
      SELECT
        'S-' || l_orderkey || '-' || l_linenumber AS source_shipment_id,
        c_name AS company_name,
        'IND-' || (c_nationkey % 5) AS industry,
        c_nation AS customer_country,
        'CITY-' || (c_custkey % 50) AS customer_city,
        c_mktsegment AS segment,
        ['Annual', 'Monthly', 'Spot'][CAST(c_custkey % 3 AS INT) + 1] AS contract_type,
        s_name AS driver_name,
        ['B', 'C', 'CE'][CAST(s_suppkey % 3 AS INT) + 1] AS license_type,
        CAST(s_suppkey % 16 AS INT) AS experience_years,
        CAST(1 + (s_suppkey % 41) / 10.0 AS DECIMAL(3,2)) AS driver_rating,
        s_nation AS driver_country,
        'P-' || p_partkey AS plate_number,
        p_type AS vehicle_type,
        CAST(500 + p_size * 490 AS INT) AS capacity_kg,
        CAST(2005 + p_partkey % 19 AS INT) AS manufacture_year,
        CAST(5000 + (p_partkey * 137) % 300000 AS INT) AS mileage_km,
        s_nation || '-HUB' AS origin_city,
        s_nation AS origin_country,
        c_nation || '-HUB' AS destination_city,
        c_nation AS destination_country,
        CAST(dist AS INT) AS distance_km,
        r_name AS region,
        ['Road', 'Air', 'Sea'][CAST((s_nationkey + c_nationkey) % 3 AS INT) + 1] AS route_type,
        pickup AS scheduled_pickup,
        pickup + to_minutes(CAST((l_orderkey + l_linenumber * 3) % 20 AS BIGINT)) AS actual_pickup,
        pickup + to_seconds(CAST(planned * 3600 AS BIGINT)) AS scheduled_delivery,
        pickup + to_minutes(CAST((l_orderkey + l_linenumber * 3) % 20 AS BIGINT))
          + to_seconds(CAST(actual * 3600 AS BIGINT)) AS actual_delivery,
        planned AS planned_duration_hrs,
        actual AS actual_duration_hrs,
        CAST(delay AS INT) AS delay_minutes,
        late AS is_delayed,
        CASE WHEN delay > 240 THEN 'failed' WHEN late THEN 'delayed' ELSE 'on_time' END AS status,
        CAST(l_quantity * 100 AS DECIMAL(8,2)) AS weight_kg,
        CAST(l_extendedprice AS DECIMAL(10,2)) AS cost_usd,
        CAST(dist * 0.30 AS DECIMAL(8,2)) AS fuel_consumed_liters,
        weather AS weather_condition,
        CAST(((l_partkey * 7) % 500) / 10.0 - 10 AS DECIMAL(5,2)) AS temperature_celsius,
        CAST(((l_suppkey * 31 + l_linenumber * 17) % 1000) / 10.0 AS DECIMAL(6,2))
          AS wind_speed_kmh,
        CAST(ratio / 100.0 AS DECIMAL(4,2)) AS traffic_congestion_ratio,
        traffic AS traffic_condition,
        CASE WHEN o_orderdate < DATE '1999-01-01' THEN 'raw/shipments_19950101.parquet'
             ELSE 'raw/shipments_19990101.parquet' END AS raw_file,
        ROW_NUMBER() OVER (ORDER BY o_orderdate >= DATE '1999-01-01', l_orderkey, l_linenumber,
          l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_discount, l_tax,
          l_returnflag, l_linestatus) AS position,
        ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber,
          l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_discount, l_tax,
          l_returnflag, l_linestatus) AS line_position
      FROM timed""",
    "first_records": """
      SELECT * FROM raw
      QUALIFY ROW_NUMBER() OVER (PARTITION BY source_shipment_id ORDER BY position) = 1""",
    "dim_date": """
      SELECT ROW_NUMBER() OVER (ORDER BY full_date) AS date_id, full_date,
        CAST(day(full_date) AS INT) AS day, CAST(month(full_date) AS INT) AS month,
        monthname(full_date) AS month_name, CAST(quarter(full_date) AS INT) AS quarter,
        CAST(year(full_date) AS INT) AS year, dayname(full_date) AS weekday,
        isodow(full_date) >= 6 AS is_weekend
      FROM (SELECT DISTINCT CAST(scheduled_pickup AS DATE) AS full_date FROM raw)""",
    "dim_customer": """
      SELECT ROW_NUMBER() OVER (ORDER BY company_name) AS customer_id, *
      FROM (SELECT company_name, industry, customer_country AS country, customer_city AS city,
              segment, contract_type
            FROM raw
            QUALIFY ROW_NUMBER() OVER (PARTITION BY company_name ORDER BY position) = 1)""",
    "dim_driver": """
      SELECT ROW_NUMBER() OVER (ORDER BY full_name) AS driver_id, *, TRUE AS is_active
      FROM (SELECT driver_name AS full_name, license_type, experience_years,
              driver_rating AS rating, driver_country AS country
            FROM raw
            QUALIFY ROW_NUMBER() OVER (PARTITION BY driver_name ORDER BY position) = 1)""",
    "dim_vehicle": """
      SELECT ROW_NUMBER() OVER (ORDER BY plate_number) AS vehicle_id, *,
        CAST(NULL AS DATE) AS last_service_date, TRUE AS is_active
      FROM (SELECT plate_number, vehicle_type, capacity_kg, manufacture_year, mileage_km
            FROM raw
            QUALIFY ROW_NUMBER() OVER (PARTITION BY plate_number ORDER BY position) = 1)""",
    "dim_route": """
      SELECT ROW_NUMBER() OVER (ORDER BY origin_city, origin_country, destination_city,
        destination_country) AS route_id, *
      FROM (SELECT origin_city, origin_country, destination_city, destination_country,
              distance_km, region, route_type
            FROM raw QUALIFY ROW_NUMBER() OVER (PARTITION BY origin_city, origin_country,
              destination_city, destination_country ORDER BY position) = 1)""",
    "fact": f"""
      SELECT {FACT} FROM (
        SELECT f.* EXCLUDE (position, line_position), c.customer_id, d.driver_id, v.vehicle_id, r.route_id,
          t.date_id, ROW_NUMBER() OVER (ORDER BY f.source_shipment_id) AS shipment_id
        FROM first_records f
        LEFT JOIN (SELECT customer_id, company_name FROM dim_customer) c USING (company_name)
        LEFT JOIN (SELECT driver_id, full_name FROM dim_driver) d ON d.full_name = f.driver_name
        LEFT JOIN (SELECT vehicle_id, plate_number FROM dim_vehicle) v USING (plate_number)
        LEFT JOIN (SELECT route_id, origin_city, origin_country, destination_city,
          destination_country FROM dim_route) r
          USING (origin_city, origin_country, destination_city, destination_country)
        LEFT JOIN (SELECT date_id, full_date FROM dim_date) t
          ON t.full_date = CAST(f.scheduled_pickup AS DATE))""",
    "star": """
      SELECT f.*, t.* EXCLUDE (date_id), c.company_name, c.industry, c.segment,
        d.full_name, d.full_name AS driver_name, d.rating AS driver_rating, d.license_type,
        d.experience_years, v.plate_number, v.vehicle_type, v.capacity_kg, v.manufacture_year,
        v.mileage_km, r.origin_city, r.origin_country, r.destination_city,
        r.destination_country, r.region, r.route_type
      FROM fact f JOIN dim_date t USING (date_id) JOIN dim_customer c USING (customer_id)
      JOIN dim_driver d USING (driver_id) JOIN dim_vehicle v USING (vehicle_id)
      JOIN dim_route r USING (route_id)""",
    "dirty_fact": """
      SELECT * REPLACE (
          CASE WHEN k <> 0 THEN customer_id END AS customer_id,
          CASE WHEN k = 1 THEN 999999999 ELSE driver_id END AS driver_id,
          CASE WHEN k = 2 THEN 'lost' WHEN k <> 6 THEN status END AS status,
          CASE WHEN k = 3 THEN -1 ELSE cost_usd END AS cost_usd,
          CASE WHEN k = 4 THEN NOT is_delayed WHEN k <> 5 THEN is_delayed END AS is_delayed,
          CASE WHEN k = 7 THEN 999999999 ELSE date_id END AS date_id)
      FROM (SELECT *, CAST(split_part(source_shipment_id, '-', 2) AS BIGINT) % 97 AS k
            FROM fact)""",
    "dirty_driver": """
      SELECT * REPLACE (CASE WHEN driver_id = 7 THEN 5.50 ELSE rating END AS rating)
      FROM dim_driver""",
    "feed": """
      SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_timestamp,
        'RT-' || user_id AS shipment_id,
        ['PENDING', 'IN_TRANSIT', 'DELIVERED', 'DELAYED', 'CANCELLED']
          [CAST(event_id % 5 AS INT) + 1] AS status,
        'C' || (event_id % 20) AS origin_city, 'C' || (user_id % 20) AS destination_city,
        ['TRUCK', 'VAN', 'MOTORCYCLE', 'SHIP', 'PLANE'][CAST(event_id % 5 AS INT) + 1]
          AS vehicle_type,
        value AS weight_kg, CAST(event_id % 500 AS DOUBLE) AS distance_km,
        CAST(ROUND(CAST(CAST(value * 10 AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)
          AS revenue,
        event_id % 5 = 0 AS is_delayed,
        CAST(CASE WHEN event_id % 5 = 0 THEN 1 + event_id % 72 ELSE 0 END AS DOUBLE)
          AS delay_hours,
        CAST(1 + event_id % 5 AS DOUBLE) AS driver_rating,
        CAST(event_id % 50 - 4 AS DOUBLE) AS temperature_c,
        CAST(10 + event_id % 90 AS DOUBLE) AS humidity_pct
      FROM events""",
    "seen_events": """
      SELECT * FROM feed
      UNION ALL (SELECT * REPLACE ('late-1' AS event_id, '2020-01-01T00:00:00' AS event_timestamp)
        FROM feed ORDER BY CAST(event_id AS BIGINT) LIMIT 1)
      UNION ALL (SELECT * REPLACE ('odd-1' AS event_id, 'zzz' AS event_timestamp)
        FROM feed ORDER BY CAST(event_id AS BIGINT) LIMIT 1)""",
    "enriched": """
      SELECT * REPLACE (TRY_CAST(event_timestamp AS TIMESTAMP) AS event_timestamp),
        CASE WHEN distance_km > 0 THEN revenue / distance_km ELSE 0.0 END AS cost_per_km,
        CASE WHEN temperature_c > 40 OR temperature_c < 0 THEN 'HIGH'
          WHEN humidity_pct > 90 THEN 'MEDIUM' ELSE 'LOW' END AS weather_risk
      FROM seen_events""",
    "inputs": """
      SELECT source_shipment_id, CAST(is_delayed AS INT) AS label, weight_kg, distance_km,
        planned_duration_hrs, cost_usd, weather_condition, temperature_celsius, wind_speed_kmh,
        traffic_congestion_ratio, traffic_condition, experience_years, driver_rating,
        license_type, vehicle_type, capacity_kg AS vehicle_capacity, manufacture_year,
        mileage_km, region, route_type, month, quarter, is_weekend, weekday, segment, industry
      FROM star""",
}


def with_tables(sql: str) -> str:
    """Prepend the common tables that the SQL uses, directly or through each other."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name, body in COMMON.items():
            if name not in needed and re.search(rf"\b{name}\b(?!\s*\()", text):
                needed.append(name)
                add(body)

    add(sql)
    parts = [f"{name} AS ({COMMON[name].strip()})" for name in COMMON if name in needed]
    return f"WITH {', '.join(parts)}\n{sql.strip()}" if parts else sql.strip()


def _half_up(numerator: str, whole: str, digits: int) -> str:
    """numerator / whole for whole numbers >= 0, exact, rounded half up."""
    scaled = f"CAST({numerator} AS HUGEINT) * {10**digits}"
    return f"CAST((2 * {scaled} + {whole}) // (2 * {whole}) AS DOUBLE) / {10**digits}"


def _pct(condition: str, whole: str = "COUNT(*)", digits: int = 2) -> str:
    return _half_up(f"100 * SUM(CASE WHEN {condition} THEN 1 ELSE 0 END)", whole, digits)


def _round(value: str, digits: int) -> str:
    """Round a double half up by its shortest decimal text."""
    text = f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18))"
    return f"CAST(ROUND({text}, {digits}) AS DOUBLE)"


def _share(condition: str, whole: str = "COUNT(*)") -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS DOUBLE) / {whole} * 100"


# the sum is in cents, the mean is rounded to cents
_MEAN_COST = (
    "CAST((2 * CAST(SUM(cost_usd) * 100 AS HUGEINT) + COUNT(cost_usd)) "
    "// (2 * COUNT(cost_usd)) AS DOUBLE) / 100"
)
_ON_TIME = "CAST(SUM(CASE WHEN status = 'on_time' THEN 1 ELSE 0 END) AS BIGINT)"


def _rate(key: str) -> str:
    return f"""
      SELECT {key}, COUNT(*) AS shipments, {_share('is_delayed', 'COUNT(is_delayed)')} AS delay_rate
      FROM star WHERE {key} IS NOT NULL GROUP BY {key}"""


def _panel(where: str) -> str:
    return f"""
      SELECT COUNT(*) AS total_shipments, {_share("status = 'on_time'")} AS on_time_pct,
        CAST(SUM(CASE WHEN is_delayed THEN delay_minutes END) AS DOUBLE)
          / COUNT(CASE WHEN is_delayed THEN delay_minutes END) AS avg_delay_minutes,
        CAST(SUM(cost_usd) AS DOUBLE) AS total_cost_usd,
        {_share("status = 'failed'")} AS failed_pct
      FROM star {where}"""


def _top_drivers(minimum: int) -> str:
    return f"""
      SELECT * FROM (
        SELECT driver_name, COUNT(*) AS total, {_ON_TIME} AS on_time,
          CAST(SUM(driver_rating) AS DOUBLE) / COUNT(driver_rating) AS avg_rating,
          {_share("status = 'on_time'")} AS on_time_pct
        FROM star GROUP BY driver_name)
      QUALIFY MAX(total) OVER () < {minimum}
        OR (total >= {minimum} AND ROW_NUMBER() OVER (
          PARTITION BY total >= {minimum} ORDER BY on_time_pct DESC, driver_name) <= 10)"""


def _page_part(chart: str, *keys: str) -> str:
    label = " || ' ' || ".join(f"CAST({key} AS VARCHAR)" for key in keys)
    present = " AND ".join(f"{key} IS NOT NULL" for key in keys)
    return f"""
      SELECT '{chart}' AS chart, {label} AS label, COUNT(*) AS shipments, {_ON_TIME} AS on_time,
        CAST(SUM(CASE WHEN is_delayed THEN 1 ELSE 0 END) AS BIGINT) AS late,
        CAST(SUM(cost_usd) AS DOUBLE) AS cost_usd,
        CAST(SUM(driver_rating) AS DOUBLE) / COUNT(driver_rating) AS avg_rating,
        {_share("status = 'on_time'")} AS on_time_pct,
        {_share('is_delayed', 'COUNT(is_delayed)')} AS delay_rate
      FROM star WHERE {present} GROUP BY {", ".join(keys)}"""


_NEGATIVE = " UNION ALL ".join(
    f"SELECT 'negative_values' AS check_name, '{c}' AS detail, "
    f"(SELECT COUNT(*) FROM {{fact}} WHERE {c} < 0) AS violations"
    for c in ("cost_usd", "weight_kg", "distance_km", "fuel_consumed_liters")
)
_EMPTY = " UNION ALL ".join(
    f"SELECT 'row_counts', '{t}', (SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END FROM {t})"
    for t in ("dim_date", "dim_customer", "dim_driver", "dim_vehicle", "dim_route")
)
_LOST = " UNION ALL ".join(
    f"SELECT 'orphan_records', '{k}_id', (SELECT COUNT(*) FROM {{fact}} f "
    f"LEFT JOIN dim_{k} d ON f.{k}_id = d.{k}_id WHERE d.{k}_id IS NULL)"
    for k in ("customer", "driver", "vehicle", "route")
)


def _quality(fact: str, driver: str) -> str:
    body = f"""
      {_NEGATIVE} UNION ALL {_EMPTY} UNION ALL {_LOST}
      UNION ALL SELECT 'row_counts', 'fact_shipments',
        (SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END FROM {{fact}})
      UNION ALL SELECT 'null_foreign_keys', 'fact_shipments', (SELECT COUNT(*) FROM {{fact}}
        WHERE customer_id IS NULL OR driver_id IS NULL OR vehicle_id IS NULL
          OR route_id IS NULL OR date_id IS NULL)
      UNION ALL SELECT 'invalid_status', 'distinct values', (SELECT COUNT(DISTINCT status)
        FROM {{fact}} WHERE status NOT IN ('on_time', 'delayed', 'failed'))
      UNION ALL SELECT 'delay_consistency', 'fact_shipments', (SELECT COUNT(*) FROM {{fact}}
        WHERE (is_delayed = TRUE AND delay_minutes <= 30)
           OR (is_delayed = FALSE AND delay_minutes > 30))
      UNION ALL SELECT 'driver_ratings', 'dim_driver', (SELECT COUNT(*) FROM {{driver}}
        WHERE rating < 1.0 OR rating > 5.0)
      UNION ALL SELECT 'duplicate_shipments', 'customer_id, scheduled_pickup', (SELECT COUNT(*)
        FROM (SELECT customer_id, scheduled_pickup FROM {{fact}}
              GROUP BY customer_id, scheduled_pickup HAVING COUNT(*) > 1))"""
    return f"""
      SELECT check_name, detail,
        check_name IN ('row_counts', 'null_foreign_keys', 'orphan_records') AS critical,
        CAST(violations AS BIGINT) AS violations, violations = 0 AS passed
      FROM ({body.format(fact=fact, driver=driver)})"""


_CATEGORICAL = [
    "weather_condition",
    "traffic_condition",
    "license_type",
    "vehicle_type",
    "region",
    "route_type",
    "weekday",
    "segment",
    "industry",
]
_NUMERIC = [
    "weight_kg",
    "distance_km",
    "planned_duration_hrs",
    "cost_usd",
    "temperature_celsius",
    "wind_speed_kmh",
    "traffic_congestion_ratio",
    "experience_years",
    "driver_rating",
    "mileage_km",
    "month",
    "quarter",
]
_CODES = ", ".join(f"'{c}'" for c in (
    "Clear", "Clouds", "Rain", "Snow", "Thunderstorm", "Fog", "Mist", "Drizzle", "Haze", "Tornado"
))
_NORMAL = """CASE {code} WHEN 'Clouds' THEN 'Cloudy' WHEN 'Rain' THEN 'Rain' WHEN 'Snow' THEN 'Snow'
          WHEN 'Thunderstorm' THEN 'Storm' WHEN 'Fog' THEN 'Fog' WHEN 'Mist' THEN 'Fog'
          WHEN 'Drizzle' THEN 'Rain' WHEN 'Haze' THEN 'Fog' ELSE 'Clear' END"""
_CLASS = "CASE WHEN {r} >= 0.8 THEN 'LOW' WHEN {r} >= 0.5 THEN 'MEDIUM' ELSE 'HIGH' END"

# The tables with gaps: one idle driver and route, unknown references and values.
COMMON |= {
    "gap_fact": """
      SELECT * REPLACE (
          CASE WHEN k <> 1 THEN driver_id END AS driver_id,
          CASE WHEN k <> 2 THEN route_id END AS route_id,
          CASE WHEN k <> 6 THEN status END AS status,
          CASE WHEN k <> 8 THEN delay_minutes END AS delay_minutes,
          CASE WHEN k % 10 <> 0 THEN weather_condition END AS weather_condition,
          CASE WHEN k % 7 <> 0 THEN traffic_condition END AS traffic_condition)
      FROM (SELECT *, CAST(split_part(source_shipment_id, '-', 2) AS BIGINT) % 97 AS k
            FROM fact)""",
    "gap_driver": """
      SELECT * FROM dim_driver
      UNION ALL SELECT 0, 'Idle Driver', 'C', 3, 4.20, 'NOWHERE', TRUE""",
    "gap_route": """
      SELECT * FROM dim_route
      UNION ALL SELECT 0, 'A-HUB', 'A', 'B-HUB', 'B', 700, 'NOWHERE', 'Road'""",
}
_GAP_NAMES = {"fact": "gap_fact", "dim_driver": "gap_driver", "dim_route": "gap_route",
              "star": "gap_star", "inputs": "gap_inputs"}


def _gaps(sql: str) -> str:
    """The same SQL over the tables with gaps."""
    for name, other in _GAP_NAMES.items():
        sql = re.sub(rf"\b{name}\b", other, sql)
    return sql


COMMON |= {"gap_star": _gaps(COMMON["star"]), "gap_inputs": _gaps(COMMON["inputs"])}

_RISK = """
      SELECT source_shipment_id, ROUND(LEAST(0.95,
        0.10 + CASE weather_condition WHEN 'Clear' THEN 0.0 WHEN 'Cloudy' THEN 0.02
            WHEN 'Rain' THEN 0.10 WHEN 'Heavy Rain' THEN 0.20 WHEN 'Fog' THEN 0.15
            WHEN 'Snow' THEN 0.25 ELSE 0.05 END
        + CASE traffic_condition WHEN 'LOW' THEN 0.0 WHEN 'MEDIUM' THEN 0.08
            WHEN 'HIGH' THEN 0.18 ELSE 0.05 END
        + CASE WHEN driver_rating < 3 THEN 0.15 WHEN driver_rating < 4 THEN 0.05 ELSE 0.0 END
        + CASE WHEN 2026 - manufacture_year > 10 AND mileage_km > 200000 THEN 0.15
            WHEN 2026 - manufacture_year > 5 THEN 0.05 ELSE 0.0 END
        + CASE WHEN distance_km > 2000 THEN 0.10 WHEN distance_km > 1000 THEN 0.05
            ELSE 0.0 END)::DOUBLE, 2) AS delay_risk
      FROM star"""

# The delay risk taken as a prediction, for two groups of shipments.
_RATED = f"""
      WITH risks AS ({_RISK}),
      rated AS (
        SELECT source_shipment_id, CASE WHEN right(source_shipment_id, 1) IN ('1', '2')
            THEN 'odd' ELSE 'even' END AS model,
          CAST(is_delayed AS INT) AS late, delay_risk AS p
        FROM star JOIN risks USING (source_shipment_id)),
      steps AS (
        SELECT model, p, SUM(late) AS pos, SUM(1 - late) AS neg FROM rated GROUP BY model, p),
      running AS (
        SELECT model, p, pos, neg,
          SUM(pos) OVER (PARTITION BY model ORDER BY p DESC) AS pos_upto,
          SUM(neg) OVER (PARTITION BY model ORDER BY p DESC) AS neg_upto,
          SUM(pos) OVER (PARTITION BY model) AS pos_all,
          SUM(neg) OVER (PARTITION BY model) AS neg_all
        FROM steps)"""

_RULE = {
    "rule_accuracy": f"""SELECT * FROM ({_RATED}
      SELECT model, ROUND(AVG(CAST((p >= 0.3) = (late = 1) AS INT)), 9) AS accuracy
      FROM rated GROUP BY model)""",
    "rule_auc": f"""SELECT * FROM ({_RATED}
      SELECT model, ROUND(SUM(neg * (2 * (pos_upto - pos) + pos))::DOUBLE
          / (2.0::DOUBLE * MAX(pos_all) * MAX(neg_all)), 9) AS roc_auc
      FROM running GROUP BY model)""",
    "rule_roc": f"""SELECT * FROM ({_RATED}
      SELECT model, p AS threshold, ROUND(neg_upto::DOUBLE / neg_all, 9) AS fpr,
        ROUND(pos_upto::DOUBLE / pos_all, 9) AS tpr FROM running
      UNION ALL SELECT DISTINCT model, 'infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM running)""",
    "rule_confusion": f"""SELECT * FROM ({_RATED}
      SELECT late AS actual, CAST(p >= 0.3 AS INT) AS predicted, COUNT(*) AS shipments
      FROM rated GROUP BY ALL)""",
    "rule_risk_band": f"""SELECT * FROM ({_RATED}
      SELECT source_shipment_id, CASE WHEN p >= 0.7 THEN 'HIGH' WHEN p >= 0.4 THEN 'MEDIUM'
          ELSE 'LOW' END AS risk_level, ROUND(p * 100, 1) AS delay_probability FROM rated)""",
}

ORACLE: dict[str, str] = {
    "raw_scan_lineage": f"SELECT {RAW_COLUMNS}, raw_file FROM raw",
    "raw_csv_scan": f"SELECT {RAW_COLUMNS}, 'raw/shipments_19950101.csv' AS raw_file FROM raw",
    "raw_contract_rejects": """
      SELECT * FROM (
        SELECT 'company_name is null' AS reason, COUNT(*) AS records FROM raw
          WHERE delay_minutes = 7
        UNION ALL SELECT 'status longer than 20', COUNT(*) FROM raw WHERE delay_minutes = 40)
      WHERE records > 0""",
    "export_filtered_csv": f"""
      SELECT {EXPLORER} FROM star WHERE year IN (1997) AND status IN ('failed')""",
    "dim_date": "SELECT * FROM dim_date",
    "dim_customer": "SELECT * FROM dim_customer",
    "dim_driver": "SELECT * FROM dim_driver",
    "dim_vehicle": "SELECT * FROM dim_vehicle",
    "dim_route": "SELECT * FROM dim_route",
    "fact_shipments": "SELECT * FROM fact",
    "first_wins_attributes": """
      SELECT company_name, plate_number, destination_city, origin_city, delay_minutes
      FROM raw QUALIFY ROW_NUMBER() OVER (PARTITION BY company_name ORDER BY position) = 1""",
    "rolled_files_first_wins": f"""
      SELECT {RAW_COLUMNS} FROM raw
      QUALIFY ROW_NUMBER() OVER (PARTITION BY source_shipment_id ORDER BY line_position) = 1""",
    "rolled_files_attributes": """
      SELECT company_name, plate_number, destination_city, origin_city, delay_minutes
      FROM raw QUALIFY ROW_NUMBER() OVER (PARTITION BY company_name ORDER BY line_position) = 1""",
    "mixed_writers": f"SELECT {RAW_COLUMNS}, raw_file FROM raw",
    "reload_idempotent": """
      SELECT CAST(n AS INT) AS load_number, table_name, CAST(CASE n WHEN 1 THEN early
          WHEN 2 THEN whole - early ELSE 0 END AS BIGINT) AS new_rows
      FROM (SELECT UNNEST([1, 2, 3]) AS n), (
        SELECT table_name, COUNT(DISTINCT item) AS whole,
          COUNT(DISTINCT CASE WHEN raw_file = 'raw/shipments_19950101.parquet' THEN item END)
            AS early
        FROM (
          SELECT raw_file, UNNEST([
            {'t': 'dim_date', 'i': CAST(CAST(scheduled_pickup AS DATE) AS VARCHAR)},
            {'t': 'dim_customer', 'i': company_name}, {'t': 'dim_driver', 'i': driver_name},
            {'t': 'dim_vehicle', 'i': plate_number},
            {'t': 'dim_route', 'i': origin_city || '|' || origin_country || '|'
              || destination_city || '|' || destination_country},
            {'t': 'fact_shipments', 'i': source_shipment_id}]) AS entry FROM raw)
          , LATERAL (SELECT entry.t AS table_name, entry.i AS item)
        GROUP BY table_name)""",
    "incremental_load": """
      SELECT source_shipment_id, raw_file, company_name, driver_name, plate_number, origin_city,
        destination_city, CAST(scheduled_pickup AS DATE) AS full_date, status, cost_usd
      FROM first_records""",
    "star_extract": f"SELECT {EXTRACT} FROM star",
    "shipment_page": f"SELECT {LISTING} FROM star ORDER BY shipment_id LIMIT 50 OFFSET 100",
    "shipment_page_status": f"""
      SELECT {LISTING} FROM star WHERE status = 'delayed'
      ORDER BY shipment_id LIMIT 50 OFFSET 25""",
    "shipment_page_deep": f"""
      SELECT {LISTING} FROM star WHERE status = 'on_time'
      ORDER BY shipment_id LIMIT 500 OFFSET 20000""",
    "shipment_page_after": f"""
      SELECT {LISTING} FROM star WHERE shipment_id > 1000 ORDER BY shipment_id LIMIT 100""",
    "shipment_detail": f"""
      SELECT {FACT}, full_date, company_name, segment, full_name, vehicle_type, origin_city,
        destination_city, region
      FROM star WHERE shipment_id = 4242""",
    "raw_explorer": f"SELECT {EXPLORER} FROM star",
    "kpi_summary": f"""
      SELECT COUNT(*) AS total_shipments, {_pct("status = 'on_time'")} AS on_time_rate_pct,
        {_half_up("SUM(CASE WHEN is_delayed THEN delay_minutes END)",
                  "COUNT(CASE WHEN is_delayed THEN delay_minutes END)", 1)} AS avg_delay_minutes,
        ROUND(CAST(SUM(cost_usd) AS DOUBLE), 2) AS total_revenue_usd,
        {_MEAN_COST} AS avg_cost_usd, {_pct("status = 'failed'")} AS failure_rate_pct
      FROM fact""",
    "kpi_by_month": f"""
      SELECT year, month, month_name, COUNT(*) AS shipments,
        {_pct("status = 'on_time'")} AS on_time_pct,
        ROUND(CAST(SUM(cost_usd) AS DOUBLE), 2) AS revenue_usd
      FROM fact JOIN dim_date USING (date_id) GROUP BY year, month, month_name""",
    "kpi_by_region": f"""
      SELECT region, COUNT(*) AS shipments, {_pct("status = 'on_time'")} AS on_time_pct,
        {_MEAN_COST} AS avg_cost_usd
      FROM fact JOIN dim_route USING (route_id) GROUP BY region""",
    "driver_scorecard": f"""
      SELECT driver_id, full_name, license_type, experience_years, rating,
        COUNT(shipment_id) AS total_shipments, {_pct("status = 'on_time'")} AS on_time_pct
      FROM dim_driver LEFT JOIN fact USING (driver_id)
      GROUP BY driver_id, full_name, license_type, experience_years, rating""",
    "route_scorecard": f"""
      SELECT r.route_id, origin_city, destination_city, r.distance_km, region,
        COUNT(shipment_id) AS total_shipments, {_MEAN_COST} AS avg_cost_usd
      FROM dim_route r LEFT JOIN fact f ON r.route_id = f.route_id
      GROUP BY r.route_id, origin_city, destination_city, r.distance_km, region""",
    "weather_impact": f"""
      SELECT weather_condition, COUNT(*) AS shipments, {_pct("is_delayed")} AS delay_rate_pct,
        {_half_up("SUM(delay_minutes)", "COUNT(delay_minutes)", 1)} AS avg_delay_min
      FROM fact GROUP BY weather_condition""",
    "panel": _panel(""),
    "panel_filtered": _panel(
        "WHERE year IN (1996, 1997) AND status IN ('on_time', 'failed') "
        "AND region IN ('ASIA', 'EUROPE')"
    ),
    "filter_options": """
      SELECT DISTINCT 'year' AS filter, CAST(year AS VARCHAR) AS value FROM star
      UNION ALL SELECT DISTINCT 'status', status FROM star
      UNION ALL SELECT DISTINCT 'region', region FROM star""",
    "status_mix": "SELECT status, COUNT(*) AS shipments FROM star GROUP BY status",
    "monthly_on_time": f"""
      SELECT year, month, month_name, COUNT(*) AS total, {_ON_TIME} AS on_time,
        {_share("status = 'on_time'")} AS on_time_pct,
        substr(month_name, 1, 3) || ' ' || year AS period
      FROM star GROUP BY year, month, month_name""",
    "weekday_delay": f"SELECT weekday, delay_rate FROM ({_rate('weekday')})",
    "segment_revenue": """
      SELECT segment, CAST(SUM(cost_usd) AS DOUBLE) AS cost_usd FROM star GROUP BY segment""",
    "monthly_revenue": """
      SELECT year, month, month_name, CAST(SUM(cost_usd) AS DOUBLE) AS cost_usd,
        substr(month_name, 1, 3) || ' ' || year AS period
      FROM star GROUP BY year, month, month_name""",
    "top_drivers": _top_drivers(5),
    "top_drivers_fallback": _top_drivers(10**9),
    "vehicle_delay": _rate("vehicle_type"),
    "weather_delay": _rate("weather_condition"),
    "traffic_delay": _rate("traffic_condition"),
    "dashboard_page": " UNION ALL ".join(
        [
            _page_part("status_mix", "status"),
            _page_part("monthly", "year", "month", "month_name"),
            _page_part("weekday_delay", "weekday"),
            _page_part("segment_revenue", "segment"),
            _page_part("drivers", "driver_name"),
            _page_part("vehicle_delay", "vehicle_type"),
            _page_part("weather_delay", "weather_condition"),
            _page_part("traffic_delay", "traffic_condition"),
        ]
    ),
    "lake_weather": f"""
      SELECT weather_condition, COUNT(*) AS shipments, {_pct("is_delayed")} AS delay_rate_pct
      FROM raw GROUP BY weather_condition""",
    "lake_traffic": f"""
      SELECT traffic_condition, COUNT(*) AS shipments, {_pct("is_delayed")} AS delay_rate_pct,
        {_MEAN_COST} AS avg_cost_usd
      FROM raw GROUP BY traffic_condition""",
    "lake_count": "SELECT COUNT(*) AS shipments FROM raw",
    "batch_delay_rate": f"""
      SELECT raw_file, {_pct("is_delayed", "COUNT(is_delayed)", 1)} AS delay_rate_pct
      FROM raw GROUP BY raw_file""",
    "quality_report_clean": _quality("fact", "dim_driver"),
    "quality_report_dirty": _quality("dirty_fact", "dirty_driver"),
    "quality_summary_dirty": f"""
      SELECT check_name, critical, CAST(SUM(violations) AS BIGINT) AS violations,
        bool_and(passed) AS passed
      FROM ({_quality("dirty_fact", "dirty_driver")}) GROUP BY check_name, critical""",
    "orphans": " UNION ALL ".join(
        f"SELECT '{k}_id' AS foreign_key, COUNT(*) AS shipments FROM dirty_fact f "
        f"LEFT JOIN dim_{k} d ON f.{k}_id = d.{k}_id WHERE d.{k}_id IS NULL"
        for k in ("customer", "driver", "vehicle", "route")
    ),
    "duplicate_shipments": """
      SELECT customer_id, scheduled_pickup, COUNT(*) AS shipments
      FROM fact GROUP BY customer_id, scheduled_pickup HAVING COUNT(*) > 1""",
    "delay_risk": _RISK,
    **_RULE,
    "congestion_class": f"""
      SELECT event_id, ratio, {_CLASS.format(r="ratio")} AS traffic_condition
      FROM (SELECT event_id, CASE WHEN user_id % 5 = 0 THEN 1.0::DOUBLE
              ELSE {_round("value / (user_id % 5 * 20)", 2)} END AS ratio FROM events)""",
    "weather_normalise": f"""
      SELECT event_id, {_NORMAL.format(code="code")} AS weather_condition, wind_speed_kmh
      FROM (SELECT event_id, {_round("value * 3.6::DOUBLE", 1)} AS wind_speed_kmh,
              [{_CODES}][CAST(event_id % 10 AS INT) + 1] AS code FROM events)""",
    "status_from_delay": """
      SELECT source_shipment_id, delay_minutes > 30 AS is_delayed,
        CASE WHEN delay_minutes > 240 THEN 'failed' WHEN delay_minutes > 30 THEN 'delayed'
          ELSE 'on_time' END AS status,
        planned_duration_hrs, actual_duration_hrs, scheduled_delivery, actual_delivery
      FROM fact""",
    "recent_enrichment": f"""
      SELECT source_shipment_id, origin_city, scheduled_pickup,
        CASE WHEN fresh THEN s.w ELSE weather_condition END AS weather_condition,
        CASE WHEN fresh THEN CAST(s.t AS DECIMAL(5,2)) ELSE temperature_celsius END
          AS temperature_celsius,
        CASE WHEN fresh THEN CAST(s.wind AS DECIMAL(6,2)) ELSE wind_speed_kmh END
          AS wind_speed_kmh,
        CASE WHEN fresh THEN CAST(s.r AS DECIMAL(4,2)) ELSE traffic_congestion_ratio END
          AS traffic_congestion_ratio,
        CASE WHEN fresh THEN {_CLASS.format(r="s.r")} ELSE traffic_condition END
          AS traffic_condition
      FROM (
        SELECT raw.*, s, s.city IS NOT NULL AND
          scheduled_pickup >= TIMESTAMP '2001-07-01' - INTERVAL 7 DAY AS fresh
        FROM raw LEFT JOIN (
          SELECT city, w, t, wind, r FROM (
            SELECT 'NATION_' || (user_id % 20) || '-HUB' AS city,
              {_NORMAL.format(code=f"[{_CODES}][CAST(user_id % 10 AS INT) + 1]")} AS w,
              CAST(user_id % 45 - 10 AS DOUBLE) AS t,
              {_round("user_id % 30 * 0.7::DOUBLE * 3.6::DOUBLE", 1)} AS wind,
              CASE WHEN user_id % 4 = 0 THEN 1.0::DOUBLE
                ELSE {_round("(user_id % 60)::DOUBLE / (user_id % 4 * 20)", 2)} END AS r
            FROM events)
          QUALIFY ROW_NUMBER() OVER (PARTITION BY city ORDER BY w, t, wind, r) = 1
        ) s ON s.city = raw.origin_city)""",
    "stream_enrich": f"""
      SELECT {EVENT_COLUMNS}, cost_per_km, weather_risk FROM enriched
      WHERE event_id NOT IN ('late-1', 'odd-1')""",
    "event_publish_frame": f"SELECT shipment_id AS message_key, {EVENT_COLUMNS} FROM feed",
    "stream_quarantine": """
      SELECT 'broken ' || event_id AS message, 'no event_id' AS reason
      FROM events WHERE event_type = 'error'""",
    "features": f"""
      SELECT source_shipment_id, label, {", ".join(_CATEGORICAL)},
        {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMERIC)},
        CAST(CAST(is_weekend AS INT) AS DOUBLE) AS is_weekend,
        CAST(2026 - manufacture_year AS DOUBLE) AS vehicle_age_years,
        CAST(mileage_km AS DOUBLE) / (CAST(2026 - manufacture_year AS DOUBLE) + 1)
          AS mileage_per_year,
        CAST(weight_kg AS DOUBLE) / (CAST(vehicle_capacity AS DOUBLE) + 1) AS load_ratio,
        CAST(cost_usd AS DOUBLE) / (CAST(distance_km AS DOUBLE) + 1) AS cost_per_km
      FROM inputs""",
    "label_encode": f"""
      SELECT source_shipment_id, {", ".join(
        f"CAST(DENSE_RANK() OVER (ORDER BY {c}) - 1 AS INT) AS {c}" for c in _CATEGORICAL)}
      FROM inputs""",
    "stratified_test_set": """
      SELECT source_shipment_id, label, ROW_NUMBER() OVER (PARTITION BY label
          ORDER BY md5(source_shipment_id || '|42'), source_shipment_id)
          <= ROUND(COUNT(*) OVER (PARTITION BY label) * 0.2::DOUBLE, 0) AS is_test
      FROM inputs""",
}
_STORED_EVENTS = """
      SELECT event_id, event_type, event_timestamp, shipment_id, status, origin_city,
        destination_city, vehicle_type, CAST(weight_kg AS DECIMAL(10,2)) AS weight_kg,
        CAST(distance_km AS DECIMAL(10,2)) AS distance_km,
        CAST(revenue AS DECIMAL(10,2)) AS revenue, is_delayed,
        CAST(delay_hours AS DECIMAL(5,1)) AS delay_hours,
        CAST(driver_rating AS DECIMAL(3,1)) AS driver_rating,
        CAST(temperature_c AS DECIMAL(5,1)) AS temperature_c,
        CAST(humidity_pct AS DECIMAL(5,1)) AS humidity_pct,
        CAST(CAST(cost_per_km AS VARCHAR) AS DECIMAL(10,4)) AS cost_per_km, weather_risk
      FROM enriched"""
ORACLE["stream_upsert_dedup"] = _STORED_EVENTS
ORACLE["stream_upsert_stateful"] = _STORED_EVENTS


for _name in (
    "kpi_summary",
    "kpi_by_region",
    "driver_scorecard",
    "route_scorecard",
    "weather_impact",
    "status_mix",
    "weather_delay",
    "traffic_delay",
    "star_extract",
    "features",
):
    ORACLE[f"{_name}_gaps"] = _gaps(ORACLE[_name])
ORACLE["status_mix_gaps"] = (
    "SELECT status, COUNT(*) AS shipments FROM gap_star WHERE status IS NOT NULL GROUP BY status"
)
ORACLE["features_gaps"] = f"""
  SELECT * REPLACE (coalesce(weather_condition, 'None') AS weather_condition,
    coalesce(traffic_condition, 'None') AS traffic_condition)
  FROM ({ORACLE["features_gaps"]})"""
ORACLE["quality_row_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS rows FROM {sql}"
    for name, sql in {
        "dim_date": "dim_date",
        "dim_customer": "dim_customer",
        "dim_driver": "dim_driver",
        "dim_vehicle": "dim_vehicle",
        "dim_route": "dim_route",
        "fact_shipments": "fact",
    }.items()
)
ORACLE["failed_load_invisible"] = f"""
  SELECT table_name, new_rows AS rows FROM ({ORACLE["reload_idempotent"]}) WHERE load_number = 1"""
ORACLE["quality_gate"] = " UNION ALL ".join(
    f"""
  SELECT '{variant}' AS variant, COUNT(*) > 0 AS stopped, COUNT(*) AS failed_critical
  FROM (SELECT check_name FROM ({ORACLE[f"quality_report_{variant}"]})
    WHERE critical GROUP BY check_name HAVING NOT bool_and(passed))"""
    for variant in ("clean", "dirty")
)


for _name in ("kpi_summary", "kpi_by_month", "kpi_by_region", "weather_impact"):
    ORACLE[f"{_name}_grown"] = ORACLE[_name]
for _name, _id in (("driver_scorecard", "driver_id"), ("route_scorecard", "route_id")):
    ORACLE[f"{_name}_grown"] = f"SELECT * EXCLUDE ({_id}) FROM ({ORACLE[_name]})"
ORACLE["quality_report_grown"] = ORACLE["quality_report_clean"]
ORACLE["duplicate_shipments_grown"] = f"""
  SELECT company_name, scheduled_pickup, shipments
  FROM ({ORACLE["duplicate_shipments"]}) JOIN dim_customer USING (customer_id)"""
ORACLE["explorer_newest"] = f"""
  SELECT {EXPLORER} FROM star ORDER BY full_date DESC, shipment_id LIMIT 500 OFFSET 1000"""
ORACLE["lake_weather_mixed"] = ORACLE["lake_weather"]
ORACLE["lake_traffic_mixed"] = ORACLE["lake_traffic"]


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(sql) for name, sql in ORACLE.items()}
