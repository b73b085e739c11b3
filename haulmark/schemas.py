"""Declared schemas: the raw record, the stream event and the warehouse tables.

Each schema is a plain ``{column: SQL type}`` mapping; :func:`ddl` turns it into the
schema string that readers, ``from_json`` and ``createDataFrame`` accept.
"""

from __future__ import annotations

Schema = dict[str, str]


def ddl(schema: Schema) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in schema.items())


# The 41 columns of a raw shipment record, in file order.
RAW_SCHEMA: Schema = {
    "source_shipment_id": "string",
    "company_name": "string",
    "industry": "string",
    "customer_country": "string",
    "customer_city": "string",
    "segment": "string",
    "contract_type": "string",
    "driver_name": "string",
    "license_type": "string",
    "experience_years": "int",
    "driver_rating": "decimal(3,2)",
    "driver_country": "string",
    "plate_number": "string",
    "vehicle_type": "string",
    "capacity_kg": "int",
    "manufacture_year": "int",
    "mileage_km": "int",
    "origin_city": "string",
    "origin_country": "string",
    "destination_city": "string",
    "destination_country": "string",
    "distance_km": "int",
    "region": "string",
    "route_type": "string",
    "scheduled_pickup": "timestamp",
    "actual_pickup": "timestamp",
    "scheduled_delivery": "timestamp",
    "actual_delivery": "timestamp",
    "planned_duration_hrs": "decimal(6,2)",
    "actual_duration_hrs": "decimal(6,2)",
    "delay_minutes": "int",
    "is_delayed": "boolean",
    "status": "string",
    "weight_kg": "decimal(8,2)",
    "cost_usd": "decimal(10,2)",
    "fuel_consumed_liters": "decimal(8,2)",
    "weather_condition": "string",
    "temperature_celsius": "decimal(5,2)",
    "wind_speed_kmh": "decimal(6,2)",
    "traffic_congestion_ratio": "decimal(4,2)",
    "traffic_condition": "string",
}

# The 16 fields of a stream event.
EVENT_SCHEMA: Schema = {
    "event_id": "string",
    "event_type": "string",
    "event_timestamp": "string",
    "shipment_id": "string",
    "status": "string",
    "origin_city": "string",
    "destination_city": "string",
    "vehicle_type": "string",
    "weight_kg": "double",
    "distance_km": "double",
    "revenue": "double",
    "is_delayed": "boolean",
    "delay_hours": "double",
    "driver_rating": "double",
    "temperature_c": "double",
    "humidity_pct": "double",
}

# The columns and SQL types of the warehouse tables.
DIM_DATE: Schema = {
    "date_id": "bigint",
    "full_date": "date",
    "day": "int",
    "month": "int",
    "month_name": "string",
    "quarter": "int",
    "year": "int",
    "weekday": "string",
    "is_weekend": "boolean",
}
DIM_CUSTOMER: Schema = {
    "customer_id": "bigint",
    "company_name": "string",
    "industry": "string",
    "country": "string",
    "city": "string",
    "segment": "string",
    "contract_type": "string",
}
DIM_DRIVER: Schema = {
    "driver_id": "bigint",
    "full_name": "string",
    "license_type": "string",
    "experience_years": "int",
    "rating": "decimal(3,2)",
    "country": "string",
    "is_active": "boolean",
}
DIM_VEHICLE: Schema = {
    "vehicle_id": "bigint",
    "plate_number": "string",
    "vehicle_type": "string",
    "capacity_kg": "int",
    "manufacture_year": "int",
    "mileage_km": "int",
    "last_service_date": "date",
    "is_active": "boolean",
}
DIM_ROUTE: Schema = {
    "route_id": "bigint",
    "origin_city": "string",
    "origin_country": "string",
    "destination_city": "string",
    "destination_country": "string",
    "distance_km": "int",
    "region": "string",
    "route_type": "string",
}
FACT_SHIPMENTS: Schema = {
    "shipment_id": "bigint",
    "source_shipment_id": "string",
    "customer_id": "bigint",
    "driver_id": "bigint",
    "vehicle_id": "bigint",
    "route_id": "bigint",
    "date_id": "bigint",
    "raw_file": "string",
    "planned_duration_hrs": "decimal(6,2)",
    "actual_duration_hrs": "decimal(6,2)",
    "delay_minutes": "int",
    "distance_km": "int",
    "weight_kg": "decimal(8,2)",
    "cost_usd": "decimal(10,2)",
    "fuel_consumed_liters": "decimal(8,2)",
    "weather_condition": "string",
    "temperature_celsius": "decimal(5,2)",
    "wind_speed_kmh": "decimal(6,2)",
    "traffic_congestion_ratio": "decimal(4,2)",
    "traffic_condition": "string",
    "status": "string",
    "is_delayed": "boolean",
    "scheduled_pickup": "timestamp",
    "actual_pickup": "timestamp",
    "scheduled_delivery": "timestamp",
    "actual_delivery": "timestamp",
}
# Natural key -> surrogate of every shipment: the narrow side of the upsert's anti join.
SHIPMENT_KEYS: Schema = {"shipment_id": "bigint", "source_shipment_id": "string"}

TABLES: dict[str, Schema] = {
    "dim_date": DIM_DATE,
    "dim_customer": DIM_CUSTOMER,
    "dim_driver": DIM_DRIVER,
    "dim_vehicle": DIM_VEHICLE,
    "dim_route": DIM_ROUTE,
    "fact_shipments": FACT_SHIPMENTS,
}

# Decimal widths of the live event table.
REALTIME_TYPES: Schema = {
    "event_id": "string",
    "event_type": "string",
    "event_timestamp": "timestamp",
    "shipment_id": "string",
    "status": "string",
    "origin_city": "string",
    "destination_city": "string",
    "vehicle_type": "string",
    "weight_kg": "decimal(10,2)",
    "distance_km": "decimal(10,2)",
    "revenue": "decimal(10,2)",
    "is_delayed": "boolean",
    "delay_hours": "decimal(5,1)",
    "driver_rating": "decimal(3,1)",
    "temperature_c": "decimal(5,1)",
    "humidity_pct": "decimal(5,1)",
    "cost_per_km": "decimal(10,4)",
    "weather_risk": "string",
}

# Raw columns that must not be NULL because they are natural keys.
REQUIRED_RAW = [
    "source_shipment_id",
    "company_name",
    "driver_name",
    "plate_number",
    "origin_city",
    "origin_country",
    "destination_city",
    "destination_country",
    "scheduled_pickup",
]

# The widest text each raw column may carry into the warehouse.
MAX_TEXT = {
    "source_shipment_id": 64,
    "company_name": 150,
    "industry": 80,
    "customer_country": 60,
    "customer_city": 80,
    "segment": 20,
    "contract_type": 20,
    "driver_name": 100,
    "license_type": 10,
    "driver_country": 60,
    "plate_number": 20,
    "vehicle_type": 30,
    "origin_city": 80,
    "origin_country": 60,
    "destination_city": 80,
    "destination_country": 60,
    "region": 40,
    "route_type": 20,
    "weather_condition": 30,
    "traffic_condition": 10,
    "status": 20,
}
