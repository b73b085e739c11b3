"""Raw shipment records for tests: one full record, changed field by field."""

from datetime import datetime, timedelta
from decimal import Decimal

_START = datetime(2024, 2, 3, 10, 30)  # a Saturday

_DEFAULTS = {
    "company_name": "Acme",
    "industry": "Retail",
    "customer_country": "France",
    "customer_city": "Lyon",
    "segment": "SME",
    "contract_type": "Spot",
    "driver_name": "Dana",
    "license_type": "C",
    "experience_years": 4,
    "driver_rating": Decimal("4.20"),
    "driver_country": "France",
    "plate_number": "P-1",
    "vehicle_type": "Truck",
    "capacity_kg": 9000,
    "manufacture_year": 2016,
    "mileage_km": 120000,
    "origin_city": "Lyon",
    "origin_country": "France",
    "destination_city": "Turin",
    "destination_country": "Italy",
    "distance_km": 310,
    "region": "Europe",
    "route_type": "Road",
    "scheduled_pickup": _START,
    "actual_pickup": _START + timedelta(minutes=5),
    "scheduled_delivery": _START + timedelta(hours=4),
    "actual_delivery": _START + timedelta(hours=5),
    "planned_duration_hrs": Decimal("4.13"),
    "actual_duration_hrs": Decimal("4.80"),
    "delay_minutes": 12,
    "is_delayed": False,
    "status": "on_time",
    "weight_kg": Decimal("1500.00"),
    "cost_usd": Decimal("420.50"),
    "fuel_consumed_liters": Decimal("93.00"),
    "weather_condition": "Clear",
    "temperature_celsius": Decimal("8.50"),
    "wind_speed_kmh": Decimal("12.00"),
    "traffic_congestion_ratio": Decimal("0.85"),
    "traffic_condition": "LOW",
}


def record(number, **changes):
    return {"source_shipment_id": f"T-{number}"} | _DEFAULTS | changes
