"""Road and weather conditions, delay risk and status rules."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Feed weather codes and the condition each stands for.
WEATHER_CODES = {
    "Clear": "Clear",
    "Clouds": "Cloudy",
    "Rain": "Rain",
    "Snow": "Snow",
    "Thunderstorm": "Storm",
    "Fog": "Fog",
    "Mist": "Fog",
    "Drizzle": "Rain",
    "Haze": "Fog",
}
UNKNOWN_WEATHER = "Clear"

# Congestion classes, their order and lower ratio bounds.
CONGESTION_ORDER = ["LOW", "MEDIUM", "HIGH"]
LOW_FROM, MEDIUM_FROM = 0.8, 0.5

# Contributions to the delay risk.
BASE_RISK, MAX_RISK, OTHER_RISK = 0.10, 0.95, 0.05
WEATHER_RISK = {
    "Clear": 0.0,
    "Cloudy": 0.02,
    "Rain": 0.10,
    "Heavy Rain": 0.20,
    "Fog": 0.15,
    "Snow": 0.25,
}
TRAFFIC_RISK = {"LOW": 0.0, "MEDIUM": 0.08, "HIGH": 0.18}

# Minutes beyond which a shipment is late, and failed.
LATE_AFTER, FAILED_AFTER = 30, 240
STATUSES = ["on_time", "delayed", "failed"]


def lookup(value: Column, table: dict, default) -> Column:
    """Literal map lookup as one CASE, so it stays inside generated code."""
    branches = iter(table.items())
    key, result = next(branches)
    chain = F.when(value == key, F.lit(result))
    for key, result in branches:
        chain = chain.when(value == key, F.lit(result))
    return chain.otherwise(F.lit(default))


def weather_condition(code: Column) -> Column:
    return lookup(code, WEATHER_CODES, UNKNOWN_WEATHER)


def wind_kmh(metres_per_second: Column) -> Column:
    return F.round(metres_per_second * 3.6, 1)


def congestion_ratio(current: Column, free_flow: Column) -> Column:
    """Current over free-flow speed; a feed without a free-flow speed counts as free road."""
    has_reference = F.coalesce(free_flow, F.lit(0.0)) != 0
    return F.when(has_reference, F.round(F.try_divide(current, free_flow), 2)).otherwise(1.0)


def congestion_class(ratio: Column) -> Column:
    low, medium, high = CONGESTION_ORDER
    return F.when(ratio >= LOW_FROM, low).when(ratio >= MEDIUM_FROM, medium).otherwise(high)


def delay_risk(
    weather: Column,
    traffic: Column,
    driver_rating: Column,
    manufacture_year: Column,
    mileage_km: Column,
    distance_km: Column,
    as_of_year: int,
) -> Column:
    """Probability of a late delivery as the sum of its causes, capped."""
    age = F.lit(as_of_year) - manufacture_year
    worn_out = (age > 10) & (mileage_km > 200_000)
    causes = [
        F.lit(BASE_RISK),
        lookup(weather, WEATHER_RISK, OTHER_RISK),
        lookup(traffic, TRAFFIC_RISK, OTHER_RISK),
        F.when(driver_rating < 3, 0.15).when(driver_rating < 4, 0.05).otherwise(0.0),
        F.when(worn_out, 0.15).when(age > 5, 0.05).otherwise(0.0),
        F.when(distance_km > 2000, 0.10).when(distance_km > 1000, 0.05).otherwise(0.0),
    ]
    return F.least(reduce(add, causes), F.lit(MAX_RISK))


def is_late(delay_minutes: Column) -> Column:
    return delay_minutes > LATE_AFTER


def status_of(delay_minutes: Column, late: Column | None = None) -> Column:
    on_time, delayed, failed = STATUSES
    late = is_late(delay_minutes) if late is None else late
    return F.when(delay_minutes > FAILED_AFTER, failed).when(late, delayed).otherwise(on_time)
