"""Measures derived from one live event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cost_per_km(revenue: Column, distance_km: Column) -> Column:
    """Zero where there is no distance to divide by."""
    return F.when(distance_km > 0, F.try_divide(revenue, distance_km)).otherwise(F.lit(0.0))


def weather_risk(temperature_c: Column, humidity_pct: Column) -> Column:
    extreme = (temperature_c > 40) | (temperature_c < 0)
    return F.when(extreme, "HIGH").when(humidity_pct > 90, "MEDIUM").otherwise("LOW")
