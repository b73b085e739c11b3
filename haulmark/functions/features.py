"""Model features and the reading of a predicted probability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Label-encoded columns and the 24 fields a caller must supply.
CATEGORICAL = [
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
REQUIRED_FIELDS = [
    "weight_kg",
    "distance_km",
    "planned_duration_hrs",
    "cost_usd",
    "weather_condition",
    "temperature_celsius",
    "wind_speed_kmh",
    "traffic_congestion_ratio",
    "traffic_condition",
    "experience_years",
    "driver_rating",
    "license_type",
    "vehicle_type",
    "vehicle_capacity",
    "manufacture_year",
    "mileage_km",
    "region",
    "route_type",
    "month",
    "quarter",
    "is_weekend",
    "weekday",
    "segment",
    "industry",
]
# Fields replaced by the ratios derived from them, and those ratios.
CONSUMED = ["manufacture_year", "vehicle_capacity"]
DERIVED = ["vehicle_age_years", "mileage_per_year", "load_ratio", "cost_per_km"]
FEATURES = [name for name in REQUIRED_FIELDS if name not in CONSUMED] + DERIVED

# Lower bounds of the risk bands.
HIGH_FROM, MEDIUM_FROM = 0.7, 0.4


def per_unit(amount: Column, units: Column) -> Column:
    """Amount per unit with one unit added, so that zero units are allowed."""
    return F.try_divide(amount.cast("double"), units.cast("double") + 1)


def with_features(df: DataFrame, as_of_year: int) -> DataFrame:
    """The 26 model inputs, the same for training and scoring; other columns stay.

    A missing category becomes a category of its own.
    """
    c = F.col
    age = F.lit(as_of_year) - c("manufacture_year")
    derived = {
        "vehicle_age_years": age.cast("double"),
        "mileage_per_year": per_unit(c("mileage_km"), age),
        "load_ratio": per_unit(c("weight_kg"), c("vehicle_capacity")),
        "cost_per_km": per_unit(c("cost_usd"), c("distance_km")),
    }
    text = {name: F.coalesce(c(name).cast("string"), F.lit("None")) for name in CATEGORICAL}
    numbers = {
        name: c(name).cast("double")
        for name in REQUIRED_FIELDS
        if name not in CATEGORICAL and name != "is_weekend"
    }
    weekend = {"is_weekend": c("is_weekend").cast("int").cast("double")}
    return df.withColumns(derived).withColumns(text | numbers | weekend).drop(*CONSUMED)


def risk_band(probability: Column) -> Column:
    return (
        F.when(probability >= HIGH_FROM, "HIGH")
        .when(probability >= MEDIUM_FROM, "MEDIUM")
        .otherwise("LOW")
    )


def probability_pct(probability: Column) -> Column:
    return F.round(probability * 100, 1)
