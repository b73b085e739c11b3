"""Live conditions joined onto recent shipments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.functions import conditions
from haulmark.operators.keyed import counted

# Fixed value: shipments older than this many days keep their recorded conditions.
RECENT_DAYS = 7


def observed_conditions(observations: DataFrame) -> DataFrame:
    """One set of normalised conditions per city; of several, the smallest row."""
    c = F.col
    ratio = conditions.congestion_ratio(c("current_speed"), c("free_flow_speed"))
    normal = observations.select(
        "city",
        conditions.weather_condition(c("weather_code")).alias("weather_condition"),
        F.round("temperature_celsius", 1).alias("temperature_celsius"),
        conditions.wind_kmh(c("wind_speed_ms")).alias("wind_speed_kmh"),
        ratio.alias("traffic_congestion_ratio"),
    ).withColumn(
        "traffic_condition", conditions.congestion_class(c("traffic_congestion_ratio"))
    )
    return normal.groupBy("city").agg(F.min(F.struct(*normal.columns[1:])).alias("seen"))


def enrich_recent(
    shipments: DataFrame, observations: DataFrame, as_of: Column, days: int = RECENT_DAYS
) -> DataFrame:
    """Replace the conditions of recent shipments by those observed at their origin.

    Older shipments, and cities without an observation, keep what they have. The lookup
    has one row per city and is broadcast only after its size was counted.
    """
    seen = counted(observed_conditions(observations))
    since = as_of - F.make_dt_interval(F.lit(days))
    recent = (F.col("scheduled_pickup") >= since) & F.col("seen").isNotNull()
    kinds = dict(shipments.dtypes)
    replaced = {
        name: F.when(recent, F.col(f"seen.{name}").cast(kinds[name])).otherwise(F.col(name))
        for name in (
            "weather_condition",
            "temperature_celsius",
            "wind_speed_kmh",
            "traffic_congestion_ratio",
            "traffic_condition",
        )
    }
    joined = shipments.join(seen, F.col("origin_city") == F.col("city"), "left")
    return joined.withColumns(replaced).drop("city", "seen")
