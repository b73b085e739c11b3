"""KPI and scorecard queries over the warehouse.

Where a grouping column sits in a dimension, the fact is reduced per foreign key first. The
measures per key are merged from the summaries that each load wrote; tables without such
summaries are scanned, one row per key and task leaving the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.functions.metrics import exact_ratio, money, pct
from haulmark.plans.summaries import measured
from haulmark.plans.warehouse import Warehouse


def _measured(wh: Warehouse, key: str) -> DataFrame:
    """Additive measures per value of a key column: the input of every roll-up below."""
    summary = wh.summary(key) if hasattr(wh, "summary") else None
    return measured(wh.table("fact_shipments"), key) if summary is None else summary


def kpi_summary(wh: Warehouse) -> DataFrame:
    names = ["n", "on_time", "failed", "late_minutes", "late_timed", "cost", "priced"]
    sums = [F.sum(name).alias(name) for name in names]
    totals = _measured(wh, "status").agg(*sums).withColumns(
        {name: F.coalesce(name, F.lit(0)) for name in ("n", "on_time", "failed")}
    )
    c = F.col
    return totals.select(
        c("n").alias("total_shipments"),
        pct(c("on_time"), c("n")).alias("on_time_rate_pct"),
        exact_ratio(c("late_minutes"), c("late_timed"), 1).alias("avg_delay_minutes"),
        F.round(money(c("cost")), 2).alias("total_revenue_usd"),
        exact_ratio(c("cost"), c("priced"), 2).alias("avg_cost_usd"),
        pct(c("failed"), c("n")).alias("failure_rate_pct"),
    )


def _roll_up(per_key: DataFrame, *groups: str) -> DataFrame:
    measures = ["n", "on_time", "cost", "priced"]
    return per_key.groupBy(*groups).agg(*[F.sum(name).alias(name) for name in measures])


def kpi_by_month(wh: Warehouse) -> DataFrame:
    c = F.col
    joined = _measured(wh, "date_id").join(wh.dimension("dim_date"), "date_id")
    return (
        _roll_up(joined, "year", "month", "month_name")
        .select(
            "year",
            "month",
            "month_name",
            c("n").alias("shipments"),
            pct(c("on_time"), c("n")).alias("on_time_pct"),
            F.round(money(c("cost")), 2).alias("revenue_usd"),
        )
        .orderBy("year", "month")
    )


def kpi_by_region(wh: Warehouse) -> DataFrame:
    c = F.col
    joined = _measured(wh, "route_id").join(wh.dimension("dim_route"), "route_id")
    return (
        _roll_up(joined, "region")
        .select(
            "region",
            c("n").alias("shipments"),
            pct(c("on_time"), c("n")).alias("on_time_pct"),
            exact_ratio(c("cost"), c("priced"), 2).alias("avg_cost_usd"),
        )
        .orderBy(F.desc("shipments"), "region")
    )


def driver_scorecard(wh: Warehouse) -> DataFrame:
    """Every driver; one without shipments counts as zero shipments, zero percent on time."""
    c = F.col
    per_driver = _measured(wh, "driver_id")
    total = F.coalesce(c("n"), F.lit(0))
    return (
        wh.table("dim_driver")
        .join(per_driver, "driver_id", "left")
        .select(
            "driver_id",
            "full_name",
            "license_type",
            "experience_years",
            "rating",
            total.alias("total_shipments"),
            F.coalesce(pct(c("on_time"), c("n")), F.lit(0.0)).alias("on_time_pct"),
        )
        .orderBy(F.desc_nulls_last("on_time_pct"), "driver_id")
    )


def route_scorecard(wh: Warehouse) -> DataFrame:
    """Every route; one without shipments has no average cost."""
    c = F.col
    per_route = _measured(wh, "route_id")
    return (
        wh.table("dim_route")
        .join(per_route, "route_id", "left")
        .select(
            "route_id",
            "origin_city",
            "destination_city",
            "distance_km",
            "region",
            F.coalesce(c("n"), F.lit(0)).alias("total_shipments"),
            exact_ratio(c("cost"), c("priced"), 2).alias("avg_cost_usd"),
        )
        .orderBy(F.desc_nulls_last("total_shipments"), "route_id")
    )


def weather_impact(wh: Warehouse) -> DataFrame:
    c = F.col
    return (
        _measured(wh, "weather_condition")
        .select(
            "weather_condition",
            c("n").alias("shipments"),
            pct(c("late"), c("n")).alias("delay_rate_pct"),
            exact_ratio(c("minutes"), c("timed"), 1).alias("avg_delay_min"),
        )
        .orderBy(F.desc_nulls_first("delay_rate_pct"), "weather_condition")
    )
