"""Dashboard panel and charts over a filtered extract.

A chart drops rows whose grouping value is NULL; the panel counts every filtered row.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.functions.calendar import WEEKDAYS, ordinal, period_label
from haulmark.functions.conditions import CONGESTION_ORDER, lookup
from haulmark.functions.metrics import money, n_where, ratio

# The driver chart's group size and length.
MIN_TRIPS, TOP_DRIVERS = 5, 10


def options(rows: DataFrame, column: str) -> DataFrame:
    """Distinct values a filter offers."""
    return rows.select(column).distinct().orderBy(column)


def all_options(rows: DataFrame, columns: list[str]) -> DataFrame:
    """filter, value (as text): what several filters offer, in one scan."""
    entries = [
        F.struct(F.lit(name).alias("filter"), F.col(name).cast("string").alias("value"))
        for name in columns
    ]
    return rows.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*").distinct()


def _one_of(column: str, values: list | None) -> Column:
    if values is None:
        return F.lit(True)
    match = F.col(column).isin([value for value in values if value is not None])
    return match | F.col(column).isNull() if None in values else match


def filtered(
    rows: DataFrame,
    years: list[int] | None = None,
    statuses: list[str] | None = None,
    regions: list[str] | None = None,
) -> DataFrame:
    """Keep the chosen years, statuses and regions; no choice keeps all.

    The year filter is also put on the partition column, so other years are not read.
    """
    kept = rows.filter(
        _one_of("year", years) & _one_of("status", statuses) & _one_of("region", regions)
    )
    if years is not None and "pickup_year" in rows.columns:
        kept = kept.filter(_one_of("pickup_year", years))
    return kept


def require_rows(rows: DataFrame) -> DataFrame:
    if rows.isEmpty():
        raise LookupError("no data matches the filters")
    return rows


def panel(rows: DataFrame) -> DataFrame:
    c = F.col
    late = c("is_delayed")
    totals = rows.agg(
        F.count("*").alias("total_shipments"),
        n_where(c("status") == "on_time").alias("on_time"),
        n_where(c("status") == "failed").alias("failed"),
        F.sum(F.when(late, c("delay_minutes"))).alias("late_minutes"),
        F.count(F.when(late, c("delay_minutes"))).alias("late"),
        F.sum("cost_usd").alias("cost"),
    )
    return totals.select(
        "total_shipments",
        (ratio(c("on_time"), c("total_shipments")) * 100).alias("on_time_pct"),
        ratio(c("late_minutes"), c("late")).alias("avg_delay_minutes"),
        money(c("cost")).alias("total_cost_usd"),
        (ratio(c("failed"), c("total_shipments")) * 100).alias("failed_pct"),
    )


def _groups(rows: DataFrame, *keys: str):
    return rows.dropna(subset=list(keys)).groupBy(*keys)


def _delay_rate(rows: DataFrame, key: str) -> DataFrame:
    """Shipments and share of late ones per group; an unknown flag is left out of the share."""
    late = F.col("is_delayed")
    counted = _groups(rows, key).agg(
        F.count("shipment_id").alias("shipments"),
        n_where(late).alias("late"),
        F.count(late).alias("flagged"),
    )
    share = ratio(F.col("late"), F.col("flagged")) * 100
    return counted.select(key, "shipments", share.alias("delay_rate"))


def status_mix(rows: DataFrame) -> DataFrame:
    counted = _groups(rows, "status").agg(F.count("*").alias("shipments"))
    return counted.orderBy(F.desc("shipments"), "status")


def monthly_on_time(rows: DataFrame) -> DataFrame:
    c = F.col
    return (
        _groups(rows, "year", "month", "month_name")
        .agg(
            F.count("shipment_id").alias("total"),
            n_where(c("status") == "on_time").alias("on_time"),
        )
        .withColumns(
            {
                "on_time_pct": ratio(c("on_time"), c("total")) * 100,
                "period": period_label(c("month_name"), c("year")),
            }
        )
        .orderBy("year", "month")
    )


def weekday_delay(rows: DataFrame) -> DataFrame:
    rates = _delay_rate(rows, "weekday").select("weekday", "delay_rate")
    return rates.orderBy(ordinal(F.col("weekday"), WEEKDAYS))


def segment_revenue(rows: DataFrame) -> DataFrame:
    revenue = money(F.sum("cost_usd")).alias("cost_usd")
    return _groups(rows, "segment").agg(revenue).orderBy("cost_usd", "segment")


def monthly_revenue(rows: DataFrame) -> DataFrame:
    return (
        _groups(rows, "year", "month", "month_name")
        .agg(money(F.sum("cost_usd")).alias("cost_usd"))
        .withColumn("period", period_label(F.col("month_name"), F.col("year")))
        .orderBy("year", "month")
    )


def top_drivers(
    rows: DataFrame, min_trips: int = MIN_TRIPS, count: int = TOP_DRIVERS
) -> DataFrame:
    """Best on-time drivers among those with enough trips; all drivers if none has.

    Top-k keeps ``count`` rows per task. The fallback branch is filtered by a one-row
    aggregate and is empty as soon as one driver has enough trips.
    """
    c = F.col
    drivers = (
        _groups(rows, "driver_name")
        .agg(
            F.count("shipment_id").alias("total"),
            n_where(c("status") == "on_time").alias("on_time"),
            F.sum("driver_rating").alias("ratings"),
            F.count("driver_rating").alias("rated"),
        )
        .select(
            "driver_name",
            "total",
            "on_time",
            ratio(c("ratings"), c("rated")).alias("avg_rating"),
            (ratio(c("on_time"), c("total")) * 100).alias("on_time_pct"),
        )
    )
    seasoned = drivers.filter(c("total") >= min_trips)
    best = seasoned.orderBy(F.desc("on_time_pct"), "driver_name").limit(count)
    most = drivers.agg(F.max("total").alias("_most"))
    everyone = drivers.crossJoin(F.broadcast(most)).filter(c("_most") < min_trips).drop("_most")
    return best.unionByName(everyone)


def vehicle_delay(rows: DataFrame) -> DataFrame:
    return _delay_rate(rows, "vehicle_type").orderBy("vehicle_type")


def weather_delay(rows: DataFrame) -> DataFrame:
    rates = _delay_rate(rows, "weather_condition")
    return rates.orderBy(F.desc("delay_rate"), "weather_condition")


def traffic_delay(rows: DataFrame) -> DataFrame:
    rates = _delay_rate(rows, "traffic_condition")
    return rates.orderBy(ordinal(F.col("traffic_condition"), CONGESTION_ORDER))


# The grouping columns of each chart.
CHARTS = {
    "status_mix": ["status"],
    "monthly": ["year", "month", "month_name"],
    "weekday_delay": ["weekday"],
    "segment_revenue": ["segment"],
    "drivers": ["driver_name"],
    "vehicle_delay": ["vehicle_type"],
    "weather_delay": ["weather_condition"],
    "traffic_delay": ["traffic_condition"],
}


def page(rows: DataFrame) -> DataFrame:
    """The measures behind all charts from one scan of the star.

    One row per chart and group, with the additive measures and rates every chart draws
    from. Grouping sets fan a row out only up to the map-side aggregate, which leaves one
    row per group and task.
    """
    c = F.col
    late = c("is_delayed")
    keys = list(dict.fromkeys(key for columns in CHARTS.values() for key in columns))
    grouped = rows.groupingSets([[c(key) for key in columns] for columns in CHARTS.values()], *keys)
    measured = grouped.agg(
        F.grouping_id(*keys).alias("_set"),
        F.count("*").alias("shipments"),
        n_where(c("status") == "on_time").alias("on_time"),
        n_where(late).alias("late"),
        F.count(late).alias("flagged"),
        money(F.sum("cost_usd")).alias("cost_usd"),
        ratio(F.sum("driver_rating"), F.count("driver_rating")).alias("avg_rating"),
    )
    # grouping_id has a bit per key, the first key highest, set where a key is rolled up
    places = {key: 1 << (len(keys) - 1 - i) for i, key in enumerate(keys)}
    sets = {
        chart: sum(place for key, place in places.items() if key not in columns)
        for chart, columns in CHARTS.items()
    }
    chart = lookup(c("_set"), {number: name for name, number in sets.items()}, None)
    named = [
        reduce(and_, [c(key).isNotNull() for key in columns], c("_set") == sets[name])
        for name, columns in CHARTS.items()
    ]
    return measured.filter(reduce(or_, named)).select(
        chart.alias("chart"),
        F.concat_ws(" ", *[c(key).cast("string") for key in keys]).alias("label"),
        "shipments",
        "on_time",
        "late",
        "cost_usd",
        "avg_rating",
        (ratio(c("on_time"), c("shipments")) * 100).alias("on_time_pct"),
        (ratio(c("late"), c("flagged")) * 100).alias("delay_rate"),
    )
