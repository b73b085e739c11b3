"""Additive summaries of the fact, written once per load and merged by the queries.

A load is small next to history. Its facts are counted per status, per reference and per
condition, so that KPIs, scorecards and quality checks add up a few rows per load instead of
scanning all facts again.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.functions.conditions import LATE_AFTER
from haulmark.functions.metrics import n_where
from haulmark.operators.keyed import sized

# Columns that facts are counted by.
KEYS = {
    "status": "string",
    "date_id": "bigint",
    "customer_id": "bigint",
    "driver_id": "bigint",
    "vehicle_id": "bigint",
    "route_id": "bigint",
    "weather_condition": "string",
    "traffic_condition": "string",
}
REFERENCES = ["customer_id", "driver_id", "vehicle_id", "route_id", "date_id"]
# Measures that no shipment may have below zero.
NON_NEGATIVE = ["cost_usd", "weight_kg", "distance_km", "fuel_consumed_liters"]
COMBINATION = ["customer_id", "scheduled_pickup"]

SUMMARY = {
    "key": "string",
    "number": "bigint",
    "label": "string",
    "n": "bigint",
    "listed": "bigint",
    "on_time": "bigint",
    "failed": "bigint",
    "late": "bigint",
    "late_minutes": "bigint",
    "late_timed": "bigint",
    "minutes": "bigint",
    "timed": "bigint",
    "cost": "decimal(38,2)",
    "priced": "bigint",
    "no_key": "bigint",
    "flag_off": "bigint",
    **{f"negative_{name}": "bigint" for name in NON_NEGATIVE},
}
PICKUPS = {"customer_id": "bigint", "scheduled_pickup": "timestamp", "n": "bigint"}
REPEATED = {name: PICKUPS[name] for name in COMBINATION}
MEASURES = [name for name in SUMMARY if name not in ("key", "number", "label")]


def _in_cents(fact: DataFrame) -> DataFrame:
    """With the cost as a whole number, once a fact: sums of long decimals are no fast buffers."""
    return fact.withColumn("_cents", (F.col("cost_usd") * 100).cast("bigint"))


def measures() -> list[Column]:
    """What is counted of :func:`_in_cents` facts; every measure of two sets of facts is the sum
    of theirs. The cents of one load's facts fit a long, or the sum fails."""
    c = F.col
    no_key = reduce(lambda a, b: a | b, [c(key).isNull() for key in REFERENCES])
    flag_off = (c("is_delayed") & (c("delay_minutes") <= LATE_AFTER)) | (
        ~c("is_delayed") & (c("delay_minutes") > LATE_AFTER)
    )
    late_minutes = F.when(c("is_delayed"), c("delay_minutes"))
    found = {
        "n": F.count("*"),
        "listed": n_where(~no_key),
        "on_time": n_where(c("status") == "on_time"),
        "failed": n_where(c("status") == "failed"),
        "late": n_where(c("is_delayed")),
        "late_minutes": F.sum(late_minutes),
        "late_timed": F.count(late_minutes),
        "minutes": F.sum("delay_minutes"),
        "timed": F.count("delay_minutes"),
        "cost": F.sum("_cents").cast("decimal(20,0)") * F.lit(Decimal("0.01")),
        "priced": F.count("cost_usd"),
        "no_key": n_where(no_key),
        "flag_off": n_where(flag_off),
        **{f"negative_{name}": n_where(c(name) < 0) for name in NON_NEGATIVE},
    }
    return [column.cast(SUMMARY[name]).alias(name) for name, column in found.items()]


def measured(fact: DataFrame, key: str) -> DataFrame:
    """The measures of each value of one key column, NULL included, from the facts."""
    return _in_cents(fact).groupBy(key).agg(*measures())


def summarise(fact: DataFrame) -> DataFrame:
    """The measures for all keys in one scan; copies are reduced before the shuffle."""
    entries = [
        F.struct(
            F.lit(name).alias("key"),
            (F.col(name) if kind == "bigint" else F.lit(None)).cast("bigint").alias("number"),
            (F.col(name) if kind == "string" else F.lit(None)).cast("string").alias("label"),
        )
        for name, kind in KEYS.items()
    ]
    keyed = _in_cents(fact).withColumn("_e", F.explode(F.array(*entries))).select("*", "_e.*")
    return keyed.groupBy("key", "number", "label").agg(*measures())


def merged(summary: DataFrame, key: str) -> DataFrame:
    """As :func:`measured`, from the summaries of all loads."""
    value = F.col("number" if KEYS[key] == "bigint" else "label").alias(key)
    rows = summary.filter(F.col("key") == key)
    totals = [F.sum(name).cast(SUMMARY[name]).alias(name) for name in MEASURES]
    return rows.groupBy(value).agg(*totals)


def combinations(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*COMBINATION).agg(F.count("*").alias("n"))


def repeated_inside(new: DataFrame) -> DataFrame:
    """Combinations that occur twice in one load, from its combinations and their counts."""
    return new.filter(F.col("n") > 1).select(*COMBINATION)


def repeated(
    new: DataFrame, known: DataFrame, rows: int, suspects: DataFrame | None = None
) -> DataFrame:
    """Combinations of one load that occur twice in it, or before it.

    Known ones are cut down to those of the load by a semi join, a small load being sent
    against a scan of two narrow columns; NULL counts as a value, as in a grouping.
    ``suspects``: the load's combinations that may be known, if others are not. ``rows`` is
    their number, or that of the load's combinations.
    """

    def same(left: DataFrame, right: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in COMBINATION])

    batch = sized((new if suspects is None else suspects).select(*COMBINATION), rows)
    before = known.select(*COMBINATION)
    before = before.join(batch, same(before, batch), "left_semi")
    return before.unionByName(repeated_inside(new)).distinct()


def repeated_pickups(pickups: DataFrame, again: DataFrame) -> DataFrame:
    """customer_id, scheduled_pickup, shipments of all combinations that occur more than once."""
    wanted = again.distinct()
    on = [pickups[n].eqNullSafe(wanted[n]) for n in COMBINATION]
    found = pickups.join(wanted, reduce(lambda a, b: a & b, on), "left_semi")
    return found.groupBy(*COMBINATION).agg(F.sum("n").alias("shipments"))
