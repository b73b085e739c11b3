"""Data-quality checks on the warehouse tables, their report and the pipeline gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.functions.conditions import STATUSES
from haulmark.functions.metrics import n_where
from haulmark.plans.summaries import NON_NEGATIVE, measured
from haulmark.plans.warehouse import Warehouse
from haulmark.schemas import TABLES

# Checks that stop the pipeline, and the columns each check looks at.
CRITICAL = ["row_counts", "null_foreign_keys", "orphan_records"]
ORPHAN_CHECKED = {
    "customer_id": "dim_customer",
    "driver_id": "dim_driver",
    "vehicle_id": "dim_vehicle",
    "route_id": "dim_route",
}
MIN_RATING, MAX_RATING = 1.0, 5.0


class CriticalCheckFailed(RuntimeError):
    """A critical check failed, so the steps after it must not run."""


def warehouse_tables(wh: Warehouse) -> dict[str, DataFrame]:
    return {name: wh.table(name) for name in TABLES}


def _result(counts: DataFrame, check: str, detail: Column, violations: Column) -> DataFrame:
    return counts.select(
        F.lit(check).alias("check_name"),
        detail.alias("detail"),
        F.lit(check in CRITICAL).alias("critical"),
        violations.cast("bigint").alias("violations"),
    )


def _fact_checks(per_status: DataFrame) -> DataFrame:
    """Row count, NULL keys, bad statuses, negatives and delay flags from measures per status.

    Statuses are few, and the number of distinct bad ones is then a count of groups instead of
    a distinct aggregate.
    """
    c = F.col
    negative = [f"negative_{name}" for name in NON_NEGATIVE]
    summed = ["n", "no_key", "flag_off", *negative]
    totals = per_status.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in summed],
        n_where(~c("status").isin(STATUSES)).alias("bad_status"),
    )

    def entry(check: str, detail: str, violations: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check_name"),
            F.lit(detail).alias("detail"),
            F.lit(check in CRITICAL).alias("critical"),
            violations.cast("bigint").alias("violations"),
        )

    entries = [
        entry("row_counts", "fact_shipments", (c("n") == 0).cast("int")),
        entry("null_foreign_keys", "fact_shipments", c("no_key")),
        entry("invalid_status", "distinct values", c("bad_status")),
        *[entry("negative_values", name, c(f"negative_{name}")) for name in NON_NEGATIVE],
        entry("delay_consistency", "fact_shipments", c("flag_off")),
    ]
    return totals.select(F.inline(F.array(*entries)))


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Number of facts whose reference is NULL or not in the dimension.

    The fact is counted per key first, so the anti join sees each key once, however many
    facts share it.
    """
    per_key = fact.groupBy(key).agg(F.count("*").alias("n"))
    lost = per_key.join(dimension.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def lost_references(tables: dict[str, DataFrame]) -> DataFrame:
    """foreign_key, n: as :func:`orphans`, for all checked keys in one scan of the fact."""
    fact = tables["fact_shipments"]
    entries = [
        F.struct(F.lit(key).alias("foreign_key"), F.col(key).cast("bigint").alias("id"))
        for key in ORPHAN_CHECKED
    ]
    used = fact.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")
    return _lost(used.groupBy("foreign_key", "id").agg(F.count("*").alias("n")), tables)


def _lost(per_key: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """foreign_key, n: how many of the counted references (foreign_key, id, n) are unknown."""
    known = reduce(
        DataFrame.unionByName,
        [
            tables[name].select(F.lit(key).alias("foreign_key"), F.col(key).cast("bigint").alias("id"))
            for key, name in ORPHAN_CHECKED.items()
        ],
    )
    lost = per_key.join(known, ["foreign_key", "id"], "left_anti").select("foreign_key", "n")
    none = per_key.sparkSession.createDataFrame(
        [(key, 0) for key in ORPHAN_CHECKED], "foreign_key string, n bigint"
    )
    return lost.unionByName(none).groupBy("foreign_key").agg(F.sum("n").alias("n"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, rows: counted from file footers where the table is as stored."""
    counts = [
        table.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def duplicate_shipments(fact: DataFrame) -> DataFrame:
    """Customer and pickup-time combinations that occur more than once."""
    combos = fact.groupBy("customer_id", "scheduled_pickup").agg(F.count("*").alias("shipments"))
    return combos.filter(F.col("shipments") > 1)


def details(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per measured detail: check_name, detail, critical, violations, passed."""
    fact = tables["fact_shipments"]
    combos = duplicate_shipments(fact).agg(F.count("*").alias("n"))
    return _details(measured(fact, "status"), lost_references(tables), combos, tables)


def warehouse_details(wh: Warehouse) -> DataFrame:
    """As :func:`details` of the warehouse's tables, from what its loads have summed up: no
    fact is read. Loads of an older version, without summaries, have their facts scanned."""
    tables = warehouse_tables(wh)
    per_status = wh.summary("status")
    if per_status is None:
        return details(tables)
    used = [
        wh.summary(key).select(F.lit(key).alias("foreign_key"), F.col(key).alias("id"), "n")
        for key in ORPHAN_CHECKED
    ]
    lost = _lost(reduce(DataFrame.unionByName, used), tables)
    return _details(per_status, lost, wh.repeated_pickup_count(), tables)


def _details(
    per_status: DataFrame, lost: DataFrame, combos: DataFrame, tables: dict[str, DataFrame]
) -> DataFrame:
    parts = [_fact_checks(per_status)]
    for name, table in tables.items():
        if name != "fact_shipments":
            empty = table.limit(1).agg((F.count("*") == 0).cast("int").alias("n"))
            parts.append(_result(empty, "row_counts", F.lit(name), F.col("n")))
    parts.append(_result(lost, "orphan_records", F.col("foreign_key"), F.col("n")))
    rating = F.col("rating")
    out_of_range = tables["dim_driver"].agg(
        n_where((rating < MIN_RATING) | (rating > MAX_RATING)).alias("n")
    )
    parts.append(_result(out_of_range, "driver_ratings", F.lit("dim_driver"), F.col("n")))
    parts.append(
        _result(combos, "duplicate_shipments", F.lit("customer_id, scheduled_pickup"), F.col("n"))
    )
    found = reduce(lambda a, b: a.unionByName(b), parts)
    return found.withColumn("passed", F.col("violations") == 0)


def report(measured: DataFrame) -> DataFrame:
    """One row per check: it passes if all its details do."""
    return (
        measured.groupBy("check_name", "critical")
        .agg(F.sum("violations").alias("violations"), F.every("passed").alias("passed"))
        .orderBy("check_name")
    )


def gate(measured: DataFrame) -> dict[str, bool]:
    """Pass flag per check; raises if a critical one failed (the result has 8 rows)."""
    rows = report(measured).collect()
    failed = [row["check_name"] for row in rows if row["critical"] and not row["passed"]]
    if failed:
        raise CriticalCheckFailed(f"critical checks failed: {failed}")
    return {row["check_name"]: row["passed"] for row in rows}
