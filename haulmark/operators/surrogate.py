"""Surrogate keys: dense ascending numbers in natural-key order, without one big sort task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# monotonically_increasing_id() = partition index << 33 | row within the partition
_ROW_BITS = 33


def stage_in_order(rows: DataFrame, keys: list[str], path: str) -> None:
    """Write rows range-partitioned and sorted by key, each with its slot in that order.

    Slots depend on the sampled range bounds, so they are fixed by writing them; all
    later reads, also after a lost executor, see the same ones.
    """
    slot = F.monotonically_increasing_id().alias("_slot")
    (
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("*", slot)
        .write.mode("overwrite")
        .parquet(path)
    )


def numbered(spark: SparkSession, path: str, id_column: str, base: int) -> DataFrame:
    """Staged rows with ``base + 1 .. base + n`` in key order.

    Only one row per partition of the staged table is needed to know where each
    partition's numbers start, so the window below never sees more than that.
    """
    part = F.shiftright("_slot", _ROW_BITS)
    row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    staged = spark.read.parquet(path).withColumn("_part", part)
    before = F.sum("_rows").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        staged.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    )
    number = F.lit(base + 1) + F.col("_start") + row
    return (
        staged.join(F.broadcast(starts), "_part")
        .withColumn(id_column, number.cast("bigint"))
        .drop("_part", "_start", "_slot")
    )
