"""The daily job: load what landed, check the warehouse, retrain if the checks allow it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haulmark.plans.quality import gate, warehouse_details
from haulmark.plans.training import TrainingConfig, train
from haulmark.plans.warehouse import Warehouse
from haulmark.sources.raw import FORMATS, raw_keys, read_keys


def load_step(
    spark: SparkSession,
    lake_root: str,
    warehouse_root: str,
    formats: tuple[str, ...] = FORMATS,
    reread: bool = False,
) -> dict[str, int]:
    """Load the raw runs no earlier load has read; ``reread`` takes all of them again."""
    warehouse = Warehouse(spark, warehouse_root)
    found = raw_keys(spark, lake_root, formats)
    known = set() if reread else warehouse.loaded_runs()
    fresh = [key for key in found if key not in known]
    if not fresh:
        return {}
    text = any(key.endswith(".csv") for key in fresh)
    return warehouse.load(read_keys(spark, lake_root, fresh), fresh, stage=text)


def check_step(spark: SparkSession, warehouse_root: str, report_path: str) -> dict[str, bool]:
    """Write the report first, then stop if a critical check failed."""
    measured = warehouse_details(Warehouse(spark, warehouse_root))
    measured.coalesce(1).write.mode("overwrite").json(report_path)  # about twenty rows
    return gate(spark.read.schema(measured.schema).json(report_path))


def train_step(
    spark: SparkSession, warehouse_root: str, model_root: str, config: TrainingConfig
) -> DataFrame:
    return train(Warehouse(spark, warehouse_root), model_root, config)


def run_daily(
    spark: SparkSession,
    lake_root: str,
    warehouse_root: str,
    model_root: str,
    report_path: str,
    config: TrainingConfig,
) -> dict[str, object]:
    """The three steps in order; each can be called alone."""
    loaded = load_step(spark, lake_root, warehouse_root)
    checks = check_step(spark, warehouse_root, report_path)
    metrics = train_step(spark, warehouse_root, model_root, config)
    return {"loaded": loaded, "checks": checks, "metrics": metrics}
