"""What the queries share: the landed raw zone, the loaded warehouses, streams and models.

Everything is built by Spark jobs from the given tables, once per application and data
folder, and written below the shared folder of the session.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.plans.contract import ContractError
from haulmark.plans.training import BOOSTED, TrainingConfig, train
from haulmark.plans.warehouse import Warehouse
from haulmark.session import shared_dir, tune
from haulmark.sources.events import read_event_files
from haulmark.sources.lake import register_lake
from haulmark.schemas import RAW_SCHEMA
from haulmark.sources.raw import positioned, raw_key, read_raw, write_raw, write_runs
from haulmark.streaming.sink import EventTable, start_ingest
from workload import feed

# The raw zone holds two runs, split by order date.
HISTORY, RECENT = "19950101", "19990101"
SPLIT_DATE = "1999-01-01"
FEATURE_YEAR = 2026

# Smaller candidates than the defaults, so that one check finishes in minutes, each fitted on all
# training rows; folds run side by side.
TRAINING = TrainingConfig(
    as_of_year=FEATURE_YEAR, trees=20, forest_depth=8, rounds=15, parallelism=5
)

_built: dict[tuple, object] = {}
_lock = RLock()


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _lock:
        if key not in _built:
            tune(spark)
            data = sf_dir.strip("/").replace("/", "-")
            root = f"{shared_dir(spark)}/haulmark/{spark.sparkContext.applicationId}/{data}"
            _built[key] = build(f"{root}/{name}")
        return _built[key]


def raw_root(spark: SparkSession, sf_dir: str) -> str:
    """The landed raw zone: two Parquet runs in record order."""

    def build(root: str) -> str:
        early = F.col("o_orderdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz")
        run = F.when(early, HISTORY).otherwise(RECENT).alias("_run")
        records = feed.to_records(feed.ordered_lines(spark, sf_dir), run)
        write_runs(records, root, "_run", [HISTORY, RECENT])
        return root

    return once(spark, sf_dir, "landing", build)


def raw(spark: SparkSession, sf_dir: str, run: str = "*") -> DataFrame:
    return read_raw(spark, raw_root(spark, sf_dir), run, ("parquet",))


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw records with their position."""
    return once(spark, sf_dir, "placed", lambda root: positioned(raw(spark, sf_dir), root))


def rolled_root(spark: SparkSession, sf_dir: str) -> str:
    """The history run again, by tasks that start a new file after few records.

    Some 300,000 records a task and 250 a file: over a thousand files a task once the
    tables are large enough.
    """

    def build(root: str) -> str:
        tasks = 1 + feed.read(spark, sf_dir, "lineitem").count() // 300_000
        lines = feed.ordered_lines(spark, sf_dir, tasks)
        write_raw(feed.to_records(lines), root, HISTORY, file_rows=250)
        return root

    return once(spark, sf_dir, "landing_rolled", build)


def mixed_root(spark: SparkSession, sf_dir: str) -> str:
    """The two runs by different writers: the second has times as text, numbers as doubles."""

    def build(root: str) -> str:
        records = raw(spark, sf_dir, HISTORY)
        write_raw(records, root, HISTORY)
        loose = {
            name: F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss")
            if kind == "timestamp"
            else F.col(name).cast("double" if kind.startswith("decimal") else kind)
            for name, kind in RAW_SCHEMA.items()
        }
        foreign = raw(spark, sf_dir, RECENT).select(*[c.alias(n) for n, c in loose.items()])
        foreign.write.parquet(f"{root}/{raw_key(RECENT, 'parquet')}")
        return root

    return once(spark, sf_dir, "landing_mixed", build)


def csv_root(spark: SparkSession, sf_dir: str) -> str:
    def build(root: str) -> str:
        write_raw(feed.to_records(feed.order_lines(spark, sf_dir)), root, HISTORY, "csv")
        return root

    return once(spark, sf_dir, "landing_csv", build)


def lake(spark: SparkSession, sf_dir: str) -> str:
    """Name of the catalog table over the raw zone."""

    def build(root: str) -> str:
        table = "raw_" + sf_dir.strip("/").replace("/", "_").replace(".", "_").replace("-", "_")
        register_lake(spark, raw_root(spark, sf_dir), table)
        return table

    return once(spark, sf_dir, "lake", build)


def mixed_lake(spark: SparkSession, sf_dir: str) -> str:
    """Name of the catalog view over the runs of two writers."""

    def build(root: str) -> str:
        table = "mixed_" + sf_dir.strip("/").replace("/", "_").replace(".", "_").replace("-", "_")
        register_lake(spark, mixed_root(spark, sf_dir), table)
        return table

    return once(spark, sf_dir, "lake_mixed", build)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """All raw runs in one load."""

    def build(root: str) -> Warehouse:
        wh = Warehouse(spark, root)
        wh.load(raw(spark, sf_dir))
        return wh

    return once(spark, sf_dir, "warehouse", build)


def grown_warehouse(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, list[dict[str, int]]]:
    """The early run, then all runs, then all runs again; with the new rows of each load."""

    def build(root: str):
        wh = Warehouse(spark, root)
        runs = (HISTORY, "*", "*")
        return wh, [wh.load(raw(spark, sf_dir, run)) for run in runs]

    return once(spark, sf_dir, "grown", build)


def interrupted(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The early run, then a load of all runs that fails on records without a company."""

    def build(root: str) -> Warehouse:
        wh = Warehouse(spark, root)
        wh.load(raw(spark, sf_dir, HISTORY))
        everything = raw(spark, sf_dir)
        nameless = F.when(F.col("delay_minutes") != 7, F.col("company_name"))
        try:
            wh.load(everything.withColumn("company_name", nameless))
        except ContractError:
            return Warehouse(spark, root)
        raise AssertionError("the damaged load went through")

    return once(spark, sf_dir, "interrupted", build)


def _ingest(spark: SparkSession, sf_dir: str, root: str, stateful: bool) -> EventTable:
    """Events and changed copies arrive in one micro-batch, more copies later; then all again.

    The copies stand in newer and larger files. The replay is that of a lost checkpoint.
    """
    inbox = f"{root}/inbox"
    table = EventTable(spark, f"{root}/table")

    def consume(checkpoint: str) -> None:
        messages = read_event_files(spark, inbox)
        query = start_ingest(messages, table, f"{root}/{checkpoint}", stateful, availableNow=True)
        query.awaitTermination()

    feed.event_messages(spark, sf_dir).write.text(inbox)
    feed.repeated_messages(spark, sf_dir).write.mode("append").text(inbox)
    consume("checkpoint")
    feed.later_messages(spark, sf_dir).write.mode("append").text(inbox)
    consume("checkpoint")
    consume("checkpoint-lost")
    return table


def event_table(spark: SparkSession, sf_dir: str) -> EventTable:
    return once(spark, sf_dir, "events", lambda root: _ingest(spark, sf_dir, root, False))


def stateful_event_table(spark: SparkSession, sf_dir: str) -> EventTable:
    return once(spark, sf_dir, "events_state", lambda root: _ingest(spark, sf_dir, root, True))


def models(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the trained model, its metrics and the test predictions."""

    def build(root: str) -> str:
        train(warehouse(spark, sf_dir), root, TRAINING)
        return root

    return once(spark, sf_dir, "models", build)


def logistic_model(spark: SparkSession, sf_dir: str) -> str:
    """Logistic regression at its defaults on all training rows, cross-validated: for timing."""

    def build(root: str) -> str:
        config = TrainingConfig(as_of_year=FEATURE_YEAR, models=("Logistic Regression",))
        train(warehouse(spark, sf_dir), root, config)
        return root

    return once(spark, sf_dir, "logistic", build)


def boosted_model(spark: SparkSession, sf_dir: str) -> str:
    """Second-order boosting of ten rounds on all training rows, with its five folds."""

    def build(root: str) -> str:
        config = TrainingConfig(as_of_year=FEATURE_YEAR, rounds=10, models=(BOOSTED,))
        train(warehouse(spark, sf_dir), root, config)
        return root

    return once(spark, sf_dir, "boosted", build)
