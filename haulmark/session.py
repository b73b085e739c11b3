"""Spark session helper and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL_FOLDERS: dict[str, str] = {}


# Settings that any session, also one made elsewhere, can take at run time. The JVM does
# not compile methods beyond 8,000 bytes of byte code; a stage that generates a larger one
# runs faster as separate operators. Times are stored as numbers, which are smaller than the
# default's and let filters skip row groups. Files are packed by zstd: a fifth smaller, in no more time.
RUNTIME_SETTINGS = {
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "haulmark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the engine relies on; any of them can be overridden.

    Shuffle sizing is left to adaptive execution: many initial partitions, merged at run
    time to the advisory size, skewed ones split.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = RUNTIME_SETTINGS | {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; on a cluster a
    machine-local path would lose data with the machine, so a missing setting is an error.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        folder = tempfile.mkdtemp(prefix="haulmark-")
        context.setCheckpointDir(folder)
        _LOCAL_FOLDERS[context.applicationId] = folder
    return _LOCAL_FOLDERS[context.applicationId]
