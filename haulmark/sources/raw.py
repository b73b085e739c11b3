"""The raw zone: shipment records in CSV or Parquet, one object key per run.

A key such as ``raw/shipments_20240101.parquet`` is a single file or, when a Spark job
wrote it, a folder of part files. Both are read the same way.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatch
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmark.operators.keyed import sized
from haulmark.schemas import RAW_SCHEMA, ddl
from haulmark.sources.objects import ObjectStore

PREFIX = "raw/shipments_"
FORMATS = ("csv", "parquet")
FOOTERS_AT_ONCE = 16

# Records compare by run key, then by position within the run: number of the part file, its
# counter (a writer that rolls files over counts them), its name where those are equal, row.
ORDER = ["raw_file", "_part", "_counter", "_name", "_row"]
POSITION = "_position"  # the same order as one number, see :func:`positioned`
_FILES = {"_path": "string", "raw_file": "string", "_start": "bigint"}


def raw_key(run: str, fmt: str) -> str:
    return f"{PREFIX}{run}.{fmt}"


def write_raw(
    records: DataFrame, root: str, run: str, fmt: str = "parquet", file_rows: int = 0
) -> str:
    """Write one run in record column order and return its key.

    ``file_rows``: a task starts a new file after so many records (0: one file per task).
    """
    key = raw_key(run, fmt)
    writer = records.select(*RAW_SCHEMA).write.mode("overwrite")
    writer = writer.option("maxRecordsPerFile", file_rows)
    if fmt == "parquet":
        writer.option("compression", "snappy").parquet(f"{root}/{key}")
    elif fmt == "csv":
        # A third of the plain text's size, at the fastest level. One task reads a packed part, so
        # it has as many rows as the task that wrote it.
        packed = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        packed.option("header", True).csv(f"{root}/{key}")
    else:
        raise ValueError(f"unknown raw format {fmt!r}, use one of {FORMATS}")
    return key


def write_runs(records: DataFrame, root: str, column: str, runs: list[str]) -> None:
    """Write the given runs as Parquet in record column order, by one pass over the records.

    ``column`` names each record's run and is not written. Every task keeps a file open for each
    run, so records keep their order and are not sorted by run.
    """
    spark, store, staging = records.sparkSession, ObjectStore(records.sparkSession, root), "_runs"
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, max(len(runs), int(before)))
    try:
        (
            records.select(*RAW_SCHEMA, column)
            .write.mode("overwrite")
            .option("compression", "snappy")
            .option("partitionOverwriteMode", "static")
            .partitionBy(column)
            .parquet(f"{root}/{staging}")
        )
    finally:
        spark.conf.set(writers, before)
    for run in runs:
        written = f"{staging}/{column}={run}"
        if store.exists(written):
            store.move(written, raw_key(run, "parquet"))
        else:
            write_raw(records.limit(0), root, run)
    store.remove(staging)


def _lineage(row: Column) -> dict[str, Column]:
    """Run key and the position of a record within its run.

    The numbers are read in full from names such as ``part-00012-<id>-c1034.snappy.parquet``;
    a file without them has 0 and goes by its name. All but the row are the same for a whole
    file, so "first record" is a hash aggregate whose only buffer is the row.
    """
    path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    run = F.substring_index(F.substring_index(path, f"/{PREFIX}", -1), "/", 1)
    return {
        "raw_file": F.concat(F.lit(PREFIX), run),
        "_part": _number(F.regexp_extract(name, r"^part-(\d+)", 1)),
        "_counter": _number(F.regexp_extract(name, r"-c(\d+)[^-]*$", 1)),
        "_name": name,
        "_path": path,
        "_row": row,
    }


def _number(digits: Column) -> Column:
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def positioned(raw: DataFrame, staging: str) -> DataFrame:
    """The records with ``_position``, their place in ORDER as one number, in its stead.

    The files are put in order and their starts written to ``staging`` once, so that no job
    reads the numbers out of each record's file name again, and whatever looks for a first
    record carries one number. A position is the rows of the files before plus the row, so it
    has no bounds of its own.
    """
    spark = raw.sparkSession
    found = raw.groupBy("_path", "_name").agg((F.max("_row") + 1).alias("_rows"))
    meta = F.struct(F.col("_path").alias("file_path"), F.col("_name").alias("file_name"))
    names = ("raw_file", "_part", "_counter")
    lineage = {name: c for name, c in _lineage(F.lit(0)).items() if name in names}
    placed = found.withColumn("_metadata", meta).withColumns(lineage)
    # One row a file, so the window is small however many records there are.
    in_order = Window.orderBy(*ORDER[:-1], "_path")
    before = F.sum("_rows").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(before, F.lit(0)).cast("bigint").alias("_start")
    placed.select("_path", "raw_file", start).write.mode("overwrite").parquet(staging)
    files = spark.read.schema(ddl(_FILES)).parquet(staging)
    joined = raw.drop(*ORDER[:-1]).join(sized(files, files.count()), "_path")
    return joined.withColumn(POSITION, F.col("_start") + F.col("_row")).drop(
        "_path", "_start", "_row"
    )


def _read_csv(spark: SparkSession, locations: list[str], multi_line: bool) -> DataFrame:
    """Declared types, header checked against the schema, a bad value fails the read.

    CSV has no row index. A scan task numbers its rows in file order; a task holds one
    full block or several file ends, and a row takes at least a byte, so block start plus
    running number ascends over the whole file.
    """
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    row = F.col("_metadata.file_block_start") + in_task
    return (
        spark.read.schema(ddl(RAW_SCHEMA))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .csv(locations)
        .withColumns(_lineage(row))
    )


def _read_parquet(spark: SparkSession, locations: list[str]) -> DataFrame:
    """Runs of different writers: those of one schema are read and cast together.

    A run has one writer, so one footer per run tells its schema; footers are read side by
    side. A column that a run lacks is an error that names both.
    """
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        schemas = list(pool.map(lambda path: spark.read.parquet(path).schema, locations))
    alike: dict[str, list[str]] = {}
    for path, schema in zip(locations, schemas, strict=True):
        missing = [name for name in RAW_SCHEMA if name not in schema.fieldNames()]
        if missing:
            raise ValueError(f"raw run {path} lacks columns {missing}")
        kinds = "|".join(f"{name} {schema[name].dataType.simpleString()}" for name in RAW_SCHEMA)
        alike.setdefault(kinds, []).append(path)
    typed = [F.col(name).cast(kind).alias(name) for name, kind in RAW_SCHEMA.items()]
    lineage = [c.alias(name) for name, c in _lineage(F.col("_metadata.row_index")).items()]
    frames = [spark.read.parquet(*paths).select(*typed, *lineage) for paths in alike.values()]
    return reduce(DataFrame.unionByName, frames)


def raw_keys(spark: SparkSession, root: str, formats: tuple[str, ...] = FORMATS) -> list[str]:
    """Keys of all raw runs; an absent zone is an error. One key per run, not per file."""
    folder, _, start = PREFIX.rpartition("/")
    endings = tuple(f".{fmt}" for fmt in formats)
    names = ObjectStore(spark, root).names(folder)
    keys = [f"{folder}/{n}" for n in names if n.startswith(start) and n.endswith(endings)]
    if not keys:
        raise FileNotFoundError(f"no {PREFIX}* in {root} ({', '.join(formats)})")
    return keys


def read_keys(
    spark: SparkSession, root: str, keys: list[str], multi_line: bool = False
) -> DataFrame:
    """Every record of the given runs with its ``raw_file`` and position."""
    frames = []
    csv = [f"{root}/{key}" for key in keys if key.endswith(".csv")]
    parquet = [f"{root}/{key}" for key in keys if key.endswith(".parquet")]
    if csv:
        frames.append(_read_csv(spark, csv, multi_line))
    if parquet:
        frames.append(_read_parquet(spark, parquet))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), frames)


def read_raw(
    spark: SparkSession,
    root: str,
    run: str = "*",
    formats: tuple[str, ...] = FORMATS,
    multi_line: bool = False,
) -> DataFrame:
    """All raw records, or those of the runs a pattern selects."""
    wanted = [raw_key(run, fmt) for fmt in formats]
    keys = raw_keys(spark, root, formats)
    keys = [key for key in keys if any(fnmatch(key, pattern) for pattern in wanted)]
    if not keys:
        raise FileNotFoundError(f"no {PREFIX}{run} in {root} ({', '.join(formats)})")
    return read_keys(spark, root, keys, multi_line)
