"""Tables of the data folder, intermediate tables on the shared folder, row numbers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmark.session import shared_dir

_INDEX_BITS = 33  # monotonically_increasing_id: partition number above, row index below


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a new table on the shared folder: cuts lineage, survives executors."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    found = spark.read.schema(frame.schema).parquet(path)
    found.written_at = path
    return found


def remove(*frames: DataFrame) -> None:
    """Delete written tables that nothing reads any more: what came of them is written too."""
    for frame in frames:
        context = frame.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(frame.written_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def numbered(frame: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Add the row's place, from 0 and without gaps, in the given order of all rows.

    Rows are dealt by range and sorted in their partitions, so no task sees them all; a
    row's place is its index there plus the rows of the partitions before. ``frame`` is read
    twice (range sampling, then dealing): pass a scan or a written table. Rows that tie in
    ``order`` are numbered in any way, so give equal rows only.
    """
    dealt = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    slots = written(dealt.withColumn("_slot", F.monotonically_increasing_id()), "slots")
    part = F.shiftright("_slot", _INDEX_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (  # one row per partition
        slots.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    index = F.col("_slot").bitwiseAND((1 << _INDEX_BITS) - 1)
    return (
        slots.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + index)
        .drop("_part", "_start", "_slot")
    )


def fresh(name: str, taken: list[str]) -> str:
    """The name, with underscores appended until no kept column has it."""
    known = {column.lower() for column in taken}
    while name.lower() in known:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut small, so that few texts are Python strings at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_texts(
    docs: DataFrame,
    keep: list[str],
    added: dict[str, str],
    worker: Callable[[list[str | None]], Iterator[tuple[int, int, list[pa.Array]]]],
    finish: Callable[[], None] = lambda: None,
) -> DataFrame:
    """``keep`` columns and the added ones, worked out from the texts in Arrow batches.

    ``worker`` gets a batch's texts and yields (first row, rows, arrays of the added columns).
    ``added`` has their types by name; one that a kept column has gets underscores appended.
    ``finish`` is called at the end of each task, to give back what it remembered.
    """
    inner = [f"_k{i}" for i in range(len(keep))]
    sent = [F.col("text").alias("_text")] + [
        F.col(c).alias(n) for c, n in zip(keep, inner, strict=True) if c != "text"
    ]
    held = ["_text" if c == "text" else n for c, n in zip(keep, inner, strict=True)]
    names = [f"_a{i}" for i in range(len(added))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in slices(batches):
                for start, n, arrays in worker(batch.column("_text").to_pylist()):
                    part = batch.slice(start, n)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(h) for h in held] + arrays, names=inner + names
                    )
        finally:
            finish()

    kinds = [docs.schema[c].dataType.simpleString() for c in keep]
    schema = ", ".join(
        f"`{n}` {k}" for n, k in zip(inner + names, kinds + list(added.values()), strict=True)
    )
    mapped = docs.select(*sent).mapInArrow(run, schema)
    outer = [*keep, *[fresh(name, keep) for name in added]]
    return mapped.select(
        *[F.col(a).alias(b) for a, b in zip(inner + names, outer, strict=True)]
    )
