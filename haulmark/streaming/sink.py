"""Duplicate-free event table fed by ``foreachBatch``.

The first event with an id is kept for good; there is no time limit after which an id may
come back. Each micro-batch owns the folder ``query_id=<q>/batch_id=<b>`` and replaces it
as a whole, and looks for known ids everywhere but there. A replayed batch therefore gives
the same rows again, and a new checkpoint (new query id, batch ids from 0) cannot overwrite
what an earlier one wrote. One writer per table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from haulmark.operators.first_wins import first_rows
from haulmark.operators.keyed import absent
from haulmark.schemas import REALTIME_TYPES, ddl
from haulmark.sources.events import BROKER_POSITION, FILE_POSITION
from haulmark.sources.objects import ObjectStore
from haulmark.streaming.events import decode, enrich

# The widest text of each event column.
MAX_EVENT_TEXT = {
    "event_id": 36,
    "event_type": 50,
    "shipment_id": 50,
    "status": 20,
    "origin_city": 100,
    "destination_city": 100,
    "vehicle_type": 20,
}
TRIGGER = "10 seconds"
QUARANTINE = {"message": "string", "reason": "string", "message_key": "string"}
_SHARES = 64  # that equal messages are counted in
_MERGED = 32  # reduced Arrow batches that are merged at a time
_PARTITIONS = {"query_id": "string", "batch_id": "bigint"}


def _problem() -> Column:
    """Why an event cannot be stored, or NULL."""
    numbers = [name for name, kind in REALTIME_TYPES.items() if kind.startswith("decimal")]
    misfit = [
        F.col(name).isNotNull() & F.col(name).try_cast(REALTIME_TYPES[name]).isNull()
        for name in numbers
    ]
    too_long = [F.length(name) > width for name, width in MAX_EVENT_TEXT.items()]
    any_of = [F.coalesce(rule, F.lit(False)) for rule in misfit + too_long]
    return F.when(F.col("event_id").isNull(), "no event_id").when(
        reduce(lambda a, b: a | b, any_of), "value does not fit"
    )


class EventTable:
    """The target table and its quarantine below one root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.store = ObjectStore(spark, self.root)

    def _read(self, name: str, schema: dict[str, str], folders: list[str]) -> DataFrame:
        columns = ddl(schema | _PARTITIONS)
        base = f"{self.root}/{name}"
        if not folders:
            return self.spark.createDataFrame([], columns)
        reader = self.spark.read.schema(columns).option("basePath", base)
        return reader.parquet(*[f"{base}/{folder}" for folder in folders])

    def _queries(self, name: str) -> list[str]:
        """One folder per streaming query that ever wrote here."""
        return [folder for folder in self.store.names(name) if folder.startswith("query_id=")]

    def events(self) -> DataFrame:
        schema = REALTIME_TYPES | {"ingested_at": "timestamp"}
        return self._read("events", schema, self._queries("events"))

    def quarantine(self) -> DataFrame:
        return self._read("quarantine", QUARANTINE, self._queries("quarantine"))

    def _known_ids(self, query_id: str, batch_id: int, unique_in_query: bool) -> DataFrame:
        """Ids stored by anything but this very batch; folders without any are not listed."""
        folders = self._queries("events")
        if unique_in_query:
            folders = [folder for folder in folders if folder != f"query_id={query_id}"]
        known = self._read("events", {"event_id": "string"}, folders)
        this_batch = (F.col("query_id") == query_id) & (F.col("batch_id") == batch_id)
        return known.filter(~this_batch).select("event_id")

    def upsert(
        self, batch: DataFrame, query_id: str, batch_id: int, unique_in_query: bool = False
    ) -> None:
        """Store the events of one micro-batch whose id is new; set unusable ones aside.

        ``unique_in_query``: the stream itself already dropped repeated ids, so only what
        other queries wrote has to be searched.
        """
        if "source_row" not in batch.columns:
            in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
            batch = batch.withColumn("source_row", in_task)
        arrival = arrival_order(batch)
        # The text of a message, most of its bytes, is kept for those that are set aside alone.
        text = F.when(F.col("reason").isNotNull(), F.col("message")).alias("message")
        batch = batch.withColumn("reason", _problem()).withColumn("message", text)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            total, bad = batch.agg(F.count("*"), F.count("reason")).first()
            if total > bad:
                good = batch.filter(F.col("reason").isNull())
                self._store_new(good, arrival, query_id, batch_id, unique_in_query, total - bad)
            if bad:
                rejected = batch.filter(F.col("reason").isNotNull())
                self._set_aside(rejected, arrival, query_id, batch_id, bad)
        finally:
            batch.unpersist()

    def _set_aside(
        self, rejected: DataFrame, arrival: list[str], query_id: str, batch_id: int, rows: int
    ) -> None:
        """Keep unusable messages, each once, however often it is replayed.

        A message is known by its place at the broker; in a file by its text and by how many
        of that text stand before it, as line numbers differ with the way files are read. A
        query meets no place twice, so only what other queries set aside is searched.
        """
        if "offset" in arrival:
            place = F.concat_ws("|", *arrival)
        else:
            file = [name for name in ("source_file",) if name in arrival]
            rejected = each_alike(rejected, [*file, "message", "reason"])
            place = F.concat_ws("|", *file, F.col("_ordinal").cast("string"), "message")
        keyed = rejected.select("message", "reason", F.sha2(place, 256).alias("message_key"))
        folders = [f for f in self._queries("quarantine") if f != f"query_id={query_id}"]
        known = self._read("quarantine", QUARANTINE, folders).select("message_key")
        new = absent(keyed, known, ["message_key"], rows) if folders else keyed
        folder = f"query_id={query_id}/batch_id={batch_id}"
        new.select(*QUARANTINE).write.mode("overwrite").parquet(
            f"{self.root}/quarantine/{folder}"
        )

    def _store_new(
        self,
        good: DataFrame,
        arrival: list[str],
        query_id: str,
        batch_id: int,
        unique_in_query: bool,
        rows: int,
    ) -> None:
        known = self._known_ids(query_id, batch_id, unique_in_query)
        first = first_rows(good, ["event_id"], arrival)
        new = absent(first, known, ["event_id"], rows)
        typed = [F.col(name).cast(kind).alias(name) for name, kind in REALTIME_TYPES.items()]
        new.select(*typed, F.current_timestamp().alias("ingested_at")).write.mode(
            "overwrite"
        ).parquet(f"{self.root}/events/query_id={query_id}/batch_id={batch_id}")


def each_alike(rows: DataFrame, key: list[str]) -> DataFrame:
    """The key columns and ``_ordinal``, from 1, of every row: equal rows are counted, not
    sorted, and given back from their counts, a share of each key by a task of its own."""
    share = F.pmod(F.monotonically_increasing_id(), F.lit(_SHARES)).cast("int").alias("_share")
    counts = rows.select(*key, share).groupBy(*key, "_share").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*key).orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(before), F.lit(0))  # of at most _SHARES rows
    dealt = counts.withColumn("_start", start).repartition(*key, "_share")
    ordinals = F.sequence(F.col("_start") + 1, F.col("_start") + F.col("_rows"))
    return dealt.select(*key, F.explode(ordinals).alias("_ordinal"))


def arrival_order(batch: DataFrame) -> list[str]:
    """Columns that order messages by arrival, as far as their source tells."""
    if "offset" in batch.columns:
        return BROKER_POSITION
    return [name for name in FILE_POSITION if name in batch.columns] + ["source_row"]


def row_numbers() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``source_row``: the number of a row within its task, in reading order.

    Made inside a function, so that it travels to the executors by value.
    """

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = 0
        for batch in batches:
            numbers = pa.array(range(rows, rows + batch.num_rows), pa.int64())
            rows += batch.num_rows
            yield batch.append_column("source_row", numbers)

    return numbered


def _first_of_each(rows: pa.Table, order: list[str]) -> pa.Table:
    keys = [(name, "ascending") for name in ("event_id", *order)]
    ranked = rows.take(pc.sort_indices(rows, sort_keys=keys)).combine_chunks()
    ids = ranked.column("event_id")
    if len(ids) < 2:
        return ranked
    new = pa.chunked_array([pa.array([True]), *pc.not_equal(ids[1:], ids[:-1]).chunks])
    return ranked.filter(new).combine_chunks()


def first_in_task(
    order: list[str], whole: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The first message of each id: of each Arrow batch, so that a hot id is few rows before
    a shuffle, or (``whole``) of all that a task reads of a micro-batch."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(_first_of_each(pa.Table.from_batches([batch]), order))
            if not whole:
                yield from held.pop().to_batches()
            elif len(held) == _MERGED:
                held = [_first_of_each(pa.concat_tables(held), order)]
        if held:
            yield from _first_of_each(pa.concat_tables(held), order).to_batches()

    return reduce


def first_of_each_id(events: DataFrame) -> DataFrame:
    """Of a stream: the first event of each id, when its id is met first; and unusable ones.

    The state store keeps ids alone, whatever the width of an event (exact, unbounded, on disk
    with RocksDB), so a batch costs the same however large the table has become. Before that,
    the copies of an id within a micro-batch are reduced to the one that arrived first: in
    each task, and, dealt by id, over all tasks. Only the message travels; it is decoded again
    behind the state. Unusable messages, also those without an id, leave no state.
    """
    schema = StructType([*events.schema.fields, StructField("source_row", LongType())])
    columns = schema.names
    events = events.mapInArrow(row_numbers(), schema).withColumn("_problem", _problem())
    order = arrival_order(events)
    narrow = events.filter(F.col("_problem").isNull()).select("event_id", "message", *order)
    dealt = narrow.mapInArrow(first_in_task(order, False), narrow.schema).repartition("event_id")
    first = dealt.mapInArrow(first_in_task(order, True), narrow.schema).select("event_id", "message")
    new = first.dropDuplicates(["event_id"])  # one row an id and micro-batch: no choice is left
    decoded = enrich(decode(new.select(F.col("message").alias("value")))).drop("message")
    again = decoded.select(
        *[
            F.col(name) if name in decoded.columns else F.lit(None).cast(schema[name].dataType).alias(name)
            for name in columns
        ]
    )
    unusable = events.filter(F.col("_problem").isNotNull()).drop("_problem")
    return again.unionByName(unusable)


def start_ingest(
    messages: DataFrame,
    table: EventTable,
    checkpoint: str,
    stateful: bool = True,
    **trigger: object,
) -> StreamingQuery:
    """Decode, enrich and upsert a stream of messages.

    By default seen ids are kept in the query's state store and the table is not searched for
    them. ``stateful=False`` keeps no state and searches the whole table for the ids of each
    micro-batch instead: for tables that stay small, or are read rarely. Both keep the copy
    that arrived first.
    """
    events = enrich(decode(messages))
    if stateful:
        events = first_of_each_id(events)
    spark = table.spark

    def write(batch: DataFrame, batch_id: int) -> None:
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        table.upsert(batch, query_id, batch_id, unique_in_query=stateful)

    return (
        events.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )
