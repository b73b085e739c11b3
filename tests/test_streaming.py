"""Event stream: first event kept, replays harmless, unusable messages set aside."""

import json
import time
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from haulmark.schemas import EVENT_SCHEMA, ddl
from haulmark.sources.events import publish_frame, read_event_files
from haulmark.streaming.events import decode, enrich
from haulmark.streaming.sink import (
    EventTable,
    each_alike,
    first_in_task,
    row_numbers,
    start_ingest,
)

BASE = {
    "event_type": "STATUS_UPDATE",
    "event_timestamp": "2024-02-03T10:00:00.250000",
    "shipment_id": "RT-1",
    "status": "PENDING",
    "origin_city": "Lyon",
    "destination_city": "Turin",
    "vehicle_type": "VAN",
    "weight_kg": 10.125,
    "distance_km": 4.0,
    "revenue": 10.0,
    "is_delayed": False,
    "delay_hours": 0.0,
    "driver_rating": 4.0,
    "temperature_c": 41.0,
    "humidity_pct": 50.0,
}


def event(number, **changes):
    return json.dumps({"event_id": str(number)} | BASE | changes)


class Feed:
    def __init__(self, spark, root):
        self.spark, self.root, self.files = spark, root, 0
        (root / "inbox").mkdir()
        self.table = EventTable(spark, f"file:{root}/table")

    def arrive(self, *messages):
        self.files += 1
        (self.root / "inbox" / f"{self.files:04d}.json").write_text("\n".join(messages) + "\n")

    def run(self, checkpoint="checkpoint", stateful=False, files_per_trigger=1):
        messages = read_event_files(self.spark, f"file:{self.root}/inbox", files_per_trigger)
        path = f"file:{self.root}/{checkpoint}"
        start_ingest(
            messages, self.table, path, stateful, availableNow=True
        ).awaitTermination()

    def stored(self):
        rows = self.table.events().select("event_id", F.col("revenue").cast("double")).collect()
        assert len({r["event_id"] for r in rows}) == len(rows)
        return {r["event_id"]: r["revenue"] for r in rows}


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


@pytest.mark.parametrize("stateful", [False, True])
def test_first_event_is_kept_across_batches_and_restarts(feed, stateful):
    feed.arrive(event(1), event(2), event(1, revenue=11.0))
    feed.arrive(event(2, revenue=22.0), event(3))
    feed.run(stateful=stateful)
    feed.arrive(event(3, revenue=33.0), event(4, event_timestamp="2020-01-01T00:00:00"))
    feed.run(stateful=stateful)
    assert feed.stored() == {"1": 10.0, "2": 10.0, "3": 10.0, "4": 10.0}
    before = feed.stored()
    feed.run("lost-checkpoint", stateful=stateful)  # everything arrives once more
    assert feed.stored() == before


@pytest.mark.parametrize("stateful", [False, True])
def test_one_id_owns_a_third_of_a_batch(feed, stateful):
    rows = [event("hot" if n % 3 == 0 else n, revenue=float(n)) for n in range(900)]
    feed.arrive(*rows)
    feed.run(stateful=stateful)
    assert feed.stored() == {"hot": 0.0} | {str(n): float(n) for n in range(900) if n % 3}


@pytest.mark.parametrize("stateful", [False, True])
def test_first_copy_of_several_files_in_one_batch(feed, stateful):
    """Changed copies in newer and much larger files, which Spark reads first."""
    feed.arrive(*[event(n) for n in range(200)])
    time.sleep(0.05)
    feed.arrive(*[event(n, revenue=99.0, note="x" * 4000) for n in range(200)])
    feed.run(stateful=stateful, files_per_trigger=10)
    assert feed.stored() == {str(n): 10.0 for n in range(200)}


def test_rows_are_numbered_across_batches():
    parts = [pa.record_batch({"n": pa.array(range(k))}) for k in (2, 0, 3)]
    found = [b.column("source_row").to_pylist() for b in row_numbers()(iter(parts))]
    assert found == [[0, 1], [], [2, 3, 4]]


def test_lookups_do_not_grow_with_the_table(feed, monkeypatch):
    """Known ids are in the state, so the query's own folders are never read."""
    searched = []
    read = EventTable._read

    def watch(self, name, schema, folders):
        searched.append(folders)
        return read(self, name, schema, folders)

    monkeypatch.setattr(EventTable, "_read", watch)
    for n in range(4):
        feed.arrive(event(n), event(0, revenue=77.0), "broken")
    feed.run(stateful=True)
    assert searched and not any(searched)
    assert feed.stored() == {str(n): 10.0 for n in range(4)}


@pytest.mark.parametrize("stateful", [False, True])
def test_quarantine_is_the_same_after_a_replay(feed, stateful):
    feed.arrive("broken", "broken", event(1), "other")
    feed.arrive("broken", event(2, event_id=None))
    feed.run(stateful=stateful)
    before = sorted(r["message"] for r in feed.table.quarantine().collect())
    assert len(before) == 5
    feed.run("lost", stateful=stateful, files_per_trigger=5)
    assert sorted(r["message"] for r in feed.table.quarantine().collect()) == before


def test_equal_messages_are_numbered_from_counts(spark):
    rows = spark.range(5_000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 5 as string)) AS message", "'f' AS source_file")
    found = each_alike(rows, ["source_file", "message"]).collect()
    wanted = {r["message"]: r["count"] for r in rows.groupBy("message").count().collect()}
    numbers = {}
    for r in found:
        numbers.setdefault(r["message"], []).append(r["_ordinal"])
    assert {m: sorted(n) for m, n in numbers.items()} == {m: [*range(1, n + 1)] for m, n in wanted.items()}


def test_state_does_not_hold_events(spark, feed):
    """The state is the id, however wide its event is."""
    feed.arrive(*[event(n, note="x" * 10_000 * (n % 2)) for n in range(20)])
    feed.run(stateful=True)
    state = spark.read.format("statestore").load(f"file:{feed.root}/checkpoint")
    held = [json.loads(r[0]) for r in state.select(F.to_json(F.struct("key", "value"))).collect()]
    assert sorted(r["key"]["event_id"] for r in held) == sorted(str(n) for n in range(20))
    assert all(set(r["key"]) == {"event_id"} and len(json.dumps(r)) < 80 for r in held)
    assert feed.stored() == {str(n): 10.0 for n in range(20)}


def test_first_of_each_id_in_a_task():
    batch = pa.record_batch(
        {"event_id": ["b", "a", "b", "a"], "message": ["1", "2", "3", "4"], "offset": [9, 5, 3, 7]}
    )
    later = pa.record_batch({"event_id": ["a", "c"], "message": ["5", "6"], "offset": [1, 2]})
    (found,) = first_in_task(["offset"], False)(iter([batch]))
    assert found.to_pydict() == {"event_id": ["a", "b"], "message": ["2", "3"], "offset": [5, 3]}
    parts = list(first_in_task(["offset"], True)(iter([batch] * 70 + [later])))
    whole = pa.Table.from_batches(parts).to_pydict()
    assert whole == {"event_id": ["a", "b", "c"], "message": ["5", "3", "6"], "offset": [1, 3, 2]}
    assert sum(b.num_rows for b in first_in_task(["offset"], True)(iter([batch.slice(0, 0)]))) == 0
    assert list(first_in_task(["offset"], True)(iter([]))) == []


def test_crash_after_the_write_then_replay(feed, monkeypatch):
    feed.arrive(event(1), event(2))
    upsert = EventTable.upsert

    def crash(self, *args, **kwargs):
        upsert(self, *args, **kwargs)
        raise RuntimeError("lost after write")

    monkeypatch.setattr(EventTable, "upsert", crash)
    with pytest.raises(Exception, match="lost after write"):
        feed.run()
    assert feed.stored() == {"1": 10.0, "2": 10.0}
    monkeypatch.undo()
    feed.arrive(event(2, revenue=2.0), event(3))
    feed.run()
    assert feed.stored() == {"1": 10.0, "2": 10.0, "3": 10.0}


@pytest.mark.parametrize("stateful", [False, True])
def test_unusable_messages_are_set_aside(feed, stateful):
    broken = "this is not JSON"
    feed.arrive(
        broken,
        broken,
        event(1, revenue=1e12),
        event("x" * 40),
        event(2, weight_kg="heavy", event_timestamp="zzz"),
    )
    feed.run(stateful=stateful)
    row = feed.table.events().first()
    assert feed.stored().keys() == {"2"}
    assert (row["weight_kg"], row["event_timestamp"]) == (None, None)
    reasons = sorted(r["reason"] for r in feed.table.quarantine().collect())
    assert reasons == ["no event_id", "no event_id", "value does not fit", "value does not fit"]


def test_stored_types(feed):
    feed.arrive(event(1))
    feed.run()
    row = feed.table.events().first()
    assert str(row["weight_kg"]) == "10.13" and str(row["cost_per_km"]) == "2.5000"
    assert row["weather_risk"] == "HIGH" and row["ingested_at"] is not None
    assert row["event_timestamp"] == datetime(2024, 2, 3, 10, 0, 0, 250000)


def test_batch_and_stream_enrich_alike(spark, feed):
    feed.arrive(*[event(n, temperature_c=float(n * 9 - 5), distance_km=float(n)) for n in range(6)])
    feed.run()
    batch = enrich(decode(spark.read.text(f"file:{feed.root}/inbox")))
    streamed = feed.table.events().select("event_id", "weather_risk").collect()
    assert sorted(map(tuple, streamed)) == sorted(
        map(tuple, batch.select("event_id", "weather_risk").collect())
    )


def test_broker_order_decides_where_known(spark, feed):
    messages = spark.createDataFrame(
        [(event(1, revenue=2.0), 0, 9), (event(1, revenue=1.0), 0, 3)],
        "value string, partition int, offset bigint",
    )
    feed.table.upsert(enrich(decode(messages)), "q", 0)
    assert feed.stored() == {"1": 1.0}


def test_publish_frame(spark):
    rows = [tuple({"event_id": "7"} | BASE for _ in [0])[0]]
    events = spark.createDataFrame(
        [tuple(row[name] for name in EVENT_SCHEMA) for row in rows], ddl(EVENT_SCHEMA)
    )
    message = publish_frame(events).first()
    assert message["key"] == "RT-1" and json.loads(message["value"]) == rows[0]


def test_texts_of_usable_messages_are_not_held(feed, monkeypatch):
    """A batch in memory has the texts of what is set aside alone."""
    held = {}
    store, set_aside = EventTable._store_new, EventTable._set_aside

    def watch(name, inner):
        def call(self, rows, *args):
            held[name] = sorted(r["message"] or "" for r in rows.select("message").collect())
            return inner(self, rows, *args)

        return call

    monkeypatch.setattr(EventTable, "_store_new", watch("good", store))
    monkeypatch.setattr(EventTable, "_set_aside", watch("bad", set_aside))
    messages = [event(1), event(2, weight_kg=1e12), event(3), "broken"]
    rows = feed.spark.createDataFrame([(m,) for m in messages], "value string")
    feed.table.upsert(enrich(decode(rows)), "q", 0)
    assert held == {"good": ["", ""], "bad": sorted([messages[1], "broken"])}
    assert set(feed.stored()) == {"1", "3"}
    aside = {r["message"] for r in feed.table.quarantine().collect()}
    assert aside == {messages[1], "broken"}
