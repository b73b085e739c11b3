"""Bloom filters of loads: nothing held is missed, loads that hold no key are not opened."""

import json

import pytest
from pyspark.sql import functions as F
from records import record

from haulmark.operators import bloom, keyed
from haulmark.plans import warehouse as module
from haulmark.plans.warehouse import KEYS_TABLE, Warehouse
from haulmark.sources.raw import read_raw, write_raw


def keys_of(spark, low, high):
    return spark.range(low, high).selectExpr(
        "IF(id % 97 = 0, NULL, concat('k', id)) AS name", "id"
    )


def held(spark, batch, loads, keys, n):
    """Keys and loads that the filters of the loads may hold."""
    filters, levels = None, set()
    for load, rows in enumerate(loads):
        level = bloom.level_for(rows.count())
        levels.add(level)
        part = bloom.built(rows, keys, level).withColumn("load_id", F.lit(load))
        filters = part if filters is None else filters.unionByName(part)
    return bloom.suspects(batch, filters, keys, sorted(levels), n)


def test_level_gives_each_key_its_bits():
    assert bloom.level_for(0) == bloom.level_for(1) == bloom.level_for(256) == 0
    assert bloom.level_for(257) == 1 and bloom.level_for(512) == 1
    for n in (1_000, 123_456, 10**9):
        bits = 4_096 << bloom.level_for(n)
        assert bloom.BITS_PER_KEY * n <= bits < 2 * bloom.BITS_PER_KEY * n + 4_096


def test_every_held_key_is_found_in_its_load(spark):
    loads = [keys_of(spark, 0, 1_000), keys_of(spark, 1_000, 1_300), keys_of(spark, 0, 5)]
    found = held(spark, keys_of(spark, 0, 1_300), loads, ["name", "id"], 1_300)
    pairs = {(r["load_id"], r["name"], r["id"]) for r in found.collect()}
    for load, rows in enumerate(loads):
        assert {(load, r["name"], r["id"]) for r in rows.collect()} <= pairs
    assert len(pairs) < 1_305 + 30


@pytest.mark.parametrize("n", [25_600, 32_768])
def test_share_of_false_hits(spark, n):
    """At the fewest and at the most bits a key; the README states these shares."""
    strangers = spark.range(10**6, 10**6 + 100_000).selectExpr("concat('s', id) AS k")
    known = spark.range(n).selectExpr("concat('k', id) AS k")
    share = held(spark, strangers, [known], ["k"], 100_000).count() / 100_000
    assert share < 0.004


def test_filters_join_alike_without_broadcast(spark, monkeypatch):
    loads = [keys_of(spark, 0, 3_000)]
    few = held(spark, keys_of(spark, 2_000, 4_000), loads, ["id"], 2_000).collect()
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", -1)
    many = held(spark, keys_of(spark, 2_000, 4_000), loads, ["id"], 2_000).collect()
    assert sorted(few) == sorted(many) and len(few) >= 1_000


@pytest.fixture
def three_loads(spark, frame, tmp_path):
    root = f"file:{tmp_path}"
    wh = Warehouse(spark, f"{root}/wh")
    for run in range(3):
        rows = [record(100 * run + n, company_name=f"C{run}") for n in range(40)]
        write_raw(frame(*rows), root, str(run))
        wh.load(read_raw(spark, root, str(run)))
    return root, wh


def opened(monkeypatch):
    """Key files that a load's search reads, noted as it runs."""
    seen = []
    inner = module.absent

    def watch(candidates, existing, keys, rows, suspects=None):
        if keys == ["source_shipment_id"]:
            seen.append(
                {r[0] for r in existing.select(F.input_file_name()).distinct().collect()}
            )
        return inner(candidates, existing, keys, rows, suspects)

    monkeypatch.setattr(module, "absent", watch)
    return seen


def test_a_load_opens_only_key_files_that_may_hold_its_keys(
    spark, frame, three_loads, monkeypatch
):
    root, wh = three_loads
    seen = opened(monkeypatch)
    write_raw(frame(record(110), record(111), record(900)), root, "late")
    assert wh.load(read_raw(spark, root, "late"))["fact_shipments"] == 1
    assert seen[0] and all("load_id=2/" in f for f in seen[0])
    write_raw(frame(record(901), record(902)), root, "later")
    assert wh.load(read_raw(spark, root, "later"))["fact_shipments"] == 2
    assert seen[1] == set()
    assert wh.table(KEYS_TABLE).count() == 123


def test_loads_without_filters_are_searched_whole(spark, frame, three_loads, monkeypatch):
    root, wh = three_loads
    old = wh.commit() | {"load_id": 4}
    del old["filtered"]
    wh.store.upload_bytes("_commits/0000000004.json", json.dumps(old).encode(), replace=False)
    seen = opened(monkeypatch)
    write_raw(frame(record(5), record(105), record(900)), root, "late")
    assert wh.load(read_raw(spark, root, "late"))["fact_shipments"] == 1
    assert len({f.split("load_id=")[1][0] for f in seen[0]}) == 3
    assert "filtered" not in wh.commit()


def test_failed_load_leaves_no_filter_in_use(spark, frame, three_loads, monkeypatch):
    root, wh = three_loads

    def broken(*_):
        raise RuntimeError("lost connection")

    write_raw(frame(record(500)), root, "late")
    monkeypatch.setattr(Warehouse, "_publish", broken)
    with pytest.raises(RuntimeError):
        wh.load(read_raw(spark, root, "late"))
    monkeypatch.undo()
    write_raw(frame(record(501)), root, "other")
    assert wh.load(read_raw(spark, root, "other"))["fact_shipments"] == 1
    assert wh.load(read_raw(spark, root, "late"))["fact_shipments"] == 1


def test_a_filter_is_built_with_one_exchange(spark):
    """One hash a key is dealt by block; its bits are set where it arrives."""
    keys = spark.range(3000).selectExpr("concat('k', id) AS k")
    plan = bloom.built(keys, ["k"], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(block") == 1
    assert plan.index("Generate explode") < plan.index("Exchange hashpartitioning(block")


def test_a_blocks_map_of_words_is_built_once(spark):
    """Not again for each of its words."""
    keys = spark.range(3000).selectExpr("concat('k', id) AS k")
    plan = bloom.built(keys, ["k"], 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("map_from_entries") < plan.index("lambdafunction")


def test_the_next_load_builds_a_loads_filters(spark, frame, tmp_path):
    """A filter is built by the load that searches it, also after one that failed."""
    root = f"file:{tmp_path}"
    wh = Warehouse(spark, f"{root}/wh")

    def load(run, first, last):
        write_raw(frame(*[record(n, company_name=f"C{n % 3}") for n in range(first, last)]), root, run)
        return wh.load(read_raw(spark, root, run))["fact_shipments"]

    assert load("a", 0, 40) == 40
    assert not any(wh.store.exists(f"{name}_filter") for name in (KEYS_TABLE, "pickups"))
    assert wh.commit()["unfiltered"] == {KEYS_TABLE: {"1": 40}, "pickups": {"1": 3}}
    with pytest.raises(ValueError):
        write_raw(frame(record(41, company_name=None)), root, "bad")
        wh.load(read_raw(spark, root, "bad"))
    assert load("b", 30, 60) == 20 and load("c", 0, 61) == 1
    for name in (KEYS_TABLE, "pickups"):
        filters = spark.read.parquet(f"{root}/wh/{name}_filter")
        assert {r[0] for r in filters.select("load_id").distinct().collect()} == {1, 2}
    repeated = {tuple(r) for r in wh.repeated_pickups().select("shipments").collect()}
    assert repeated == {(20,), (21,)}
