"""Warehouse load: first wins, idempotency, incremental loads, atomicity."""

import re
from decimal import Decimal

import pytest
from records import record
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from haulmark.operators import bitmap, keyed
from haulmark.operators.first_wins import at_first_positions, first_attributes, first_rows
from haulmark.operators.surrogate import numbered, stage_in_order
from haulmark.plans import warehouse as module
from haulmark.plans.star import shipment_detail, star
from haulmark.plans.warehouse import Warehouse
from haulmark.schemas import TABLES
from haulmark.sources.raw import POSITION, read_raw, write_raw


def load(spark, root, wh, run="*"):
    return wh.load(read_raw(spark, root, run))


def natural(wh):
    """Facts by natural keys: equal contents whatever the surrogates are."""
    rows = star(wh).select(
        "source_shipment_id",
        "raw_file",
        "company_name",
        "industry",
        "driver_name",
        "driver_rating",
        "plate_number",
        "mileage_km",
        "origin_city",
        "destination_city",
        "full_date",
        "status",
        "cost_usd",
    )
    return sorted(tuple(row) for row in rows.collect())


def test_first_record_wins_within_and_across_files(spark, frame, tmp_path):
    root = f"file:{tmp_path}"
    write_raw(frame(record(1, industry="Tech"), record(2, industry="Food")), root, "a", "csv")
    write_raw(frame(record(3, industry="Toys"), record(1, cost_usd=Decimal("9.99"))), root, "b")
    wh = Warehouse(spark, f"{root}/wh")
    new = load(spark, root, wh)
    assert new == {
        "dim_date": 1,
        "dim_customer": 1,
        "dim_driver": 1,
        "dim_vehicle": 1,
        "dim_route": 1,
        "fact_shipments": 3,
    }
    assert wh.table("dim_customer").first()["industry"] == "Tech"
    fact = wh.table("fact_shipments").filter("source_shipment_id = 'T-1'").first()
    assert (fact["raw_file"], fact["cost_usd"]) == ("raw/shipments_a.csv", Decimal("420.50"))


def test_later_loads_insert_but_never_update(spark, frame, tmp_path):
    root = f"file:{tmp_path}"
    wh = Warehouse(spark, f"{root}/wh")
    write_raw(frame(record(1), record(2)), root, "a")
    load(spark, root, wh)
    before = wh.table("dim_driver").collect()
    changed = record(3, driver_rating=Decimal("1.00"), industry="Other")
    write_raw(frame(record(1, status="failed"), changed, record(4, driver_name="Eli")), root, "b")
    new = load(spark, root, wh)
    assert (new["fact_shipments"], new["dim_driver"], new["dim_customer"]) == (2, 1, 0)
    kept = wh.table("dim_driver").filter("full_name = 'Dana'").collect()
    assert kept == before
    ids = [r[0] for r in wh.table("fact_shipments").select("shipment_id").collect()]
    assert len(set(ids)) == 4 and max(ids[:2]) > 0
    assert wh.table("fact_shipments").filter("status = 'failed'").count() == 0


def test_load_twice_changes_nothing(spark, frame, tmp_path):
    root = f"file:{tmp_path}"
    wh = Warehouse(spark, f"{root}/wh")
    write_raw(frame(*[record(n, plate_number=f"P-{n % 7}") for n in range(50)]), root, "a")
    load(spark, root, wh)
    before = {name: sorted(map(tuple, wh.table(name).collect()), key=str) for name in TABLES}
    assert set(load(spark, root, wh).values()) == {0}
    after = {name: sorted(map(tuple, wh.table(name).collect()), key=str) for name in TABLES}
    assert after == before


def test_two_loads_equal_one_load_of_both(spark, frame, tmp_path):
    root = f"file:{tmp_path}"

    def some(first, last):
        return frame(
            *[
                record(
                    n % 60,
                    company_name=f"C{n % 9}",
                    driver_name=f"D{n % 5}",
                    industry=f"I{n}",
                    mileage_km=n,
                )
                for n in range(first, last)
            ]
        )

    write_raw(some(0, 50), root, "a")
    write_raw(some(30, 100), root, "b")
    stepwise, at_once = Warehouse(spark, f"{root}/one"), Warehouse(spark, f"{root}/two")
    load(spark, root, stepwise, "a")
    load(spark, root, stepwise, "b")
    load(spark, root, at_once)
    assert natural(stepwise) == natural(at_once)


def test_missing_dimension_row_keeps_the_fact(spark, frame, tmp_path, monkeypatch):
    """A reference that cannot be resolved becomes NULL and drops out of star queries."""
    root = f"file:{tmp_path}"
    write_raw(frame(record(1), record(2, driver_name="Ghost")), root, "a")
    rows = module.dimension_rows
    monkeypatch.setattr(
        module,
        "dimension_rows",
        lambda raw, d: rows(raw, d).filter("full_name <> 'Ghost'")
        if d.table == "dim_driver"
        else rows(raw, d),
    )
    wh = Warehouse(spark, f"{root}/wh")
    assert load(spark, root, wh)["fact_shipments"] == 2
    assert wh.table("fact_shipments").filter("driver_id IS NULL").count() == 1
    assert star(wh).count() == 1


def test_failed_load_leaves_no_trace(spark, frame, tmp_path, monkeypatch):
    root = f"file:{tmp_path}"
    wh = Warehouse(spark, f"{root}/wh")
    write_raw(frame(record(1)), root, "a")
    load(spark, root, wh)
    write_raw(frame(record(2, company_name="New")), root, "b")

    def broken(*_):
        raise RuntimeError("lost connection")

    monkeypatch.setattr(Warehouse, "_publish", broken)
    with pytest.raises(RuntimeError):
        load(spark, root, wh)
    assert wh.table("fact_shipments").count() == 1
    assert wh.table("dim_customer").count() == 1
    monkeypatch.undo()
    assert load(spark, root, wh)["fact_shipments"] == 1
    assert wh.table("fact_shipments").count() == 2
    assert wh.table("dim_customer").count() == 2


def test_number_that_does_not_fit_fails_the_load(spark, frame, tmp_path):
    root = f"file:{tmp_path}"
    wide = frame(record(1)).withColumn("cost_usd", F.lit(1e12))
    wide.write.parquet(f"{root}/raw/shipments_a.parquet")
    wh = Warehouse(spark, f"{root}/wh")
    with pytest.raises(PySparkException):
        load(spark, root, wh)
    assert wh.commit()["load_id"] == 0


def test_joins_without_broadcast_give_the_same_tables(spark, frame, tmp_path, monkeypatch):
    root = f"file:{tmp_path}"
    rows = [record(n % 300, company_name=f"C{n % 11}", driver_name="Hot") for n in range(500)]
    write_raw(frame(*rows[:200]), root, "a")
    write_raw(frame(*rows), root, "b")
    plain, shuffled = Warehouse(spark, f"{root}/plain"), Warehouse(spark, f"{root}/shuffled")
    for run in ("a", "*"):
        load(spark, root, plain, run)
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for run in ("a", "*"):
            load(spark, root, shuffled, run)
        assert natural(shuffled) == natural(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_dimensions_meet_narrow_rows(spark, frame, tmp_path, monkeypatch):
    """Whole rows are not shuffled once more for each dimension that cannot be broadcast."""
    root = f"file:{tmp_path}"
    write_raw(frame(*[record(n % 30, plate_number=f"P{n % 7}") for n in range(60)]), root, "a")
    resolve, widths = Warehouse._resolve, []

    def seen(self, facts, *rest):
        widths.append(len(facts.columns))
        return resolve(self, facts, *rest)

    monkeypatch.setattr(Warehouse, "_resolve", seen)
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", -1)
    wh = Warehouse(spark, f"{root}/wh")
    assert load(spark, root, wh)["fact_shipments"] == 30
    assert len(widths) == 5 and max(widths) < 20
    assert star(wh).count() == 30


def test_records_are_dealt_out_without_natural_keys(spark, frame, tmp_path, monkeypatch):
    """References that every task can look up are resolved before the shuffle of whole rows."""
    root = f"file:{tmp_path}"
    write_raw(frame(*[record(n % 30, plate_number=f"P{n % 7}") for n in range(60)]), root, "a")
    plain = Warehouse(spark, f"{root}/plain")
    load(spark, root, plain)
    picked, fits, dealt = Warehouse._picked, keyed.fits, []

    def seen(self, records, firsts, n):
        dealt.append(set(records.columns))
        return picked(self, records, firsts, n)

    monkeypatch.setattr(Warehouse, "_picked", seen)
    monkeypatch.setattr(
        module, "fits", lambda table, rows: POSITION not in table.columns and fits(table, rows)
    )
    wh = Warehouse(spark, f"{root}/wh")
    assert load(spark, root, wh)["fact_shipments"] == 30
    assert len(dealt) == 1 and {"customer_id", "vehicle_id", "date_id"} <= dealt[0]
    assert not dealt[0] & {"company_name", "plate_number", "driver_name", "origin_city"}
    facts = [sorted(w.table("fact_shipments").collect()) for w in (plain, wh)]
    assert facts[0] == facts[1]


def test_surrogates_are_dense_and_in_key_order(spark, tmp_path):
    rows = spark.range(1000).selectExpr("concat('k', id) AS k").repartition(7)
    path = f"file:{tmp_path}/staged"
    stage_in_order(rows, ["k"], path)
    found = numbered(spark, path, "id", 100).orderBy("id").collect()
    assert [r["id"] for r in found] == list(range(101, 1101))
    assert [r["k"] for r in found] == sorted(f"k{n}" for n in range(1000))


def test_first_wins_under_a_hot_key(spark):
    """One key owns a third of all rows, with a different attribute in each."""
    rows = spark.range(9000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('k', id % 50)) AS k",
        "concat('v', id) AS v",
        "concat('file', id % 4) AS path",
        "id AS row",
    )
    expected = {}
    for r in rows.collect():
        best = expected.get(r["k"])
        if best is None or (r["path"], r["row"]) < best[:2]:
            expected[r["k"]] = (r["path"], r["row"], r["v"])
    wanted = {k: v[2] for k, v in expected.items()}
    narrow = first_attributes(rows, ["k"], ["v"], ["path", "row"]).collect()
    wide = first_rows(rows, ["k"], ["path", "row"]).collect()
    assert {r["k"]: r["v"] for r in narrow} == wanted
    assert {r["k"]: r["v"] for r in wide} == wanted


@pytest.mark.parametrize("most", [None, -1])
def test_first_wins_by_positions_deals_out_no_other_rows(spark, tmp_path, monkeypatch, most):
    """Attributes that differ in each row, a hot key and NULL; also without the bitmap."""
    if most:
        monkeypatch.setattr(keyed, "BROADCAST_BYTES", most)
    rows = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 > 0 THEN concat('k', id % 50) END AS k",
        "IF(id % 5 = 0, NULL, concat('v', id)) AS v",
        "(id * 7919) % 9000 AS place",
    ).repartition(4)
    plain = first_attributes(rows, ["k"], ["v"], ["place"]).collect()
    path = f"file:{tmp_path}/firsts"
    found = first_attributes(rows, ["k"], ["v"], ["place"], path).collect()
    assert len(plain) == 52 and {tuple(r) for r in found} == {tuple(r) for r in plain}
    held = at_first_positions(rows, ["k"], "place", path)
    assert held.count() == 52
    if not most:
        plan = held._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan


def test_views(spark, frame, tmp_path):
    root = f"file:{tmp_path}"
    write_raw(frame(record(1)), root, "a")
    wh = Warehouse(spark, f"{root}/wh")
    load(spark, root, wh)
    wh.register_views("v_")
    counted = spark.sql(
        "SELECT count(*) FROM v_fact_shipments JOIN v_dim_route USING (route_id)"
        " WHERE status = :status",
        args={"status": "on_time"},
    )
    assert counted.first()[0] == 1


def test_a_lookup_reads_the_files_of_one_load(spark, frame, tmp_path, monkeypatch):
    root = f"file:{tmp_path}"
    monkeypatch.setattr(module, "FILE_ROWS", 10)
    wh = Warehouse(spark, f"{root}/wh")
    for run in range(3):
        rows = [record(100 * run + n, company_name=f"C{run}") for n in range(40)]
        write_raw(frame(*rows), root, str(run))
        load(spark, root, wh, str(run))
    spans = wh.spans()
    assert [(s["first"], s["last"]) for s in spans] == [(1, 40), (41, 80), (81, 120)]
    assert [sum(s["listed"].values()) for s in spans] == [40, 40, 40]
    plan = wh.facts_between(55, 55)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*\(load_id#\d+ = 2\)", plan)
    assert "GreaterThanOrEqual(shipment_id,55)" in plan
    per_file = wh.table("fact_shipments").groupBy("_metadata.file_path").agg(
        F.min("shipment_id").alias("low"), F.max("shipment_id").alias("high")
    ).collect()
    assert all(r["high"] - r["low"] < 10 for r in per_file)
    assert shipment_detail(wh, 55).first()["company_name"] == "C1"


def test_reload_sorts_and_numbers_nothing(spark, frame, tmp_path):
    root = f"file:{tmp_path}"
    write_raw(frame(record(1), record(2)), root, "a", "csv")
    wh = Warehouse(spark, f"{root}/wh")
    wh.load(read_raw(spark, root), stage=True)
    before = wh.commit()
    assert set(wh.load(read_raw(spark, root), stage=True).values()) == {0}
    after = wh.commit()
    assert after["last_id"] == before["last_id"] and after["spans"] == before["spans"]
    write_raw(frame(record(3)), root, "b", "csv")
    wh.load(read_raw(spark, root), stage=True)
    ids = sorted(r[0] for r in wh.table("fact_shipments").select("shipment_id").collect())
    assert ids == [1, 2, 3]


def test_text_is_parsed_once(spark, frame, tmp_path, monkeypatch):
    root = f"file:{tmp_path}"
    write_raw(frame(record(1), record(2)), root, "a", "csv")
    wh = Warehouse(spark, f"{root}/wh")
    seen = []
    inner = Warehouse._load

    def watch(self, raw, runs):
        seen.extend(raw.inputFiles())
        return inner(self, raw, runs)

    monkeypatch.setattr(Warehouse, "_load", watch)
    wh.load(read_raw(spark, root), stage=True)
    assert seen and all("/_staging/" in f and f.endswith(".parquet") for f in seen)


def test_second_writer_of_a_commit_fails(spark, frame, tmp_path):
    root = f"file:{tmp_path}"
    write_raw(frame(record(1)), root, "a")
    wh = Warehouse(spark, f"{root}/wh")
    load(spark, root, wh)
    with pytest.raises(FileExistsError):
        wh._publish(wh.commit())
    assert wh.table("fact_shipments").count() == 1


def bounded(monkeypatch):
    """Neither first positions nor vehicles fit every task, but the positions' bits do."""
    monkeypatch.setattr(module, "FILE_ROWS", 40)
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", 3_000)


def test_whole_records_are_dealt_out_once(spark, frame, tmp_path, monkeypatch):
    """To the file of their id, with copies, and large dimensions resolved; in two loads."""
    root = f"file:{tmp_path}"
    rows = [
        record(n % 200, company_name=f"C{n % 9}", plate_number=f"P{n % 150}", delay_minutes=n)
        for n in range(500)
    ]
    write_raw(frame(*rows[:90]), root, "a")
    write_raw(frame(*rows), root, "b")
    plain, dealt = Warehouse(spark, f"{root}/plain"), Warehouse(spark, f"{root}/dealt")
    for run in ("a", "*"):
        load(spark, root, plain, run)
    bounded(monkeypatch)
    picked, plans = Warehouse._picked, []

    def seen(self, *args):
        facts = picked(self, *args)
        plans.append(facts._jdf.queryExecution().executedPlan().toString())
        return facts

    monkeypatch.setattr(Warehouse, "_picked", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for run in ("a", "*"):
            load(spark, root, dealt, run)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in TABLES:
        assert sorted(map(str, dealt.table(name).collect())) == sorted(
            map(str, plain.table(name).collect())
        )
    wide = [line for line in plans[1].splitlines() if "Exchange" in line]
    assert not any("hashpartitioning(_position" in line for line in wide)
    # records, ids and references
    assert sum("shufflepartitionidpassthrough" in line for line in wide) == 3
    per_file = dealt.table("fact_shipments").groupBy("_metadata.file_path").agg(
        F.min("shipment_id").alias("low"), F.max("shipment_id").alias("high")
    ).collect()
    assert len(per_file) > 4 and all(r["high"] - r["low"] < 40 for r in per_file)


def test_a_copy_that_breaks_the_contract_fails_the_load(spark, frame, tmp_path, monkeypatch):
    """Copies are not dealt out, yet what they hold is checked."""
    root = f"file:{tmp_path}"
    bounded(monkeypatch)
    rows = [record(n % 200, plate_number=f"P{n % 150}") for n in range(400)]
    rows[-1]["status"] = "x" * 21
    write_raw(frame(*rows), root, "a")
    wh = Warehouse(spark, f"{root}/wh")
    with pytest.raises(ValueError, match="status"):
        load(spark, root, wh)
    assert wh.commit()["load_id"] == 0


def test_rank_among_bounds(spark):
    for n in (0, 1, 2, 3, 8, 100):
        bounds = sorted(f"k{7 * i}" for i in range(n))
        keys = spark.range(800).selectExpr("concat('k', id) AS k")
        found = keys.withColumn("r", keyed.rank_in(F.col("k"), bounds)).collect()
        assert all(r["r"] == sum(b <= r["k"] for b in bounds) for r in found)


def test_a_set_of_positions_is_exact(spark):
    positions = bitmap.built(spark.range(5, 30_000, 7), "id").cache()
    held = bitmap.held(spark.range(40_000), positions, "id")
    assert sorted(r[0] for r in held.collect()) == list(range(5, 30_000, 7))
    assert positions.count() == 8
