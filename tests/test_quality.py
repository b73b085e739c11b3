"""Each check must fire on the damage it is for, with the exact count, and on nothing else."""

from decimal import Decimal

import pytest
from records import record
from pyspark.sql import functions as F

from haulmark.plans.daily import check_step, load_step
from haulmark.plans.quality import CriticalCheckFailed, details, gate, warehouse_tables
from haulmark.plans.warehouse import Warehouse
from haulmark.sources.raw import read_raw, write_raw


@pytest.fixture(scope="module")
def tables(spark, frame, tmp_path_factory):
    root = f"file:{tmp_path_factory.mktemp('quality')}"
    rows = [record(n, company_name=f"C{n}", driver_name=f"D{n % 3}") for n in range(9)]
    write_raw(frame(*rows), root, "a")
    wh = Warehouse(spark, f"{root}/wh")
    wh.load(read_raw(spark, root))
    return warehouse_tables(wh)


def measured(tables):
    return {
        (r["check_name"], r["detail"]): r["violations"]
        for r in details(tables).collect()
        if r["violations"]
    }


def damaged(tables, name, condition, **columns):
    rows = tables[name]
    changes = {
        column: F.when(F.expr(condition), F.lit(value).cast(dict(rows.dtypes)[column])).otherwise(
            F.col(column)
        )
        for column, value in columns.items()
    }
    return tables | {name: rows.withColumns(changes)}


def test_clean(tables):
    assert measured(tables) == {}
    checks = gate(details(tables))
    assert len(checks) == 8 and all(checks.values())


@pytest.mark.parametrize(
    ("columns", "expected"),
    [
        (
            {"customer_id": None},
            {
                ("null_foreign_keys", "fact_shipments"): 2,
                ("orphan_records", "customer_id"): 2,
                ("duplicate_shipments", "customer_id, scheduled_pickup"): 1,
            },
        ),
        ({"driver_id": 999}, {("orphan_records", "driver_id"): 2}),
        ({"date_id": 999}, {}),
        ({"date_id": None}, {("null_foreign_keys", "fact_shipments"): 2}),
        ({"status": "lost"}, {("invalid_status", "distinct values"): 1}),
        ({"status": None}, {}),
        ({"cost_usd": Decimal("-1")}, {("negative_values", "cost_usd"): 2}),
        ({"distance_km": -5}, {("negative_values", "distance_km"): 2}),
        ({"is_delayed": True}, {("delay_consistency", "fact_shipments"): 2}),
        ({"is_delayed": None}, {}),
        ({"delay_minutes": 31}, {("delay_consistency", "fact_shipments"): 2}),
    ],
)
def test_fact_damage(tables, columns, expected):
    dirty = damaged(tables, "fact_shipments", "shipment_id IN (2, 5)", **columns)
    assert measured(dirty) == expected


def test_driver_rating(tables):
    dirty = damaged(tables, "dim_driver", "driver_id = 1", rating=Decimal("5.50"))
    assert measured(dirty) == {("driver_ratings", "dim_driver"): 1}
    assert gate(details(dirty))["driver_ratings"] is False  # reported, not critical


def test_empty_table_and_gate(tables):
    dirty = tables | {"dim_vehicle": tables["dim_vehicle"].limit(0)}
    with pytest.raises(CriticalCheckFailed, match="orphan_records.*row_counts"):
        gate(details(dirty))


def test_steps_load_only_new_runs_and_report_before_the_gate(spark, frame, tmp_path):
    root = f"file:{tmp_path}"
    write_raw(frame(record(1)), root, "a")
    assert load_step(spark, root, f"{root}/wh")["fact_shipments"] == 1
    assert load_step(spark, root, f"{root}/wh") == {}
    write_raw(frame(record(2)), root, "b", "csv")
    assert load_step(spark, root, f"{root}/wh")["fact_shipments"] == 1
    assert set(load_step(spark, root, f"{root}/wh", reread=True).values()) == {0}
    checks = check_step(spark, f"{root}/wh", f"{root}/report")
    assert checks["duplicate_shipments"] is False and checks["row_counts"] is True
    empty = f"{root}/nothing"
    with pytest.raises(CriticalCheckFailed):
        check_step(spark, empty, f"{root}/report2")
    assert spark.read.json(f"{root}/report2").count() == 19
