"""Summaries of the loads: equal to scans of all facts, and read in their stead."""

import json
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from records import record

from haulmark.plans import kpis, quality, star, summaries
from haulmark.plans.warehouse import Warehouse
from haulmark.sources.lake import register_lake
from haulmark.sources.raw import raw_key, read_raw, write_raw

START = record(0)["scheduled_pickup"]


def shipment(n, **changes):
    """Two shipments of a customer at a time now and then, unknown values, several years."""
    years = START.replace(year=2022 + n % 3)
    return record(
        n,
        company_name=f"C{n % 7}",
        driver_name=f"D{n % 4}",
        scheduled_pickup=years + timedelta(days=n % 6),
        status=[None, "lost", "on_time", "delayed", "failed"][n % 5],
        weather_condition=None if n % 6 == 0 else f"W{n % 3}",
        delay_minutes=None if n % 13 == 0 else n % 60,
        is_delayed=n % 2 == 0,
        cost_usd=None if n % 9 == 0 else Decimal(n),
        **changes,
    )


@pytest.fixture(scope="module")
def grown(spark, frame, tmp_path_factory):
    """Three loads that overlap; copies and repeated pickups across them."""
    root = f"file:{tmp_path_factory.mktemp('summaries')}"
    wh = Warehouse(spark, f"{root}/wh")
    for i, numbers in enumerate([range(0, 120), range(60, 200), range(0, 200)]):
        write_raw(frame(*[shipment(n) for n in numbers]), f"{root}/{i}", "a")
        wh.load(read_raw(spark, f"{root}/{i}"))
    return wh


def rows(frame):
    return sorted(map(str, frame.collect()))


def files(frame):
    """Folders of the warehouse that a plan reads."""
    plan = frame._jdf.queryExecution().toString()
    return {name for name in ("fact_shipments", "fact_summary", "pickups") if f"/{name}" in plan}


@pytest.mark.parametrize("key", summaries.KEYS)
def test_merged_summaries_equal_a_scan(grown, key):
    columns = [key, *summaries.MEASURES]
    scanned = summaries.measured(grown.table("fact_shipments"), key).select(*columns)
    merged = grown.summary(key).select(*columns)
    cast = [F.col(key).cast(summaries.KEYS[key]), *[F.col(m) for m in summaries.MEASURES]]
    assert rows(merged) == rows(scanned.select(*cast))


def test_quality_from_summaries(grown):
    """The same report as from the facts, of which none is read."""
    found = quality.warehouse_details(grown)
    assert rows(found) == rows(quality.details(quality.warehouse_tables(grown)))
    assert {r["check_name"]: r["violations"] for r in found.collect()}["duplicate_shipments"] > 0
    assert "fact_shipments" not in files(found)
    assert rows(grown.repeated_pickups()) == rows(
        quality.duplicate_shipments(grown.table("fact_shipments"))
    )


@pytest.mark.parametrize(
    "plan",
    [kpis.kpi_summary, kpis.kpi_by_month, kpis.kpi_by_region, kpis.driver_scorecard,
     kpis.route_scorecard, kpis.weather_impact],
)
def test_kpis_from_summaries(grown, plan):
    class Scanned:
        """The same tables, without summaries."""

        table, dimension = grown.table, grown.dimension

    assert rows(plan(grown)) == rows(plan(Scanned()))
    assert files(plan(grown)) == {"fact_summary"}


def test_empty_warehouse(spark, tmp_path):
    wh = Warehouse(spark, f"file:{tmp_path}/none")
    assert kpis.kpi_summary(wh).first()["total_shipments"] == 0
    assert quality.warehouse_details(wh).filter("check_name = 'row_counts' AND passed").count() == 0


def test_loads_of_an_older_version_are_scanned(spark, frame, tmp_path):
    wh = Warehouse(spark, f"file:{tmp_path}/wh")
    root = f"file:{tmp_path}"
    for run in "ab":
        write_raw(frame(*[shipment(n + 50 * (run == "b")) for n in range(60)]), root, run)
        wh.load(read_raw(spark, root, run))
        if run == "a":  # as if its commit had been written before there were summaries
            commit = wh.commit()
            commit.pop("summarised")
            wh.store.upload_bytes(f"_commits/{1:010d}.json", json.dumps(commit).encode())
    assert wh.summary("status") is None
    assert kpis.kpi_summary(wh).first()["total_shipments"] == 110
    assert rows(quality.warehouse_details(wh)) == rows(
        quality.details(quality.warehouse_tables(wh))
    )


def test_newest_reads_the_newest_days(grown):
    full = star.explorer(star.extract(grown)).collect()
    for limit, offset in ((5, 0), (20, 30), (500, 0), (10, 190), (10, 5000)):
        assert star.newest(grown, limit, offset).collect() == full[offset : offset + limit]
    plan = star.newest(grown, 5)._jdf.queryExecution().toString()
    assert "pickup_year" in plan.split("PartitionFilters")[1][:200]
    assert ">= 2024" in plan
    with pytest.raises(ValueError, match="limit"):
        star.newest(grown, 0)


def test_lake_over_runs_of_several_writers(spark, frame, tmp_path):
    """A second writer's times are texts and its numbers doubles; then a run is added."""
    root = f"file:{tmp_path}/lake"
    write_raw(frame(*[shipment(n) for n in range(30)]), root, "a")
    table = f"lake_{tmp_path.name.replace('-', '_')}"
    first = register_lake(spark, root, table)
    assert first.count() == 30
    other = frame(*[shipment(n) for n in range(30, 50)])
    loose = other.withColumns(
        {"scheduled_pickup": F.col("scheduled_pickup").cast("string"), "cost_usd": F.col("cost_usd").cast("double")}
    )
    loose.write.parquet(f"{root}/{raw_key('b', 'parquet')}")
    both = register_lake(spark, root, table)
    wanted = read_raw(spark, root, formats=("parquet",)).select(*both.columns)
    assert both.count() == 50 and rows(both) == rows(wanted)
    write_raw(frame(shipment(99)), root, "c")
    assert register_lake(spark, root, table).count() == 51
    with pytest.raises(ValueError, match="exists already"):
        register_lake(spark, f"{root}/elsewhere_with", table) if write_raw(
            frame(shipment(1)), f"{root}/elsewhere_with", "a"
        ) else None
    spark.sql(f"DROP VIEW {table}")


def test_costs_are_summed_as_whole_numbers(grown):
    """Sums of long decimals keep the aggregate from its fast buffers."""
    facts = grown.table("fact_shipments")
    plan = summaries.summarise(facts)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(_cents" in plan and "sum(cost_usd" not in plan
    totals = summaries.summarise(facts).filter("key = 'status'").agg(F.sum("cost")).first()[0]
    assert totals == facts.agg(F.sum("cost_usd")).first()[0] and totals.as_tuple().exponent == -2
