"""Row-level queries, KPIs and dashboard charts on a small warehouse."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from records import record
from pyspark.sql import functions as F

from haulmark.operators.enrich import enrich_recent
from haulmark.plans import dashboard, kpis, star
from haulmark.plans.warehouse import Warehouse
from haulmark.sources.raw import read_raw, write_raw

STATUS = ["on_time", "delayed", "failed"]
DAY = datetime(2023, 12, 30, 8)


@pytest.fixture(scope="module")
def wh(spark, frame, tmp_path_factory):
    root = f"file:{tmp_path_factory.mktemp('queries')}"
    rows = [
        record(
            n,
            status=STATUS[n % 3],
            is_delayed=n % 3 > 0,
            delay_minutes=[5, 100, 300][n % 3],
            driver_name=f"D{n % 4}",
            region=f"R{n % 2}",
            origin_city=f"O{n % 2}",
            weather_condition=[None, "Snow", "Clear"][n % 3],
            scheduled_pickup=DAY + timedelta(days=n % 5),
            cost_usd=Decimal(n),
        )
        for n in range(40)
    ]
    rows.append(record(100, driver_name="Idle", origin_city="Idle", region="R9", status=None))
    write_raw(frame(*rows), root, "a")
    wh = Warehouse(spark, f"{root}/wh")
    wh.load(read_raw(spark, root))
    return wh


@pytest.fixture
def without_idle(wh, monkeypatch):
    """The same warehouse with the last shipment gone: its driver and route are idle.

    The load's summaries still count it, so they are not to be used."""
    table = wh.table

    def pruned(name):
        rows = table(name)
        return rows.filter("source_shipment_id <> 'T-100'") if name == "fact_shipments" else rows

    monkeypatch.setattr(wh, "table", pruned)
    monkeypatch.setattr(wh, "summary", lambda key: None)
    return wh


def test_idle_driver_counts_zero(without_idle):
    row = kpis.driver_scorecard(without_idle).filter("full_name = 'Idle'").first()
    assert (row["total_shipments"], row["on_time_pct"]) == (0, 0.0)


def test_idle_route_has_no_average(without_idle):
    row = kpis.route_scorecard(without_idle).filter("origin_city = 'Idle'").first()
    assert (row["total_shipments"], row["avg_cost_usd"]) == (0, None)


def test_kpis_keep_null_groups_and_charts_drop_them(wh):
    impact = {r["weather_condition"]: r["shipments"] for r in kpis.weather_impact(wh).collect()}
    assert impact == {None: 14, "Snow": 13, "Clear": 14}
    charted = dashboard.weather_delay(star.extract(wh)).collect()
    assert {r["weather_condition"] for r in charted} == {"Snow", "Clear"}
    assert sum(r["shipments"] for r in dashboard.status_mix(star.extract(wh)).collect()) == 40


def test_kpi_summary_over_nothing(spark, tmp_path):
    row = kpis.kpi_summary(Warehouse(spark, f"file:{tmp_path}")).first()
    assert (row["total_shipments"], row["on_time_rate_pct"], row["avg_cost_usd"]) == (0, None, None)


def test_page_arguments(wh):
    for limit, offset in ((0, 0), (501, 0), (10, -1)):
        with pytest.raises(ValueError):
            star.shipment_page(wh, limit, offset)


def test_pages_cover_everything_once(wh):
    ids = [r["shipment_id"] for r in star.extract(wh).orderBy("shipment_id").collect()]
    paged = [
        r["shipment_id"]
        for offset in range(0, 60, 12)
        for r in star.shipment_page(wh, 12, offset).collect()
    ]
    assert paged == ids
    after, seen = 0, []
    while page := [r["shipment_id"] for r in star.shipments_after(wh, after, 12).collect()]:
        seen += page
        after = page[-1]
    assert seen == ids


def test_pages_by_counts_equal_plain_ones(wh, monkeypatch):
    """Whole rows of the star sorted and cut, next to pages found by narrowing id ranges."""
    rows = star.star(wh).filter("status = 'on_time'").select(*star.LISTING)
    everything = rows.orderBy("shipment_id").collect()
    monkeypatch.setattr(star, "FEW_ROWS", 2)
    for parts in (2, 4096):
        monkeypatch.setattr(star, "RANGE_PARTS", parts)
        for offset in (0, 3, 9, 13, 99):
            page = star.shipment_page(wh, 7, offset, "on_time").collect()
            assert page == everything[offset : offset + 7]
        last = everything[4]["shipment_id"]
        assert star.shipments_after(wh, last, 3, "on_time").collect() == everything[5:8]


def test_only_the_page_is_joined(wh, monkeypatch):
    joined = []
    inner = star.star

    def watch(wh, fact=None):
        joined.append(fact.count())
        return inner(wh, fact)

    monkeypatch.setattr(star, "star", watch)
    star.shipment_page(wh, 5, 10)
    star.shipments_after(wh, 3, 4)
    assert joined == [5, 4]


def test_detail(wh):
    row = star.shipment_detail(wh, 1).first()
    assert row["shipment_id"] == 1 and row["full_name"] is not None
    with pytest.raises(LookupError):
        star.shipment_detail(wh, 10**9)


def test_status_filter(wh):
    rows = star.shipment_page(wh, status="failed").collect()
    assert len(rows) == 13 and {r["status"] for r in rows} == {"failed"}


def test_filters(wh):
    rows = star.extract(wh)
    assert dashboard.filtered(rows).count() == 41
    assert dashboard.filtered(rows, statuses=STATUS).count() == 40  # NULL is not chosen
    assert dashboard.filtered(rows, statuses=[*STATUS, None]).count() == 41
    assert dashboard.filtered(rows, years=[2023]).count() == 16
    assert dashboard.filtered(rows, years=[2023], regions=["R0"]).count() == 8
    with pytest.raises(LookupError):
        dashboard.require_rows(dashboard.filtered(rows, regions=[]))


def test_year_filter_prunes_partitions(wh, capsys):
    dashboard.filtered(star.extract(wh), years=[2023]).explain()
    assert "(pickup_year" in capsys.readouterr().out.split("PartitionFilters: ")[1][:200]


def test_top_drivers(wh):
    rows = star.extract(wh)
    assert len(dashboard.top_drivers(rows).collect()) == 4  # the idle one has a single trip
    best = [r["driver_name"] for r in dashboard.top_drivers(rows, count=2).collect()]
    totals = {r["driver_name"]: r["on_time_pct"] for r in dashboard.top_drivers(rows).collect()}
    assert best == sorted(totals, key=lambda name: (-totals[name], name))[:2]
    assert len(dashboard.top_drivers(rows, min_trips=11).collect()) == 5  # nobody: all


def test_weekday_order(wh):
    names = [r["weekday"] for r in dashboard.weekday_delay(star.extract(wh)).collect()]
    assert names == ["Monday", "Tuesday", "Wednesday", "Saturday", "Sunday"]


def test_page_agrees_with_the_charts(wh):
    rows = star.extract(wh)
    page = dashboard.page(rows).collect()
    weather = {r["label"]: r["delay_rate"] for r in page if r["chart"] == "weather_delay"}
    assert weather == {
        r["weather_condition"]: r["delay_rate"] for r in dashboard.weather_delay(rows).collect()
    }
    drivers = {r["label"]: r["on_time_pct"] for r in page if r["chart"] == "drivers"}
    assert drivers == {
        r["driver_name"]: r["on_time_pct"]
        for r in dashboard.top_drivers(rows, min_trips=10**6).collect()
    }


def test_options_and_export(spark, wh, tmp_path):
    rows = star.extract(wh)
    years = [r[0] for r in dashboard.options(rows, "year").collect()]
    assert years == [2023, 2024]
    star.export_csv(star.explorer(rows), f"file:{tmp_path}/out")
    back = spark.read.option("header", True).csv(f"file:{tmp_path}/out")
    assert back.columns == star.EXPLORER and back.count() == 41


def test_explorer_is_newest_first(wh):
    days = [r["full_date"] for r in star.explorer(star.extract(wh)).collect()]
    assert days == sorted(days, reverse=True)


def test_recent_shipments_take_observed_conditions(spark, frame):
    as_of = datetime(2024, 2, 10)
    rows = frame(
        record(1, scheduled_pickup=as_of - timedelta(days=7)),
        record(2, scheduled_pickup=as_of - timedelta(days=7, minutes=1)),
        record(3, scheduled_pickup=as_of, origin_city="Nowhere"),
    )
    seen = spark.createDataFrame(
        [("Lyon", "Mist", -3.26, 10.0, 30.0, 0.0)],
        "city string, weather_code string, temperature_celsius double, wind_speed_ms double,"
        " current_speed double, free_flow_speed double",
    )
    found = enrich_recent(rows, seen, F.lit(as_of)).orderBy("source_shipment_id").collect()
    assert [r["weather_condition"] for r in found] == ["Fog", "Clear", "Clear"]
    assert found[0]["temperature_celsius"] == Decimal("-3.30")
    assert found[0]["wind_speed_kmh"] == Decimal("36.00")
    assert found[0]["traffic_congestion_ratio"] == Decimal("1.00")
    assert found[0].asDict().keys() == record(1).keys()
