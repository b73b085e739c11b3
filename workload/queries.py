"""Every registered query: a name and a function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions import conditions, schedule
from haulmark.functions.features import (
    CATEGORICAL,
    FEATURES,
    probability_pct,
    risk_band,
    with_features,
)
from haulmark.operators.enrich import enrich_recent
from haulmark.operators.first_wins import first_attributes, first_rows
from haulmark.operators.split import stratified_split
from haulmark.plans import dashboard, kpis, quality, star, training
from haulmark.plans import lake as lake_plans
from haulmark.plans.contract import reject_reasons
from haulmark.plans.scoring import score
from haulmark.schemas import (
    EVENT_SCHEMA,
    FACT_SHIPMENTS,
    RAW_SCHEMA,
    REALTIME_TYPES,
    TABLES,
    ddl,
)
from haulmark.sources.events import publish_frame
from haulmark.sources.raw import ORDER, POSITION, read_raw
from haulmark.streaming.events import decode, enrich
from workload import feed
from workload import materialised as built

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _on_warehouse(name: str, plan: Callable[..., DataFrame], *args, **kwargs) -> None:
    QUERIES[name] = lambda spark, sf_dir: plan(built.warehouse(spark, sf_dir), *args, **kwargs)


def _chart(name: str, plan: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: plan(star.extract(built.warehouse(spark, sf_dir)))


# ---- scans and sinks -----------------------------------------------------------------


@query
def raw_scan_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built.raw(spark, sf_dir).select(*RAW_SCHEMA, "raw_file")


@query
def raw_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_raw(spark, built.csv_root(spark, sf_dir), formats=("csv",))
    return records.select(*RAW_SCHEMA, "raw_file")


@query
def raw_contract_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys removed and statuses overlong for some records; how many break which rule."""
    records = built.raw(spark, sf_dir)
    minutes = F.col("delay_minutes")
    damaged = records.withColumns(
        {
            "company_name": F.when(minutes != 7, F.col("company_name")),
            "status": F.when(minutes == 40, F.repeat(F.col("status"), 4)).otherwise(
                F.col("status")
            ),
        }
    )
    reasons = reject_reasons(damaged).select(F.explode("reasons").alias("reason"))
    return reasons.groupBy("reason").agg(F.count("*").alias("records"))


@query
def export_filtered_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star.extract(built.warehouse(spark, sf_dir))
    chosen = dashboard.filtered(rows, years=[1997], statuses=["failed"])

    def build(path: str) -> str:
        star.export_csv(star.explorer(chosen), path)
        return path

    path = built.once(spark, sf_dir, "export", build)
    schema = {name: kind for name, kind in chosen.dtypes if name in star.EXPLORER}
    return spark.read.schema(ddl({name: schema[name] for name in star.EXPLORER})).csv(
        path, header=True
    )


# ---- warehouse -----------------------------------------------------------------------

for _name in TABLES:
    if _name != "fact_shipments":
        _on_warehouse(_name, lambda wh, name=_name: wh.table(name))

_on_warehouse("fact_shipments", lambda wh: wh.table("fact_shipments").select(*FACT_SHIPMENTS))


@query
def first_wins_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle and destination of each customer's first record: attributes that conflict."""
    records = built.placed(spark, sf_dir)
    attributes = ["plate_number", "destination_city", "origin_city", "delay_minutes"]

    def build(root: str) -> DataFrame:
        return first_attributes(records, ["company_name"], attributes, [POSITION], root)

    return built.once(spark, sf_dir, "first_wins", build)


def _rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw(spark, built.rolled_root(spark, sf_dir), formats=("parquet",))


@query
def rolled_files_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First whole record of each shipment in a run of very many files."""
    return first_rows(_rolled(spark, sf_dir), ["source_shipment_id"], ORDER).select(*RAW_SCHEMA)


@query
def rolled_files_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = ["plate_number", "destination_city", "origin_city", "delay_minutes"]
    return first_attributes(_rolled(spark, sf_dir), ["company_name"], attributes, ORDER)


@query
def mixed_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of two writers read as one."""
    records = read_raw(spark, built.mixed_root(spark, sf_dir), formats=("parquet",))
    return records.select(*RAW_SCHEMA, "raw_file")


@query
def reload_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows per table of three loads: early run, all runs, all runs again."""
    _, loads = built.grown_warehouse(spark, sf_dir)
    rows = [
        (number, table, new)
        for number, load in enumerate(loads, start=1)
        for table, new in load.items()
    ]
    return spark.createDataFrame(rows, "load_number int, table_name string, new_rows bigint")


@query
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts after the three loads, by natural keys."""
    wh, _ = built.grown_warehouse(spark, sf_dir)
    return star.star(wh).select(
        "source_shipment_id",
        "raw_file",
        "company_name",
        "driver_name",
        "plate_number",
        "origin_city",
        "destination_city",
        "full_date",
        "status",
        "cost_usd",
    )


# ---- star queries --------------------------------------------------------------------

_on_warehouse("star_extract", lambda wh: star.extract(wh).select(*star.EXTRACT))
_on_warehouse("shipment_page", star.shipment_page, limit=50, offset=100)
_on_warehouse("shipment_page_status", star.shipment_page, limit=50, offset=25, status="delayed")
_on_warehouse("shipment_page_deep", star.shipment_page, limit=500, offset=20_000, status="on_time")
_on_warehouse("shipment_page_after", star.shipments_after, last_id=1_000, limit=100)
_on_warehouse("shipment_detail", star.shipment_detail, shipment_id=4_242)
_on_warehouse("raw_explorer", lambda wh: star.explorer(star.extract(wh)))

_on_warehouse("explorer_newest", star.newest, limit=500, offset=1_000)

# ---- KPIs ----------------------------------------------------------------------------

for _plan in (
    kpis.kpi_summary,
    kpis.kpi_by_month,
    kpis.kpi_by_region,
    kpis.driver_scorecard,
    kpis.route_scorecard,
    kpis.weather_impact,
):
    _on_warehouse(_plan.__name__, _plan)



def _after_three_loads(name: str, plan: Callable[..., DataFrame]) -> None:
    """From the summaries of three loads."""
    QUERIES[f"{name}_grown"] = lambda spark, sf_dir: plan(built.grown_warehouse(spark, sf_dir)[0])


for _plan in (kpis.kpi_summary, kpis.kpi_by_month, kpis.kpi_by_region, kpis.weather_impact):
    _after_three_loads(_plan.__name__, _plan)
# Numbers given by several loads differ from those of one.
_after_three_loads("driver_scorecard", lambda wh: kpis.driver_scorecard(wh).drop("driver_id"))
_after_three_loads("route_scorecard", lambda wh: kpis.route_scorecard(wh).drop("route_id"))
_after_three_loads("quality_report", quality.warehouse_details)
_after_three_loads(
    "duplicate_shipments",
    lambda wh: wh.repeated_pickups()
    .join(wh.table("dim_customer"), "customer_id")
    .select("company_name", "scheduled_pickup", "shipments"),
)

# ---- gaps: idle drivers and routes, unknown references and values -----------------------


class GappyWarehouse:
    """The loaded tables with one idle driver and route, and facts with unknown values."""

    def __init__(self, wh) -> None:
        self.wh, self.spark = wh, wh.spark

    def table(self, name: str) -> DataFrame:
        rows = self.wh.table(name)
        if name == "dim_driver":
            idle = (0, "Idle Driver", "C", 3, Decimal("4.20"), "NOWHERE", True)
            return rows.unionByName(self.spark.createDataFrame([idle], rows.schema))
        if name == "dim_route":
            idle = (0, "A-HUB", "A", "B-HUB", "B", 700, "NOWHERE", "Road")
            return rows.unionByName(self.spark.createDataFrame([idle], rows.schema))
        if name != "fact_shipments":
            return rows
        k = F.split_part("source_shipment_id", F.lit("-"), F.lit(2)).cast("bigint") % 97
        gaps = {
            "driver_id": k == 1,
            "route_id": k == 2,
            "status": k == 6,
            "delay_minutes": k == 8,
            "weather_condition": k % 10 == 0,
            "traffic_condition": k % 7 == 0,
        }
        return rows.withColumns({n: F.when(~gap, F.col(n)) for n, gap in gaps.items()})

    def dimension(self, name: str) -> DataFrame:
        return self.table(name)


def _with_gaps(name: str, plan: Callable[..., DataFrame]) -> None:
    QUERIES[f"{name}_gaps"] = lambda spark, sf_dir: plan(
        GappyWarehouse(built.warehouse(spark, sf_dir))
    )


for _plan in (
    kpis.kpi_summary,
    kpis.kpi_by_region,
    kpis.driver_scorecard,
    kpis.route_scorecard,
    kpis.weather_impact,
):
    _with_gaps(_plan.__name__, _plan)
for _plan in (dashboard.status_mix, dashboard.weather_delay, dashboard.traffic_delay):
    _with_gaps(_plan.__name__, lambda wh, plan=_plan: plan(star.extract(wh)))
_with_gaps("star_extract", lambda wh: star.extract(wh).select(*star.EXTRACT))
_with_gaps(
    "features",
    lambda wh: with_features(training.training_set(wh), built.FEATURE_YEAR).select(
        training.KEY, training.LABEL, *FEATURES
    ),
)

# ---- dashboard -----------------------------------------------------------------------

CHOICE = {"years": [1996, 1997], "statuses": ["on_time", "failed"], "regions": ["ASIA", "EUROPE"]}


@query
def panel_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star.extract(built.warehouse(spark, sf_dir))
    return dashboard.panel(dashboard.require_rows(dashboard.filtered(rows, **CHOICE)))


@query
def filter_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star.extract(built.warehouse(spark, sf_dir))
    return dashboard.all_options(rows, ["year", "status", "region"])


for _plan in (
    dashboard.panel,
    dashboard.status_mix,
    dashboard.monthly_on_time,
    dashboard.weekday_delay,
    dashboard.segment_revenue,
    dashboard.monthly_revenue,
    dashboard.top_drivers,
    dashboard.vehicle_delay,
    dashboard.weather_delay,
    dashboard.traffic_delay,
    dashboard.page,
):
    _chart("dashboard_page" if _plan is dashboard.page else _plan.__name__, _plan)

_chart("top_drivers_fallback", lambda rows: dashboard.top_drivers(rows, min_trips=10**9))

# ---- lake ----------------------------------------------------------------------------


@query
def lake_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_plans.delay_by_weather(spark, built.lake(spark, sf_dir))


@query
def lake_weather_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the runs of two writers, whose columns differ in type."""
    return lake_plans.delay_by_weather(spark, built.mixed_lake(spark, sf_dir))


@query
def lake_traffic_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_plans.delay_by_traffic(spark.table(built.mixed_lake(spark, sf_dir)))


@query
def lake_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_plans.delay_by_traffic(spark.table(built.lake(spark, sf_dir)))


@query
def lake_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_plans.row_count(spark.table(built.lake(spark, sf_dir)))


@query
def batch_delay_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_plans.delay_rate(built.raw(spark, sf_dir))


# ---- quality -------------------------------------------------------------------------


def _dirty(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Warehouse tables damaged in known ways, by order key modulo 97."""
    tables = quality.warehouse_tables(built.warehouse(spark, sf_dir))
    fact = tables["fact_shipments"]
    k = F.split_part("source_shipment_id", F.lit("-"), F.lit(2)).cast("bigint") % 97
    c = F.col
    flag = F.when(k == 4, ~c("is_delayed")).when(k != 5, c("is_delayed"))
    status = F.when(k == 2, "lost").when(k != 6, c("status"))
    damage = {
        "customer_id": F.when(k != 0, c("customer_id")),
        "driver_id": F.when(k == 1, F.lit(999_999_999)).otherwise(c("driver_id")),
        "status": F.when(k == 5, c("status")).otherwise(status),
        "cost_usd": F.when(k == 3, F.lit(-1).cast("decimal(10,2)")).otherwise(c("cost_usd")),
        "is_delayed": flag,
        "date_id": F.when(k == 7, F.lit(999_999_999)).otherwise(c("date_id")),
    }
    rating = F.when(c("driver_id") == 7, F.lit(5.50)).otherwise(c("rating"))
    tables["dim_driver"] = tables["dim_driver"].withColumn("rating", rating.cast("decimal(3,2)"))
    tables["fact_shipments"] = fact.withColumns(damage)
    return tables


@query
def quality_report_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.details(quality.warehouse_tables(built.warehouse(spark, sf_dir)))


@query
def quality_report_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.details(_dirty(spark, sf_dir))


@query
def quality_summary_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(quality.details(_dirty(spark, sf_dir)))


@query
def quality_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts(quality.warehouse_tables(built.warehouse(spark, sf_dir)))


@query
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the gate stops the pipeline, and over how many critical checks."""
    clean = quality.warehouse_tables(built.warehouse(spark, sf_dir))
    rows = []
    for variant, tables in (("clean", clean), ("dirty", _dirty(spark, sf_dir))):
        try:
            passed = quality.gate(quality.details(tables))
            rows.append((variant, False, sum(not passed[name] for name in quality.CRITICAL)))
        except quality.CriticalCheckFailed as stop:
            rows.append((variant, True, sum(name in str(stop) for name in quality.CRITICAL)))
    return spark.createDataFrame(rows, "variant string, stopped boolean, failed_critical bigint")


@query
def failed_load_invisible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table after a good load and one that broke the contract."""
    return quality.row_counts(quality.warehouse_tables(built.interrupted(spark, sf_dir)))


@query
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lost references per foreign key."""
    lost = quality.lost_references(_dirty(spark, sf_dir))
    return lost.select("foreign_key", F.col("n").alias("shipments"))


@query
def duplicate_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = built.warehouse(spark, sf_dir)
    return quality.duplicate_shipments(wh.table("fact_shipments"))


# ---- record rules --------------------------------------------------------------------


@query
def delay_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    risk = conditions.delay_risk(
        c("weather_condition"),
        c("traffic_condition"),
        c("driver_rating"),
        c("manufacture_year"),
        c("mileage_km"),
        c("distance_km"),
        built.FEATURE_YEAR,
    )
    rows = star.star(built.warehouse(spark, sf_dir))
    return rows.select("source_shipment_id", F.round(risk, 2).alias("delay_risk"))


@query
def congestion_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event read as a speed measurement; some have no free-flow speed."""
    speeds = feed.read(spark, sf_dir, "events")
    free_flow = (F.col("user_id") % 5 * 20).cast("double")
    ratio = conditions.congestion_ratio(F.col("value"), free_flow)
    rated = speeds.select("event_id", ratio.alias("ratio"))
    return rated.withColumn("traffic_condition", conditions.congestion_class(F.col("ratio")))


FEED_CODES = [*conditions.WEATHER_CODES, "Tornado"]


@query
def weather_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event read as a weather observation."""
    seen = feed.read(spark, sf_dir, "events")
    code = feed.pick(F.col("event_id") % len(FEED_CODES), FEED_CODES)
    return seen.select(
        "event_id",
        conditions.weather_condition(code).alias("weather_condition"),
        conditions.wind_kmh(F.col("value")).alias("wind_speed_kmh"),
    )


@query
def status_from_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status, durations and delivery times recomputed from delay and distance."""
    c = F.col
    planned = schedule.planned_hours(c("distance_km"))
    actual = schedule.actual_hours(planned, c("delay_minutes"))
    facts = built.warehouse(spark, sf_dir).table("fact_shipments")
    return facts.select(
        "source_shipment_id",
        conditions.is_late(c("delay_minutes")).alias("is_delayed"),
        conditions.status_of(c("delay_minutes")).alias("status"),
        planned.alias("planned_duration_hrs"),
        actual.alias("actual_duration_hrs"),
        schedule.after_hours(c("scheduled_pickup"), planned).alias("scheduled_delivery"),
        schedule.after_hours(c("actual_pickup"), actual).alias("actual_delivery"),
    )


AS_OF = "2001-07-01 00:00:00"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event read as an observation at one of twenty origin cities; five have none."""
    c = F.col
    user = c("user_id")
    return feed.read(spark, sf_dir, "events").select(
        F.concat(F.lit("NATION_"), (user % 20).cast("string"), F.lit("-HUB")).alias("city"),
        feed.pick(user % len(FEED_CODES), FEED_CODES).alias("weather_code"),
        (user % 45 - 10).cast("double").alias("temperature_celsius"),
        (user % 30 * 0.7).alias("wind_speed_ms"),
        (user % 60).cast("double").alias("current_speed"),
        (user % 4 * 20).cast("double").alias("free_flow_speed"),
    )


@query
def recent_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipments = built.raw(spark, sf_dir).select(
        "source_shipment_id",
        "origin_city",
        "scheduled_pickup",
        "weather_condition",
        "temperature_celsius",
        "wind_speed_kmh",
        "traffic_congestion_ratio",
        "traffic_condition",
    )
    as_of = F.lit(AS_OF).cast("timestamp")
    return enrich_recent(shipments, observations(spark, sf_dir), as_of)


# ---- streams -------------------------------------------------------------------------


@query
def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoding and enrichment over the message texts; the stream uses the same functions."""
    return enrich(decode(feed.event_messages(spark, sf_dir))).drop("message")


@query
def event_publish_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message keys with the event that a consumer reads back from each message."""
    messages = publish_frame(feed.events(spark, sf_dir))
    event = F.from_json("value", ddl(EVENT_SCHEMA))
    return messages.select(F.col("key").alias("message_key"), event.alias("e")).select(
        "message_key", "e.*"
    )


@query
def stream_upsert_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built.event_table(spark, sf_dir).events().select(*REALTIME_TYPES)


@query
def stream_upsert_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built.stateful_event_table(spark, sf_dir).events().select(*REALTIME_TYPES)


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages set aside, each once, although all were replayed."""
    return built.event_table(spark, sf_dir).quarantine().select("message", "reason")


# ---- models --------------------------------------------------------------------------


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training.training_set(built.warehouse(spark, sf_dir))
    return with_features(rows, built.FEATURE_YEAR)


@query
def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).select(training.KEY, training.LABEL, *FEATURES)


@query
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _features(spark, sf_dir)
    known = built.once(
        spark, sf_dir, "dictionary", lambda root: training.dictionary(rows, root)
    )
    return training.encode(rows, known).select(
        training.KEY, *[F.col(f"{name}_index").cast("int").alias(name) for name in CATEGORICAL]
    )


@query
def stratified_test_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training.training_set(built.warehouse(spark, sf_dir))
    split = stratified_split(rows, training.LABEL, training.KEY)
    return split.select(training.KEY, training.LABEL, "is_test")


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of a rule instead of a model: the delay risk, late from 0.3 on."""
    c = F.col
    facts = star.star(built.warehouse(spark, sf_dir))
    risk = conditions.delay_risk(
        c("weather_condition"),
        c("traffic_condition"),
        c("driver_rating"),
        c("manufacture_year"),
        c("mileage_km"),
        c("distance_km"),
        built.FEATURE_YEAR,
    )
    rated = facts.select(
        training.KEY, c("is_delayed").cast("int").alias(training.LABEL), F.round(risk, 2).alias("r")
    )
    model = F.when(F.substring(training.KEY, -1, 1).isin("1", "2"), "odd").otherwise("even")
    return rated.select(
        model.alias("model"),
        training.KEY,
        training.LABEL,
        (c("r") >= 0.3).cast("double").alias("prediction"),
        c("r").alias("probability"),
    )


@query
def rule_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    right = training.accuracy(_rated(spark, sf_dir))
    return right.select("model", F.round("accuracy", 9).alias("accuracy"))


@query
def rule_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = _rated(spark, sf_dir)
    return built.once(
        spark, sf_dir, "rule_auc", lambda root: training.roc_auc(rated, root)
    ).select("model", F.round("roc_auc", 9).alias("roc_auc"))


@query
def rule_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = _rated(spark, sf_dir)
    points = built.once(spark, sf_dir, "rule_roc", lambda root: training.roc_points(rated, root))
    rounded = [F.round(name, 9).alias(name) for name in ("fpr", "tpr")]
    return points.select("model", "threshold", *rounded)


@query
def rule_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.confusion(_rated(spark, sf_dir))


@query
def rule_risk_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    probability = F.col("probability")
    return _rated(spark, sf_dir).select(
        training.KEY,
        risk_band(probability).alias("risk_level"),
        probability_pct(probability).alias("delay_probability"),
    )


@query
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.metrics_frame(spark, built.models(spark, sf_dir))


@query
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion matrix of the stored model on the test set."""
    root = built.models(spark, sf_dir)
    best = training.ModelStore(spark, root).details()["model_name"]
    return training.confusion(training.predictions(spark, root).filter(F.col("model") == best))


@query
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = built.models(spark, sf_dir)
    return training.roc_points(training.predictions(spark, root), f"{root}/roc")


@query
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.feature_importance(spark, built.models(spark, sf_dir))


@query
def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipments = training.training_set(built.warehouse(spark, sf_dir)).drop(training.LABEL)
    scored = score(shipments, built.models(spark, sf_dir), built.FEATURE_YEAR)
    return scored.drop("predicted_at")
