"""Raw shipment records and stream events derived from the given order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmark.functions import conditions, schedule
from haulmark.functions.conditions import lookup
from haulmark.operators.keyed import fits
from haulmark.schemas import RAW_SCHEMA
from haulmark.sources.events import publish_frame

# Order of records that share an order line: the first of them is "first in file".
LINE_ORDER = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_shipdate",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
LINE_DETAILS = [
    "o_orderdate",
    "c_custkey",
    "c_name",
    "c_nationkey",
    "c_mktsegment",
    "s_suppkey",
    "s_name",
    "s_nationkey",
    "p_partkey",
    "p_type",
    "p_size",
]
WEATHER_POINTS = {name: int(round(risk * 100)) for name, risk in conditions.WEATHER_RISK.items()}
TRAFFIC_POINTS = {name: int(round(risk * 100)) for name, risk in conditions.TRAFFIC_RISK.items()}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(number: Column, choices: list[str]) -> Column:
    return lookup(number, dict(enumerate(choices)), None)


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> tuple[DataFrame, bool]:
    """Columns of a table marked for a join, and whether its counted rows let every task have it."""
    rows = read(spark, sf_dir, name).select(*columns)
    few = fits(rows, rows.count())  # from file footers
    return F.broadcast(rows) if few else rows.hint("shuffle_hash"), few


def _lookups(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, bool, str, str]]:
    """Parts and suppliers, as :func:`_table` gives them, and the keys that lines meet them by."""
    parts = _table(spark, sf_dir, "part", "p_partkey", "p_type", "p_size")
    suppliers = _table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    return [(*parts, "l_partkey", "p_partkey"), (*suppliers, "l_suppkey", "s_suppkey")]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customers."""
    names = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    customers, _ = _table(spark, sf_dir, "customer", *names)
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def narrow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line with its order, customer, supplier and part, without nations' names.

    Customers meet the orders, of which there are fewer than lines. A table is sent to every
    task if its counted rows allow it; Spark's estimate of a join is far off. What is too large
    for that is hashed, so that the lines are not sorted.
    """
    lines = read(spark, sf_dir, "lineitem").select(*LINE_ORDER)
    for table, _, ours, theirs in _lookups(spark, sf_dir):
        lines = lines.join(table, F.col(ours) == F.col(theirs))
    orders = _orders(spark, sf_dir).hint("shuffle_hash")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *LINE_ORDER, *LINE_DETAILS
    )


def _nations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Nations as those of suppliers and, with their regions, of customers; they are few."""
    c = F.col
    nations, regions = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    of_supplier = nations.select(
        c("n_nationkey").alias("s_nationkey"), c("n_name").alias("s_nation")
    )
    of_customer = nations.join(regions, c("n_regionkey") == c("r_regionkey")).select(
        c("n_nationkey").alias("c_nationkey"), c("n_name").alias("c_nation"), "r_name"
    )
    return F.broadcast(of_supplier), F.broadcast(of_customer)


def with_nations(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines with the nations' names."""
    of_supplier, of_customer = _nations(spark, sf_dir)
    return lines.join(of_supplier, "s_nationkey").join(of_customer, "c_nationkey")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line with its order, customer, supplier, part and nations."""
    return with_nations(spark, sf_dir, narrow_lines(spark, sf_dir))


def ordered_lines(spark: SparkSession, sf_dir: str, tasks: int = 0) -> DataFrame:
    """As :func:`order_lines`, in record order over the partitions (``tasks`` of them, 0: as many
    as a shuffle has), dealt by one exchange.

    Orders and lines are dealt by ranges of the order key together and sorted, an order before
    its lines, which take it over from there. So the lines are neither joined by hash first nor
    written in between. Tables sent to every task are looked up behind the sort, so that what is
    dealt holds no nations' names, nor a key twice.
    """
    c = F.col
    lines = read(spark, sf_dir, "lineitem").select(*LINE_ORDER).filter("l_orderkey IS NOT NULL")
    lookups = _lookups(spark, sf_dir)
    for table, few, ours, theirs in lookups:
        if not few:
            lines = lines.join(table, c(ours) == c(theirs)).drop(theirs)
    details = F.struct("o_orderdate", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    orders = _orders(spark, sf_dir).select(c("o_orderkey").alias("l_orderkey"), details.alias("_order"))
    both = lines.withColumn("_line", F.lit(True)).unionByName(
        orders.withColumn("_line", F.lit(False)), allowMissingColumns=True
    )
    # A list, as a join would also find each of several orders of one key.
    before = Window.partitionBy("l_orderkey").orderBy("_line", *LINE_ORDER[1:])
    before = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = (
        both.repartitionByRange(*([tasks] if tasks else []), "l_orderkey")
        .withColumn("_orders", F.collect_list("_order").over(before))
        .filter("_line")
        .withColumn("_order", F.explode("_orders"))
        .drop("_orders", "_line")
        .select("*", "_order.*")
        .drop("_order")
    )
    for table, few, ours, theirs in lookups:
        if few:
            lines = lines.join(table, c(ours) == c(theirs))
        else:
            lines = lines.withColumn(theirs, c(ours).cast(table.schema[theirs].dataType))
    return with_nations(spark, sf_dir, lines)


def to_records(lines: DataFrame, *kept: Column) -> DataFrame:
    """The 41 raw columns of order lines, row by row, and ``kept`` ones besides."""
    c = F.col
    order, line = c("l_orderkey"), c("l_linenumber")
    supplier, part = c("s_suppkey"), c("p_partkey")
    # Columns, not named steps: Spark keeps steps that are used twice as projections of their
    # own, each of which copies the whole row; in one, what is shared is computed once.
    distance = 200 + (c("s_nationkey") * 97 + c("c_nationkey") * 61) % 2400
    w = (order * 17 + line) % 100
    weather = (
        F.when(w < 40, "Clear")
        .when(w < 65, "Cloudy")
        .when(w < 83, "Rain")
        .when(w < 90, "Heavy Rain")
        .when(w < 96, "Fog")
        .otherwise("Snow")
    )
    congestion = ((20 + (part * 13 + supplier) % 81) / 100).cast("decimal(4,2)")
    traffic = conditions.congestion_class(congestion)
    points = (
        F.lit(10)
        + lookup(weather, WEATHER_POINTS, 5)
        + lookup(traffic, TRAFFIC_POINTS, 5)
        + F.when(distance > 2000, 10).when(distance > 1000, 5).otherwise(0)
    )
    late = (order * 7 + line * 13 + part * 29) % 100 < points
    minutes = F.when(late, 31 + (order * 5 + line * 11) % 300).otherwise((order * 3 + line) % 31)
    planned = schedule.planned_hours(distance)
    actual = schedule.actual_hours(planned, minutes)
    scheduled_pickup = schedule.after_minutes(
        c("o_orderdate").cast("timestamp"), 360 + (order * 11 + line) % 720
    )
    actual_pickup = schedule.after_minutes(scheduled_pickup, (order + line * 3) % 20)
    text = F.concat
    values = {
        "source_shipment_id": text(
            F.lit("S-"), order.cast("string"), F.lit("-"), line.cast("string")
        ),
        "company_name": c("c_name"),
        "industry": text(F.lit("IND-"), (c("c_nationkey") % 5).cast("string")),
        "customer_country": c("c_nation"),
        "customer_city": text(F.lit("CITY-"), (c("c_custkey") % 50).cast("string")),
        "segment": c("c_mktsegment"),
        "contract_type": pick(c("c_custkey") % 3, ["Annual", "Monthly", "Spot"]),
        "driver_name": c("s_name"),
        "license_type": pick(supplier % 3, ["B", "C", "CE"]),
        "experience_years": supplier % 16,
        "driver_rating": 1 + (supplier % 41) / 10,
        "driver_country": c("s_nation"),
        "plate_number": text(F.lit("P-"), part.cast("string")),
        "vehicle_type": c("p_type"),
        "capacity_kg": 500 + c("p_size") * 490,
        "manufacture_year": 2005 + part % 19,
        "mileage_km": 5000 + (part * 137) % 300000,
        "origin_city": text(c("s_nation"), F.lit("-HUB")),
        "origin_country": c("s_nation"),
        "destination_city": text(c("c_nation"), F.lit("-HUB")),
        "destination_country": c("c_nation"),
        "region": c("r_name"),
        "route_type": pick((c("s_nationkey") + c("c_nationkey")) % 3, ["Road", "Air", "Sea"]),
        "distance_km": distance,
        "scheduled_pickup": scheduled_pickup,
        "actual_pickup": actual_pickup,
        "scheduled_delivery": schedule.after_hours(scheduled_pickup, planned),
        "actual_delivery": schedule.after_hours(actual_pickup, actual),
        "planned_duration_hrs": planned,
        "actual_duration_hrs": actual,
        "delay_minutes": minutes,
        "is_delayed": late,
        "status": conditions.status_of(minutes, late),
        "weather_condition": weather,
        "traffic_congestion_ratio": congestion,
        "traffic_condition": traffic,
        "weight_kg": c("l_quantity") * 100,
        "cost_usd": c("l_extendedprice"),
        "fuel_consumed_liters": distance * F.lit(0.30).cast("decimal(2,2)"),
        "temperature_celsius": ((part * 7) % 500) / 10 - 10,
        "wind_speed_kmh": ((supplier * 31 + line * 17) % 1000) / 10,
    }
    typed = [values[name].cast(kind).alias(name) for name, kind in RAW_SCHEMA.items()]
    return lines.select(*typed, *kept)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 16 event fields for every row of the events table."""
    c = F.col
    number, user = c("event_id"), c("user_id")
    delayed = number % 5 == 0
    return read(spark, sf_dir, "events").select(
        number.cast("string").alias("event_id"),
        "event_type",
        F.date_format(c("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
        F.concat(F.lit("RT-"), user.cast("string")).alias("shipment_id"),
        pick(number % 5, ["PENDING", "IN_TRANSIT", "DELIVERED", "DELAYED", "CANCELLED"]).alias(
            "status"
        ),
        F.concat(F.lit("C"), (number % 20).cast("string")).alias("origin_city"),
        F.concat(F.lit("C"), (user % 20).cast("string")).alias("destination_city"),
        pick(number % 5, ["TRUCK", "VAN", "MOTORCYCLE", "SHIP", "PLANE"]).alias("vehicle_type"),
        c("value").alias("weight_kg"),
        (number % 500).cast("double").alias("distance_km"),
        F.round(c("value") * 10, 2).alias("revenue"),
        delayed.alias("is_delayed"),
        F.when(delayed, 1 + number % 72).otherwise(0).cast("double").alias("delay_hours"),
        (1 + number % 5).cast("double").alias("driver_rating"),
        (number % 50 - 4).cast("double").alias("temperature_c"),
        (10 + number % 90).cast("double").alias("humidity_pct"),
    )


def _as_text(rows: DataFrame) -> DataFrame:
    return publish_frame(rows).select("value")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(events(spark, sf_dir))


def later_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once more, changed."""
    again = events(spark, sf_dir)
    return _as_text(again.withColumn("revenue", F.col("revenue") + 2))


def repeated_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event again with another revenue; a late one, one with a bad time, broken lines.

    Each message also has a field that nobody reads, so that these files are larger than
    those of the first copies.
    """
    again = events(spark, sf_dir).withColumn("note", F.repeat(F.lit("again "), 60))
    first = again.orderBy(F.col("event_id").cast("bigint")).limit(1)
    repeated = again.withColumn("revenue", F.col("revenue") + 1)
    late = first.withColumns(
        {"event_id": F.lit("late-1"), "event_timestamp": F.lit("2020-01-01T00:00:00")}
    )
    odd = first.withColumns({"event_id": F.lit("odd-1"), "event_timestamp": F.lit("zzz")})
    errors = again.filter(F.col("event_type") == "error")
    broken = errors.select(F.concat(F.lit("broken "), "event_id").alias("value"))
    return _as_text(repeated.unionByName(late).unionByName(odd)).unionByName(broken)
