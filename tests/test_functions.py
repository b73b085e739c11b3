"""Edge rules of the column expressions."""

import datetime

import pytest
from pyspark.sql import functions as F

from haulmark.functions import calendar, conditions, events, features, metrics, schedule


def evaluate(spark, value_type, values, expression):
    schema = f"i int, x {value_type}"
    rows = spark.createDataFrame(list(enumerate(values)), schema)
    found = rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
    return [row["y"] for row in found]


def test_congestion_class_bounds(spark):
    ratios = [0.80, 0.79, 0.50, 0.49]
    assert evaluate(spark, "double", ratios, conditions.congestion_class) == [
        "LOW",
        "MEDIUM",
        "MEDIUM",
        "HIGH",
    ]


def test_congestion_ratio_without_free_flow(spark):
    flows = [0.0, None, 80.0]
    ratio = evaluate(
        spark, "double", flows, lambda free: conditions.congestion_ratio(F.lit(30.0), free)
    )
    assert ratio == [1.0, 1.0, 0.38]


def test_weather_codes(spark):
    codes = ["Thunderstorm", "Mist", "Haze", "Drizzle", "Clouds", "Tornado", None]
    assert evaluate(spark, "string", codes, conditions.weather_condition) == [
        "Storm",
        "Fog",
        "Fog",
        "Rain",
        "Cloudy",
        "Clear",
        "Clear",
    ]


def test_wind_speed(spark):
    assert evaluate(spark, "double", [10.0], conditions.wind_kmh) == [36.0]


def test_status_from_delay(spark):
    delays = [0, 30, 31, 240, 241]
    assert evaluate(spark, "int", delays, conditions.status_of) == [
        "on_time",
        "on_time",
        "delayed",
        "delayed",
        "failed",
    ]


@pytest.mark.parametrize(
    ("weather", "traffic", "rating", "year", "mileage", "distance", "risk"),
    [
        ("Clear", "LOW", 4.5, 2025, 1000, 500, 0.10),
        ("Snow", "HIGH", 2.9, 2010, 200001, 2001, 0.93),
        ("Snow", "HIGH", 2.9, 2010, 200000, 2001, 0.83),
        ("Storm", "UNKNOWN", 3.0, 2021, 0, 1001, 0.30),
        ("Storm", "UNKNOWN", 4.0, 2020, 0, 1000, 0.25),
    ],
)
def test_delay_risk(spark, weather, traffic, rating, year, mileage, distance, risk):
    column = conditions.delay_risk(
        F.lit(weather),
        F.lit(traffic),
        F.lit(rating),
        F.lit(year),
        F.lit(mileage),
        F.lit(distance),
        2026,
    )
    assert spark.range(1).select(column).first()[0] == pytest.approx(risk)


def test_durations_and_times(spark):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    planned = schedule.planned_hours(F.lit(310))
    row = spark.range(1).select(
        planned.alias("planned"),
        schedule.actual_hours(planned, F.lit(40)).alias("actual"),
        schedule.after_hours(start, planned).alias("delivery"),
        schedule.after_minutes(start, F.lit(75)).alias("pickup"),
    )
    row = row.first()
    assert (float(row["planned"]), float(row["actual"])) == (4.13, 4.80)
    assert row["delivery"] == datetime.datetime(2024, 1, 1, 4, 7, 48)
    assert row["pickup"] == datetime.datetime(2024, 1, 1, 1, 15)


def test_calendar_columns(spark):
    day = F.lit("2024-02-03").cast("date")
    row = spark.range(1).select(*calendar.calendar_columns(day)).first()
    assert row.asDict() == {
        "full_date": datetime.date(2024, 2, 3),
        "day": 3,
        "month": 2,
        "month_name": "February",
        "quarter": 1,
        "year": 2024,
        "weekday": "Saturday",
        "is_weekend": True,
    }


def test_period_and_order(spark):
    row = spark.range(1).select(
        calendar.period_label(F.lit("September"), F.lit(2024)).alias("period"),
        calendar.ordinal(F.lit("Sunday"), calendar.WEEKDAYS).alias("sunday"),
        calendar.ordinal(F.lit("Someday"), calendar.WEEKDAYS).alias("unknown"),
    )
    assert row.first().asDict() == {"period": "Sep 2024", "sunday": 7, "unknown": None}


def test_bad_timestamp_text_is_null(spark):
    texts = ["2024-01-02T03:04:05", "zzz", None]
    assert evaluate(spark, "string", texts, calendar.iso_timestamp) == [
        datetime.datetime(2024, 1, 2, 3, 4, 5),
        None,
        None,
    ]


def test_event_cost_per_km(spark):
    distances = [0.0, None, -1.0, 4.0]
    costs = evaluate(
        spark, "double", distances, lambda d: events.cost_per_km(F.lit(10.0), d)
    )
    assert costs == [0.0, 0.0, 0.0, 2.5]


def test_event_weather_risk(spark):
    temperature = [40.0, 40.1, 0.0, -0.1, None]
    assert evaluate(
        spark, "double", temperature, lambda t: events.weather_risk(t, F.lit(90.0))
    ) == ["LOW", "HIGH", "LOW", "HIGH", "LOW"]
    humidity = [90.0, 90.1, None]
    assert evaluate(
        spark, "double", humidity, lambda h: events.weather_risk(F.lit(20.0), h)
    ) == ["LOW", "MEDIUM", "LOW"]


def test_risk_band(spark):
    assert evaluate(spark, "double", [0.7, 0.69, 0.4, 0.39], features.risk_band) == [
        "HIGH",
        "MEDIUM",
        "MEDIUM",
        "LOW",
    ]


def test_exact_ratio_rounds_half_up_and_survives_no_rows(spark):
    # 41 / 4000 = 1.025 percent: the double next to it lies below the tie
    column = metrics.pct(F.lit(41).cast("bigint"), F.lit(4000).cast("bigint"))
    nothing = metrics.pct(F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))
    row = spark.range(1).select(column.alias("a"), nothing.alias("b")).first()
    assert (row["a"], row["b"]) == (1.03, None)
