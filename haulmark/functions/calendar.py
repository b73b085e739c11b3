"""Dates: calendar attributes, period labels, tolerant timestamp parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names in calendar order.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def calendar_columns(day: Column) -> list[Column]:
    """Attributes of one calendar day, named as in the date dimension."""
    return [
        day.alias("full_date"),
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.date_format(day, "EEEE").alias("weekday"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    ]


def period_label(month_name: Column, year: Column) -> Column:
    return F.concat_ws(" ", F.substring(month_name, 1, 3), year.cast("string"))


def ordinal(value: Column, ordered: list[str]) -> Column:
    """Position of a category in a custom order; unknown categories sort last (NULL)."""
    position = F.array_position(F.array(*[F.lit(item) for item in ordered]), value)
    return F.nullif(position.cast("int"), F.lit(0))


def iso_timestamp(text: Column) -> Column:
    """NULL for text that is not a timestamp, also with ANSI mode on."""
    return F.try_to_timestamp(text)
