"""Planned and actual durations and the timestamps that follow from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: planning speed in km/h.
PLANNING_SPEED = 75
HOURS = "decimal(6,2)"


def planned_hours(distance_km: Column) -> Column:
    return F.round(distance_km / PLANNING_SPEED, 2).cast(HOURS)


def actual_hours(planned: Column, delay_minutes: Column) -> Column:
    return F.round(planned.cast("double") + delay_minutes / 60, 2).cast(HOURS)


def after_minutes(start: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes.cast("int"), start)


def after_hours(start: Column, hours: Column) -> Column:
    """Start plus decimal hours, exact to the second (a hundredth of an hour is 36 s)."""
    return F.timestamp_add("SECOND", F.round(hours * 3600, 0).cast("int"), start)
