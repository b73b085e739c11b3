"""Aggregate expressions behind the KPIs.

Ratios divide an exact sum by a count, so they do not depend on the order in which
partitions are merged. ``try_divide`` yields NULL over no rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def n_where(condition: Column) -> Column:
    """Number of rows for which the condition holds (NULL does not)."""
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole)


def exact_ratio(part: Column, whole: Column, digits: int) -> Column:
    """Quotient in decimal arithmetic, rounded half up: no binary noise at a tie."""
    quotient = F.try_divide(part.cast("decimal(28,2)"), whole.cast("decimal(20,0)"))
    return F.round(quotient, digits).cast("double")


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return exact_ratio(100 * part, whole, digits)


def money(total: Column) -> Column:
    return total.cast("double")
