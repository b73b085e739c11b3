"""Joins on keys: insert-if-absent, and lookups whose broadcast depends on a known size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest lookup table that is sent to every executor. Beyond it the join has no hint and
# adaptive execution shuffles both sides, splitting skewed keys.
BROADCAST_BYTES = 64 << 20
_WIDTH = {"string": 100, "binary": 100, "boolean": 1, "int": 4, "float": 4, "date": 4}


def row_bytes(table: DataFrame) -> int:
    """Bytes a row takes in memory; texts are taken to be long."""
    return 16 + sum(_WIDTH.get(kind, 16) for _, kind in table.dtypes)


def fits(table: DataFrame, rows: int) -> bool:
    return rows * row_bytes(table) <= BROADCAST_BYTES


def sized(table: DataFrame, rows: int) -> DataFrame:
    """Mark a lookup table of a known number of rows for broadcast if its size allows it."""
    return F.broadcast(table) if fits(table, rows) else table


def counted(table: DataFrame) -> DataFrame:
    """As :func:`sized` for a table of unknown size; counts no more rows than would fit."""
    most = BROADCAST_BYTES // row_bytes(table) + 1
    return sized(table, table.limit(max(1, most)).count())


def rank_in(value: Column, bounds: list) -> Column:
    """How many of the ascending bounds are not above the value, by binary search."""
    if not bounds:
        return F.lit(0)
    held = F.array(*[F.lit(bound) for bound in bounds])
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def further(found: Column, step: Column) -> Column:
        """A step beyond the last bound finds NULL and is not taken."""
        passed = F.get(held, found + step - 1) <= value
        return found + F.when(passed, step).otherwise(0)

    return F.aggregate(F.array(*[F.lit(step) for step in steps]), F.lit(0), further)


def absent(
    candidates: DataFrame,
    existing: DataFrame,
    keys: list[str],
    rows: int,
    suspects: DataFrame | None = None,
) -> DataFrame:
    """Candidates whose key is not in ``existing``.

    The semi join first cuts the ever-growing existing side down to the keys of this
    batch; a small batch is broadcast against a scan of the key columns alone, so history
    is never shuffled. The anti join then works on batch-sized inputs. ``suspects``: the
    candidates that may exist, if others are known not to. ``rows`` is their number, or that of
    the candidates.
    """
    batch_keys = (candidates if suspects is None else suspects).select(*keys)
    known = existing.select(*keys).join(sized(batch_keys, rows), keys, "left_semi")
    return candidates.join(sized(known, rows), keys, "left_anti")
