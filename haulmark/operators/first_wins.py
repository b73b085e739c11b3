"""First-wins deduplication by key under a total order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmark.operators import bitmap
from haulmark.schemas import ddl


def at_first_positions(
    rows: DataFrame, keys: list[str], position: str, staging: str
) -> DataFrame:
    """The rows at a position, a number from 0 on, that is some key's first; nothing is lost
    that may come first.

    Only keys and positions are dealt out. The first positions are a bitmap, written to
    ``staging``, that every task gets, so rows of any width go no further than their scan; if the
    bitmap is too large, rows meet the positions instead.
    """
    firsts = rows.groupBy(*keys).agg(F.min(position).alias(position))
    bitmap.built(firsts, position).write.mode("overwrite").parquet(staging)
    held = rows.sparkSession.read.schema(ddl(bitmap.SCHEMA)).parquet(staging)
    if bitmap.fits(held.count()):
        return bitmap.held(rows, held, position)
    return rows.join(firsts.select(position).hint("shuffle_hash"), position, "left_semi")


def first_attributes(
    rows: DataFrame,
    keys: list[str],
    attributes: list[str],
    order: list[str],
    staging: str | None = None,
) -> DataFrame:
    """One row per key with the attributes of its first record; for narrow attributes.

    The first step collapses equal (key, attributes) pairs of a file to their smallest
    row. Its only buffer is a number (the last order column), so it is a hash aggregate that
    already shrinks the data before the shuffle, however often one key repeats. The second
    step picks the first version per key from what is left; at equal positions the
    smaller attributes win, so the result never depends on the order of arrival.

    ``staging``, for attributes that differ from record to record under an order of one
    position: rows are cut down by :func:`at_first_positions` before.
    """
    *coarse, fine = order
    if staging is not None:
        rows = at_first_positions(rows.select(*keys, *attributes, *order), keys, fine, staging)
    versions = rows.groupBy(*keys, *attributes, *coarse).agg(F.min(fine).alias(fine))
    rank = F.struct(*order, *attributes)
    first = F.min_by(F.struct(*attributes), rank).alias("_first")
    return versions.groupBy(*keys).agg(first).select(*keys, "_first.*")


def first_rows(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first whole row per key; for wide rows.

    ``row_number() = 1`` lets Spark keep one row per key and task before the shuffle, so
    a key that owns a third of the input does not overload one reducer.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
