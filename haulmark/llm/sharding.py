"""Deal rows to shards by jump consistent hashing. Built-in expressions only.

A key jumps along the growing number of shards: from shard b, a number drawn from (key, b)
names the next shard count at which the key moves. The last jump below the shard count is
its shard. One shard more can only append one jump, so a row stays or moves to the new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.tables import numbered, written

SHARDS = 8
LAW = "key"
_SCALE = 1 << 32
_USUAL_JUMPS = 64  # a key makes about ln(shards) jumps; more are walked in full, see below


def _next(key: Column, shard: Column) -> Column:
    """The shard count minus one at which the key leaves ``shard``: floor((b + 1) / r)."""
    digest = F.md5(F.concat(key, F.lit(":"), shard.cast("string")))
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + 1  # 1 .. 2^32
    return F.floor((shard + 1) * F.lit(_SCALE).cast("bigint") / drawn).cast("bigint")


def _walk(key: Column, start: Column, shards: int, jumps: int) -> Column:
    """struct(at, to) after at most so many jumps; it stands still once ``to`` is too far."""

    def jump(state: Column, _: Column) -> Column:
        moved = F.struct(state["to"].alias("at"), _next(key, state["to"]).alias("to"))
        return F.when(state["to"] >= shards, state).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(1), F.lit(jumps)), start, jump)


def shard_of(key: Column, shards: int) -> Column:
    """Shard 0 .. shards - 1 of a string key; a null key counts as the empty string."""
    key = F.coalesce(key, F.lit(""))
    zero = F.lit(0).cast("bigint")
    walked = _walk(key, F.struct(zero.alias("at"), _next(key, zero).alias("to")), shards,
                   min(shards, _USUAL_JUMPS))
    if shards > _USUAL_JUMPS:  # exact also for the key that jumps unusually often
        walked = F.when(walked["to"] < shards, _walk(key, walked, shards, shards)).otherwise(
            walked
        )
    return walked["at"].cast("int")


def shards(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    Size is the text's UTF-8 bytes plus 1 (null: no bytes); the CRC of null is that of the
    empty text. Only doc_id and the number of shards decide the shard: null ids share one.
    Slots number a shard's rows in order of doc_id (nulls last) without gaps; they come from
    one numbering of all rows by (shard, doc_id), so no task holds a shard. Repeated rows get
    slots of their own. Other columns are not read; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.col("doc_id").cast("string")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        shard_of(key, n_shards).alias("shard"),
        shard_of(key, n_shards + 1).alias("grown_shard"),
    )
    order = [F.col("shard"), F.col("doc_id").asc_nulls_last(), F.col("text_crc32"), F.col("size")]
    placed = numbered(written(rows, "sharded"), order)
    starts = placed.groupBy("shard").agg(F.min("position").alias("_start"))  # n_shards rows
    return (
        placed.join(starts, "shard")
        .withColumn("slot", F.col("position") - F.col("_start"))
        .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    )
