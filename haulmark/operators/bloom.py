"""Bloom filters of the keys of a table's loads, as rows of blocks, and the keys they may hold.

A filter is cut into blocks of 4,096 bits. One hash of a key picks its block, another its bits
there, so a filter of any size is built by one aggregate over numbers, and a key is looked up in
one row. The number of blocks is a power of two, its exponent being the filter's level: loads of
like size share a level, and a key has the same block in all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.operators.keyed import sized

BITS_PER_KEY = 16  # at least; up to twice as many, as levels are powers of two
BITS_SET = 5  # by each key
_WORDS, _WORD_BITS = 64, 64
_PLACE_BITS = 12  # of a bit in its block
BLOCK_BITS = 1 << _PLACE_BITS
SCHEMA = {"level": "int", "block": "bigint", "words": "array<bigint>"}


def level_for(rows: int) -> int:
    """Exponent of the number of blocks of a filter for so many keys."""
    blocks = -(-max(1, rows) * BITS_PER_KEY // (_WORDS * _WORD_BITS))
    return max(0, blocks - 1).bit_length()


def _block(keys: list[str], level: int) -> Column:
    return F.xxhash64(F.lit("block"), *keys).bitwiseAND(F.lit((1 << level) - 1))


def _bits_hash(keys: list[str]) -> Column:
    return F.xxhash64(F.lit("bits"), *keys)


def _places(hashed: Column) -> list[Column]:
    """Numbers of a key's bits in its block, from its hash."""
    mask = F.lit((1 << _PLACE_BITS) - 1)
    return [
        F.shiftrightunsigned(hashed, _PLACE_BITS * i).bitwiseAND(mask) for i in range(BITS_SET)
    ]


def word_of(place: Column) -> Column:
    return F.shiftright(place, 6).cast("int")  # 64 bits a word


def bit_of(place: Column) -> Column:
    """The bit within its word, as a number with that bit alone."""
    inside = place.bitwiseAND(F.lit(_WORD_BITS - 1)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), inside)


def built(rows: DataFrame, keys: list[str], level: int) -> DataFrame:
    """The filter of the rows' keys: ``level``, ``block``, ``words``; NULL is a key like others."""
    # Dealt once, as one hash a key: what follows is grouped by block and stays in its task.
    hashed = rows.select(_block(keys, level).alias("block"), _bits_hash(keys).alias("_hash"))
    bits = hashed.repartition("block").select(
        "block", F.explode(F.array(*_places(F.col("_hash")))).alias("_place")
    ).select("block", word_of(F.col("_place")).alias("_word"), bit_of(F.col("_place")).alias("_bit"))
    return dense_blocks(bits).select(F.lit(level).alias("level"), "block", "words")


def dense_blocks(bits: DataFrame) -> DataFrame:
    """``block`` and its ``words`` from single bits: ``block``, ``_word``, ``_bit``."""
    words = bits.groupBy("block", "_word").agg(F.bit_or("_bit").alias("_bits"))
    held = F.map_from_entries(F.collect_list(F.struct("_word", "_bits")))  # at most 64 words
    # The map is the argument of a function, as Spark would build it again for each word.
    dense = F.transform(
        F.array(held),
        lambda found: F.transform(
            F.sequence(F.lit(0), F.lit(_WORDS - 1)),
            lambda word: F.coalesce(F.try_element_at(found, word), F.lit(0).cast("bigint")),
        ),
    )
    return words.groupBy("block").agg(F.get(dense, F.lit(0)).alias("words"))


def suspects(
    candidates: DataFrame, filters: DataFrame, keys: list[str], levels: list[int], rows: int
) -> DataFrame:
    """The candidates' (``rows`` of them) keys, with the ``load_id`` of each filter that may
    hold them.

    ``filters`` are those of all loads; ``levels`` those that occur. A key that is held is always
    found. A few candidates are sent to the filters; many meet them by block.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    entries = [
        F.struct(F.lit(level).alias("_level"), _block(keys, level).alias("_block"))
        for level in levels
    ]
    asked = candidates.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
        F.explode(F.array(*entries)).alias("_entry"),
    ).select(*names, "_entry.*")
    places = _places(_bits_hash(names))
    every_bit = reduce(
        lambda a, b: a & b,
        [F.get("words", word_of(p)).bitwiseAND(bit_of(p)) != 0 for p in places],
    )
    met = filters.join(
        sized(asked, rows * len(levels)),
        (F.col("level") == F.col("_level")) & (F.col("block") == F.col("_block")) & every_bit,
    )
    return met.select(
        "load_id", *[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)]
    )
