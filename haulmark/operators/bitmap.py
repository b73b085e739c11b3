"""Exact sets of numbers as rows of blocks of 4,096 bits, for dense numbers such as positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.operators import keyed
from haulmark.operators.bloom import BLOCK_BITS, bit_of, dense_blocks, word_of

SCHEMA = {"block": "bigint", "words": "array<bigint>"}


def built(rows: DataFrame, number: str) -> DataFrame:
    """The set of a column's numbers, none of them negative: ``block``, ``words``.

    Bits that fall into one word are joined where they are read, so few words are shuffled.
    """
    place = F.col(number).bitwiseAND(F.lit(BLOCK_BITS - 1))
    bits = rows.select(
        _block(number).alias("block"), word_of(place).alias("_word"), bit_of(place).alias("_bit")
    )
    return dense_blocks(bits)


def _block(number: str) -> Column:
    return F.shiftright(number, (BLOCK_BITS - 1).bit_length())


def fits(blocks: int) -> bool:
    """Whether every task may get so many blocks; a row has some 50 bytes besides its bits."""
    return blocks * (BLOCK_BITS // 8 + 50) <= keyed.BROADCAST_BYTES


def held(rows: DataFrame, bitmap: DataFrame, number: str) -> DataFrame:
    """Rows whose number is in the set, which every task gets; see :func:`fits`."""
    place = F.col(number).bitwiseAND(F.lit(BLOCK_BITS - 1))
    found = F.get("words", word_of(place)).bitwiseAND(bit_of(place)) != 0
    met = rows.join(F.broadcast(bitmap), (_block(number) == F.col("block")) & found)
    return met.select(*rows.columns)
