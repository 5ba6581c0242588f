"""Bounded filters: which rows may have a key of a set, told by a bitmap of hashes.

What is broadcast is never larger than the bitmap, whatever the number of keys. More keys only
make more rows possible that are not, never the other way round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions.columns import column

BITS = 1 << 23


def _place(values: Sequence[Column], bits: int) -> tuple[Column, Column]:
    """The word of a bitmap of 32-bit words, and the bit in it."""
    place = F.pmod(F.xxhash64(*values), F.lit(bits)).cast("int")
    return F.shiftright(place, 5), place.bitwiseAND(F.lit(31))


def _one_at(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def _is_set(held: Column, bit: Column) -> Column:
    return F.coalesce(F.call_function("shiftright", held, bit).bitwiseAND(F.lit(1)) == 1, F.lit(False))


def with_level(
    df: DataFrame, values: Sequence[Column], wanted: DataFrame, keys: Sequence[Column], level: Column, name: str, bits: int = BITS
) -> DataFrame:
    """``df`` with ``name``: 0 where ``values`` are no key of ``wanted``, else its ``level`` (1 or 2).

    By chance a level may be higher, but it is the same for equal values in every frame.
    """
    word, bit = _place(keys, bits)
    bitmap = wanted.groupBy(word.alias("__word")).agg(
        F.bit_or(_one_at(bit)).alias("__one"),
        F.bit_or(F.when(level >= 2, _one_at(bit)).otherwise(F.lit(0).cast("long"))).alias("__two"),
    )
    word, bit = _place(values, bits)
    met = df.join(F.broadcast(bitmap), word == F.col("__word"), "left")
    found = F.when(_is_set(F.col("__two"), bit), F.lit(2)).when(_is_set(F.col("__one"), bit), F.lit(1)).otherwise(F.lit(0))
    return met.withColumn(name, found).drop("__word", "__one", "__two")


def possible_rows(df: DataFrame, columns: Sequence[str], wanted: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """Rows of ``df`` whose ``columns`` may be one of the ``keys`` of ``wanted``; nulls are equal."""
    leveled = with_level(df, [column(c) for c in columns], wanted, [column(k) for k in keys], F.lit(1), "__level", bits)
    return leveled.where("__level > 0").drop("__level")
