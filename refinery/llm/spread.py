"""Joins and running sums that no hot key can pull into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import column_named, partitions, stored, unused_name

#: Rows of one key from which on a join deals them out over several tasks.
HOT_ROWS = 10_000
SLICES = 64
_BITS = 1 << 20


def marked(df: DataFrame, wanted: DataFrame, columns: Sequence[str], name: str, bits: int = _BITS) -> DataFrame:
    """``df`` with a boolean ``name``: true wherever ``columns`` have values that occur in
    ``wanted``, and by chance elsewhere, but alike for equal values in any frame.

    What is broadcast is a bitmap of hashes, at most ``bits`` / 32 rows whatever the input.
    """
    place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(bits)).cast("int")
    word, bit = F.shiftright(place, 5), place.bitwiseAND(F.lit(31))
    key, held = unused_name(df, "bitmap_word"), unused_name(df, "bitmap_held")
    bitmap = wanted.groupBy(word.alias(key)).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias(held)
    )
    found = df.join(F.broadcast(bitmap), word == F.col(key), "left")
    is_set = F.call_function("shiftright", F.col(held), bit).bitwiseAND(F.lit(1)) == 1
    return found.withColumn(name, F.coalesce(is_set, F.lit(False))).drop(key, held)


def repeated_keys(df: DataFrame, columns: Sequence[str], rows: int = HOT_ROWS) -> DataFrame:
    """The values of ``columns`` that more than ``rows`` rows have; counted before the shuffle."""
    counted = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("__rows"))
    return counted.where(F.col("__rows") > rows).drop("__rows")


def spread_lookup(
    left: DataFrame, right: DataFrame, on: Sequence[str], hot: DataFrame, how: str = "left", slices: int = SLICES
) -> DataFrame:
    """``left`` joined to ``right``, which holds each key once; the keys in ``hot`` are dealt out.

    Keys that the bitmap of ``hot`` marks have their left rows dealt to ``slices`` groups and
    their one right row repeated for each. ``hot`` may have any number of keys.
    """
    flag, part = "__hot", "__slice"
    dealt = F.pmod(F.xxhash64(*[column_named(left, c) for c in left.columns], F.spark_partition_id()), F.lit(slices)).cast("int")
    one = marked(left, hot, on, flag).withColumn(part, F.when(F.col(flag), dealt).otherwise(F.lit(0))).drop(flag)
    places = F.when(F.col(flag), F.sequence(F.lit(0), F.lit(slices - 1))).otherwise(F.array(F.lit(0)))
    two = marked(right, hot, on, flag).withColumn(part, F.explode(places)).drop(flag)
    return one.join(two, [*on, part], how).drop(part)


def arranged(df: DataFrame, key: str, order: Sequence[Column], label: str) -> DataFrame:
    """``df`` stored with a column ``part``: ranges of (key, order), so that a hot key has many."""
    by = [F.col(key), *order]
    ranged = df.repartitionByRange(partitions(df.sparkSession), *by)
    return stored(ranged.withColumn("part", F.spark_partition_id()), label)


def running_sums(df: DataFrame, key: str, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """``df``, an ``arranged`` frame, with sums over the rows of a key up to and with each row.

    Inside a range the sums are a window's. What earlier ranges bring is added up over one row
    per range: at most one key continues from a range to the next, so that list, which is
    broadcast, never has more than two rows per range.
    """
    upto = Window.partitionBy(key, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    over = df.groupBy(key).agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select(key)
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.join(F.broadcast(over), key).groupBy(key, "part").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    carried = totals.select(
        F.col(key).alias("__key"), F.col("part").alias("__part"), *[F.sum(n).over(earlier).alias(f"__{n}") for n in sums]
    )
    inside = df.withColumns({n: F.sum(c).over(upto) for n, c in sums.items()})
    met = inside.join(F.broadcast(carried), (F.col(key) == F.col("__key")) & (F.col("part") == F.col("__part")), "left")
    added = met.withColumns({n: F.col(n) + F.coalesce(F.col(f"__{n}"), F.lit(0)) for n in sums})
    return added.drop("__key", "__part", *[f"__{n}" for n in sums])
