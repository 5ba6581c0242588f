"""Lookup joins that survive hot keys.

The right side of a lookup is unique on its key, so output size is never the problem;
the problem is that all left rows of one key (or of the null key) land in one task.
``lookup_join`` broadcasts the right side only after measuring it, and otherwise
spreads the heaviest left keys over several tasks.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions.columns import column
from refinery.operators.membership import with_level

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
#: Bits of the bitmap of hot keys.
HOT_BITS = 1 << 20


def _width(name: str, kind: T.DataType) -> Column:
    """Bytes of one value: measured where it varies, else the width of the type."""
    value = column(name)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit(8) + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.lit(8) + F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
    return F.lit(16 if isinstance(kind, T.DecimalType) else 8)


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure ``df``: True when it holds at most ``max_rows`` rows and ``max_bytes`` bytes.

    Rows and bytes are added up where the rows are; only the two sums travel.
    """
    width = reduce(add, [_width(f.name, f.dataType) for f in df.schema])
    size = df.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def _as_list(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _same(left: Sequence[str], right: Sequence[str], null_safe: bool) -> Column:
    pairs = [(column(a), column(b)) for a, b in zip(left, right, strict=True)]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _with_private_keys(right: DataFrame, keys: list[str], left: DataFrame) -> DataFrame:
    """``right`` with its keys renamed, so that no name occurs on both sides."""
    values = [c for c in right.columns if c not in keys]
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"lookup columns already exist on the left side: {sorted(clash)}")
    return right.select(
        *[column(k).alias(f"__key_{k}") for k in keys], *[column(v) for v in values]
    )


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    *,
    null_safe: bool = False,
    hot_rows: int = 100_000,
    copies: int = 64,
) -> DataFrame:
    """Join ``left`` to the key-unique ``right`` with the hot keys of ``left`` salted.

    Keys with at least ``hot_rows`` rows are split into ``copies`` salted groups, those with
    ``copies`` times as many into the square of that, and only their right rows are repeated.
    However many hot keys there are, all that is broadcast is a bitmap of their hashes. Null keys
    count as a key too: in an outer or anti join they would otherwise all meet in one task.
    """
    keys = _as_list(on)
    counted = left.groupBy(*[column(k).alias(f"__hot_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("__rows"))
    hot = counted.where(F.col("__rows") >= hot_rows)
    level = F.when(F.col("__rows") >= hot_rows * copies, F.lit(2)).otherwise(F.lit(1))
    hot_keys = [column(f"__hot_{k}") for k in keys]

    def salted(df: DataFrame, values: Sequence[Column], many: Column, more: Column, few: Column, name: str) -> DataFrame:
        marked = with_level(df, values, hot, hot_keys, level, "__level", HOT_BITS)
        return marked.withColumn(name, F.when(F.col("__level") == 2, more).when(F.col("__level") == 1, many).otherwise(few)).drop("__level")

    # The salt depends only on the row and its input split, so a retried task repeats it;
    # the split number separates rows that are full copies of each other.
    hashable = [column(f.name) for f in left.schema if not re.search("map<|variant", f.dataType.simpleString())]
    hashed = F.xxhash64(*hashable, F.spark_partition_id())
    groups = lambda n: F.pmod(hashed, F.lit(n)).cast("int")
    dealt = salted(left, [column(k) for k in keys], groups(copies), groups(copies * copies), F.lit(0), "__salt")
    private = [f"__key_{k}" for k in keys]
    # Equal values are marked alike only if they have one type.
    kinds = [left.select(column(k)).schema[0].dataType for k in keys]
    values = [column(p).try_cast(kind) for p, kind in zip(private, kinds, strict=True)]
    places = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    repeated = salted(
        _with_private_keys(right, keys, left), values, places(copies), places(copies * copies), F.array(F.lit(0)), "__right_salt"
    ).withColumn("__right_salt", F.explode("__right_salt"))
    matched = dealt.join(
        repeated,
        _same(keys, private, null_safe) & (F.col("__salt") == F.col("__right_salt")),
        how,
    )
    return matched.drop("__salt", "__right_salt", *private)


def broadcast_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str, *, null_safe: bool = False
) -> DataFrame:
    keys = _as_list(on)
    private = [f"__key_{k}" for k in keys]
    small = F.broadcast(_with_private_keys(right, keys, left))
    return left.join(small, _same(keys, private, null_safe), how).drop(*private)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    *,
    null_safe: bool = False,
    bound: DataFrame | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    **spread,
) -> DataFrame:
    """Join to a key-unique right side: broadcast when it measures small, else spread.

    ``how`` is any of left, inner, left_semi, left_anti. Measuring runs one aggregate.
    ``bound`` is a frame that ``right`` is a part of and that is cheaper to measure, such
    as the table it was deduplicated from; ``right`` is measured only if that is too large.
    """
    frames = [right] if bound is None else [bound, right]
    if any(fits_broadcast(f, max_rows, max_bytes) for f in frames):
        return broadcast_join(left, right, on, how, null_safe=null_safe)
    return spread_join(left, right, on, how, null_safe=null_safe, **spread)
