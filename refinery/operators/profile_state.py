"""Profiles that merge: what a batch contributes is kept, the whole is never read again.

A state has a row per column with counts, extremes, mean, squared deviations and an HLL sketch of
the values. States of batches are merged by one small aggregate, in any order and grouping.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions.columns import column, known

STATE_DDL = (
    "batch STRING COMMENT 'Batch that was profiled', column STRING COMMENT 'Profiled column', "
    "rows BIGINT COMMENT 'Rows of the batch', nulls BIGINT COMMENT 'Rows without a value', "
    "low DOUBLE COMMENT 'Smallest number; seconds since 1970 of a time', high DOUBLE COMMENT 'Largest', "
    "mean DOUBLE COMMENT 'Mean', squares DOUBLE COMMENT 'Sum of squared deviations from the mean', "
    "sketch BINARY COMMENT 'HLL sketch of the values'"
)
_FIELDS = ("rows", "nulls", "low", "high", "mean", "squares", "sketch")


def _number(df: DataFrame, name: str) -> Column:
    kind = df.select(column(name)).schema[0].dataType.typeName()
    if kind == "date" or kind.startswith("timestamp"):
        return F.unix_micros(column(name).cast("timestamp")) / 1e6
    if kind in ("byte", "short", "integer", "long", "float", "double") or kind.startswith("decimal"):
        return column(name).cast("double")
    return F.lit(None).cast("double")


def _sketched(df: DataFrame, name: str) -> Column:
    """The value in a type that sketches take; equal values stay equal."""
    kind = df.select(column(name)).schema[0].dataType.typeName()
    return column(name) if kind in ("integer", "long", "string", "binary") else column(name).cast("string")


def profile_state(df: DataFrame, names: Sequence[str], batch: str, precision: int = 14) -> DataFrame:
    """The state of one batch: one scan, one row per column; see ``STATE_DDL``."""
    found = known(df, names, used_by="profile state", strict=True)
    total = F.count(F.lit(1))
    measures = []
    for i, name in enumerate(found):
        number = _number(df, name)
        values = (
            total, F.count_if(column(name).isNull()), F.min(number), F.max(number), F.avg(number),
            F.var_pop(number) * F.count(number), F.hll_sketch_agg(_sketched(df, name), precision),
        )
        measures += [v.alias(f"{f}_{i}") for f, v in zip(_FIELDS, values, strict=True)]
    wide = df.agg(*measures)
    rows = [F.struct(F.lit(n).alias("column"), *[F.col(f"{f}_{i}").alias(f) for f in _FIELDS]) for i, n in enumerate(found)]
    return wide.select(F.lit(batch).alias("batch"), F.inline(F.array(*rows)))


def merge_states(states: DataFrame, batch: str = "merged") -> DataFrame:
    """One state of all rows that the given ones describe."""
    n = F.col("rows") - F.col("nulls")
    merged = states.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.try_divide(F.sum(n * F.col("mean")), F.sum(F.when(F.col("mean").isNotNull(), n))).alias("mean"),
        F.sum("squares").alias("inside"), F.sum(n * F.col("mean") * F.col("mean")).alias("means"),
        F.sum(F.when(F.col("mean").isNotNull(), n)).alias("n"), F.hll_union_agg("sketch").alias("sketch"),
    )
    between = F.greatest(F.col("means") - F.col("n") * F.col("mean") * F.col("mean"), F.lit(0.0))
    return merged.select(
        F.lit(batch).alias("batch"), "column", "rows", "nulls", "low", "high", "mean",
        (F.col("inside") + between).alias("squares"), "sketch",
    )


def profile_of(states: DataFrame) -> DataFrame:
    """Null share, distinct count (of the sketch), extremes, mean and deviation per column."""
    n = F.col("rows") - F.col("nulls")
    return merge_states(states).select(
        "column", "rows", "nulls", F.try_divide("nulls", "rows").alias("null_pct"),
        F.hll_sketch_estimate("sketch").alias("distinct_count"), "low", "high", F.col("mean").alias("avg"),
        F.sqrt(F.try_divide(F.col("squares"), F.nullif(n - 1, F.lit(0)))).alias("stddev"),
    )
