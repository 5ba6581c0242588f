"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions.columns import column, known


def _orderable(df: DataFrame, name: str) -> bool:
    return not isinstance(df.schema[name].dataType, (T.MapType, T.VariantType))


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest_by: str | Sequence[str],
    tie_break: Sequence[str] | None = None,
    oldest_by: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the newest, nulls last.

    Rows equal in time are separated by ``tie_break`` (highest value wins), then by
    ``oldest_by`` (lowest wins). By default ``tie_break`` is every other column, so the
    survivor never depends on partitioning or retries. Spark applies the limit before the
    shuffle as well (WindowGroupLimit), so a key that holds a large part of the table
    sends at most one row per input task.
    """
    order = [newest_by] if isinstance(newest_by, str) else list(newest_by)
    if tie_break is None:
        used = {*keys, *order, *oldest_by}
        tie_break = [c for c in sorted(df.columns) if c not in used and _orderable(df, c)]
    window = Window.partitionBy(*[column(k) for k in keys]).orderBy(
        *[column(c).desc_nulls_last() for c in [*order, *tie_break]],
        *[column(c).asc_nulls_last() for c in oldest_by],
    )
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    timestamp: str | None,
    tie_break: Sequence[str] | None = None,
    oldest_by: Sequence[str] = (),
) -> DataFrame:
    """``latest_per_key`` for configured names; a no-op without keys or timestamp.

    A timestamp column held as text is parsed first; text that does not parse sorts last.
    """
    if not keys or not timestamp:
        return df
    names = known(df, [timestamp], used_by="latest_version")
    if not names:
        return df
    actual_keys = known(df, keys, used_by="latest_version", strict=True)
    if isinstance(df.schema[names[0]].dataType, T.StringType):
        df = df.withColumn(names[0], F.try_to_timestamp(column(names[0])))
    return latest_per_key(df, actual_keys, names[0], tie_break, oldest_by)


def drop_exact_copies(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row per distinct combination of the columns outside ``exclude``.

    Nulls compare equal to nulls only. Of several copies the one with the smallest
    excluded values (for lineage columns: the first ingested) is kept.
    """
    ignored = known(df, exclude, used_by="drop_exact_copies")
    compared = [c for c in df.columns if c not in ignored]
    if not compared:
        raise ValueError("drop_exact_copies: every column is excluded")
    if not ignored:
        return df.dropDuplicates()
    groups = df.groupBy(*[column(c) for c in compared])
    if len(ignored) == 1:
        # A single value can be kept in a hash aggregate; a struct needs a sorted one.
        kept = groups.agg(F.min(column(ignored[0])).alias(ignored[0]))
        return kept.select(*[column(c) for c in df.columns])
    survivors = groups.agg(F.min(F.struct(*[column(c) for c in ignored])).alias("__kept"))
    return survivors.select(
        *[F.col("__kept")[c].alias(c) if c in ignored else column(c) for c in df.columns]
    )
