"""Incremental load by high-water mark.

State is append-only: each successful run adds a row, and the newest row per
(pipeline, endpoint) is the current mark.

On the driver a mark is a datetime in UTC, made from microseconds, so that neither the
driver's own time zone nor a change of clocks can move it.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions.columns import column

STATE_DDL = (
    "pipeline STRING COMMENT 'Pipeline that owns the mark', "
    "endpoint STRING COMMENT 'Dataset within the pipeline', "
    "last_run TIMESTAMP COMMENT 'Highest value loaded so far', "
    "updated_at TIMESTAMP COMMENT 'When the mark was set'"
)


def utc_datetime(micros: int | None) -> datetime | None:
    if micros is None:
        return None
    return datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=micros)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def current_marks(state: DataFrame) -> DataFrame:
    """The newest mark per (pipeline, endpoint)."""
    newest = F.max(F.struct("updated_at", "last_run"))
    return (
        state.groupBy("pipeline", "endpoint")
        .agg(newest.alias("newest"))
        .select("pipeline", "endpoint", F.col("newest.last_run").alias("last_run"))
    )


def last_mark(
    state: DataFrame, pipeline: str, endpoint: str, *, full_load: bool = False
) -> datetime | None:
    """The mark to continue from; None on a full load or a first run."""
    if full_load:
        return None
    mine = state.where((F.col("pipeline") == pipeline) & (F.col("endpoint") == endpoint))
    row = current_marks(mine).select(micros(F.col("last_run")).alias("mark")).first()
    return utc_datetime(row["mark"]) if row else None


def newer_than(
    df: DataFrame,
    field: str,
    mark: datetime | None,
    *,
    upto: datetime | None = None,
    overlap: timedelta = timedelta(0),
    date_partition: str | None = None,
) -> DataFrame:
    """Rows with ``field`` strictly after the mark (all rows without one) and not after ``upto``.

    ``overlap`` reads again a little before the mark, for rows that arrive late with an
    equal or older time; that is safe where the load is an upsert by key. The comparison
    is with a literal, so it reaches the Parquet reader. ``date_partition`` names a
    partition column that holds the date of ``field``: older partitions are not even listed.
    """
    if mark is not None:
        df = df.where(column(field) > F.lit(mark - overlap))
        if date_partition:
            df = df.where(column(date_partition) >= F.to_date(F.lit(mark - overlap)))
    if upto is not None:
        df = df.where(column(field) <= F.lit(upto))
        if date_partition:
            df = df.where(column(date_partition) <= F.to_date(F.lit(upto)))
    return df


def high_water_mark(df: DataFrame, field: str | Column) -> DataFrame:
    """One row with the largest value of ``field``; null over no rows."""
    source = column(field) if isinstance(field, str) else field
    return df.agg(F.max(source).alias("last_run"))


def highest(df: DataFrame, field: str | Column) -> datetime | None:
    """The value of ``high_water_mark`` on the driver."""
    row = high_water_mark(df, field).select(micros(F.col("last_run")).alias("mark")).first()
    return utc_datetime(row["mark"])


def advance_mark(
    state_table: str, pipeline: str, endpoint: str, mark: datetime | None, df: DataFrame
) -> bool:
    """Append the new mark; call it only after the load has been written.

    No mark (nothing loaded, or a dataset without an incremental field) changes nothing.
    ``df`` supplies the session.
    """
    if mark is None:
        return False
    row = df.sparkSession.range(1).select(
        F.lit(pipeline).alias("pipeline"),
        F.lit(endpoint).alias("endpoint"),
        F.lit(mark).cast("timestamp").alias("last_run"),
        F.current_timestamp().alias("updated_at"),
    )
    row.write.mode("append").format("parquet").saveAsTable(state_table)
    return True
