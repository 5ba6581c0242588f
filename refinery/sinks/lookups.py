"""Lookup tables kept up to date by key, bucketed by it so that joins do not shuffle them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from refinery.functions.columns import column
from refinery.operators.skew import fits_broadcast
from refinery.operators.upsert import newest_per_key, replace_by_key, replace_few
from refinery.sinks.staging import staging
from refinery.sinks.tables import _schema_folder, delete_folder, table_exists, table_folder

BUCKETS = 64


def _write_bucketed(rows: DataFrame, table: str, key: str, buckets: int) -> None:
    """A new table of that name over new files: one file per bucket, sorted by the key."""
    spark, mark = rows.sparkSession, uuid.uuid4().hex
    fresh, former = f"{table}_next_{mark}", f"{table}_former_{mark}"
    folder = f"{_schema_folder(spark, table)}/{table.rsplit('.', 1)[-1]}-{mark}"
    writer = rows.repartition(buckets, column(key)).write.format("parquet").option("path", folder)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(fresh)
    replaced = table_exists(spark, table)
    if replaced:
        spark.sql(f"ALTER TABLE {table} RENAME TO {former}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    if replaced:
        spark.sql(f"DROP TABLE {former}")


def upsert_lookup(
    updates: DataFrame, table: str, key: str, version: str, *, buckets: int = BUCKETS, drop_previous: bool = False
) -> None:
    """Keyed upsert into a bucketed lookup table; the first call creates it.

    A key holds its newest row by ``version``; rows without a key look nothing up and are left
    out. The table is written anew, as a lookup is small beside what is looked up, and only if
    there are updates. Former files stay for their readers unless ``drop_previous``.
    """
    spark = updates.sparkSession
    newest = newest_per_key(updates.where(column(key).isNotNull()), [key], version)
    if not table_exists(spark, table):
        _write_bucketed(newest, table, key, buckets)
        return
    former = table_folder(spark, table)
    with staging(spark) as stage:
        fresh = stage(newest, "lookup")
        if fresh.isEmpty():
            return
        merge = replace_few if fits_broadcast(fresh) else replace_by_key
        _write_bucketed(merge(spark.table(table), fresh, [key], version), table, key, buckets)
    if drop_previous:
        delete_folder(spark, former)
