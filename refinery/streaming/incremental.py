"""Incremental bronze and silver loads driven by a streaming checkpoint.

The same result as the high-water-mark loads: the checkpoint remembers which files were
processed, so late files are never missed and no mark has to be chosen.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.operators.raw_json import RAW
from refinery.sinks.tables import upsert_table
from refinery.sources.files import page_records

RAW_SCHEMA = T.StructType(
    [T.StructField(RAW, T.StringType()), T.StructField("ingestion_time", T.TimestampType())]
)


def land_new_pages(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    record_paths: Sequence[str],
    *,
    files_per_batch: int = 10_000,
) -> None:
    """Page files that have not been seen before -> raw records in the ``bronze`` folder."""
    pages = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
    )
    records = page_records(pages, record_paths).withColumn(
        "ingestion_time", F.current_timestamp()
    )
    (
        records.writeStream.format("parquet")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def upsert_new_rows(
    spark: SparkSession,
    bronze: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    table: str,
    keys: Sequence[str],
    version: str | None = None,
    *,
    partition_by: Sequence[str] = (),
    files_per_batch: int = 10_000,
) -> None:
    """Bronze files that have not been seen before -> ``transform`` -> keyed upsert.

    A batch that is repeated after a crash changes nothing, because the upsert is keyed.
    """

    def load(batch: DataFrame, _batch_id: int) -> None:
        upsert_table(transform(batch), table, keys, version, partition_by=partition_by)

    (
        spark.readStream.schema(RAW_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(bronze)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
