"""A ledger of landed files, so that a run opens new files only.

A file is known by path, size and modification time. The folder is listed by Spark without
opening a file, and the listing is anti-joined with the ledger before any content is read.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_DDL = (
    "pipeline STRING COMMENT 'Pipeline that landed the file', "
    "dataset STRING COMMENT 'Dataset within the pipeline', "
    "path STRING COMMENT 'The file', "
    "size BIGINT COMMENT 'Bytes when it was landed', "
    "modified TIMESTAMP COMMENT 'Modification time when it was landed', "
    "landed_at TIMESTAMP COMMENT 'When the load was written'"
)
FILE = ("path", "size", "modified")


def list_files(spark: SparkSession, path: str | list[str], modified_after: datetime | None = None) -> DataFrame:
    """``(path, size, modified)`` of the files below ``path``; no file is opened.

    ``modified_after`` leaves older files out while listing.
    """
    reader = spark.read.format("binaryFile")
    if modified_after is not None:
        utc = modified_after.astimezone(UTC).replace(tzinfo=None)
        reader = reader.option("modifiedAfter", utc.isoformat(timespec="seconds")).option("timeZone", "UTC")
    return reader.load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def landed_files(ledger: DataFrame, pipeline: str, dataset: str) -> DataFrame:
    return ledger.where((F.col("pipeline") == pipeline) & (F.col("dataset") == dataset)).select(*FILE).distinct()


def new_files(listing: DataFrame, landed: DataFrame) -> DataFrame:
    """Files that were not landed, or that have changed since."""
    return listing.join(landed, list(FILE), "left_anti")


def newest_landed(landed: DataFrame, overlap: timedelta) -> datetime | None:
    """The time before which no file is listed, if late files are at most ``overlap`` late."""
    row = landed.agg(F.unix_micros(F.max("modified")).alias("at")).first()
    if row["at"] is None:
        return None
    return datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=row["at"]) - overlap


def record(files: DataFrame, ledger_table: str, pipeline: str, dataset: str) -> None:
    """Enter files as landed; call it only after the load has been written."""
    files.select(
        F.lit(pipeline).alias("pipeline"), F.lit(dataset).alias("dataset"), *FILE, F.current_timestamp().alias("landed_at")
    ).write.insertInto(ledger_table)
