"""Intermediate results written once and read back.

A staged frame fixes what later steps see, cuts lineage and lets Spark plan on real file
sizes. It lives in the folder that ``spark.checkpoint.dir`` names, which every executor
can reach, so it outlives lost executors.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STAGE_SCHEMA = "refinery_stage"


# Folders of applications that name none, by application id.
_own_folders: dict[str, str] = {}


def one_process(master: str) -> bool:
    """Whether a master has no executors besides the driver."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset a new temporary folder, but only if the driver
    does all the work itself: other machines would not see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not one_process(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
        application = spark.sparkContext.applicationId
        if application not in _own_folders:
            _own_folders[application] = tempfile.mkdtemp(prefix="refinery-")
        folder = _own_folders[application]
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _stage_as(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/{STAGE_SCHEMA}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {STAGE_SCHEMA} LOCATION '{folder}'")
    df.write.format("parquet").saveAsTable(name)
    return spark.table(name)


def _new_name(label: str) -> str:
    return f"{STAGE_SCHEMA}.{label}_{uuid.uuid4().hex}"


_kept: set[str] = set()


def stage(df: DataFrame, label: str = "rows") -> DataFrame:
    """Write ``df`` to a new staging table and return that table.

    It stays for as long as frames may read it; ``clear_stage`` drops it.
    """
    name = _new_name(label)
    _kept.add(name)
    return _stage_as(df, name)


def clear_stage(spark: SparkSession) -> int:
    """Drop the tables that ``stage`` wrote in this program; returns their number."""
    dropped = len(_kept)
    while _kept:
        spark.sql(f"DROP TABLE IF EXISTS {_kept.pop()}")
    return dropped


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """``with staging(spark) as stage:`` drops whatever was staged inside, also on failure."""
    names: list[str] = []

    def tracked(df: DataFrame, label: str = "rows") -> DataFrame:
        names.append(_new_name(label))
        return _stage_as(df, names[-1])

    try:
        yield tracked
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
