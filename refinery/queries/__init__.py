"""Every operator as a query over the shared test tables, with the SQL that must agree.

A query is registered with ``@query(sql=...)``; its name is the function's name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from refinery.sinks.staging import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
MODULES = (
    "rules",
    "cleaning",
    "enrichment",
    "loading",
    "profiling",
    "validation",
    "reporting",
    "flows",
    "outcomes",
)
SCHEMA = "refinery_queries"


def query(sql: str | None = None):
    def register(build):
        if build.__name__ in QUERIES:
            raise ValueError(f"query {build.__name__} is registered twice")
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLE_SQL[build.__name__] = sql.strip()
        return build

    return register


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its schema is read from the files once per program."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def new_schema(spark: SparkSession, name: str = SCHEMA) -> str:
    """A schema whose tables lie below the shared folder."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{shared_folder(spark)}/{name}'")
    return name


def new_table(spark: SparkSession, label: str) -> str:
    """The name of a table nobody has used yet."""
    return f"{new_schema(spark)}.{label}_{uuid.uuid4().hex}"


def literal_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """What a run has found out, as rows of literals."""
    fields = StructType.fromDDL(ddl)
    each = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*each)))


def load_all() -> None:
    for module in MODULES:
        import_module(f"refinery.queries.{module}")
