"""Catalog tables: schemas, DDL, append, overwrite, staged replacement, views.

Plain Parquet tables have no transactions, so a table is replaced by writing a new
version beside the old one and pointing the catalog to it. Readers see either version,
never a mixture. One writer per table at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from refinery.functions.columns import column, known, quoted
from refinery.functions.types import as_type, merged_type, misfits, type_ddl
from refinery.operators.skew import fits_broadcast
from refinery.operators.upsert import in_common_types, newest_per_key, replace_by_key, replace_few
from refinery.sinks.staging import staging

LAYERS = ("bronze", "silver", "gold", "meta")
CONFLICTS = "_type_conflicts"


def schema_name(layer: str, env: str | None = None, project: str = "refinery") -> str:
    return f"{project}_{env}_{layer}" if env else f"{project}_{layer}"


def ensure_schemas(
    spark: SparkSession, env: str | None = None, project: str = "refinery", layers=LAYERS
) -> list[str]:
    """Create the schema of every layer that does not exist; returns their names."""
    names = [schema_name(layer, env, project) for layer in layers]
    for layer, name in zip(layers, names, strict=True):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name)} COMMENT 'Layer {layer}'")
    return names


def ensure_table(
    spark: SparkSession, table: str, ddl: str, comment: str = "", properties: Mapping | None = None
) -> None:
    """Create the table with typed, commented columns unless it exists."""
    extras = f" COMMENT {_text(comment)}" if comment else ""
    if properties:
        pairs = ", ".join(f"{_text(k)} = {_text(str(v))}" for k, v in properties.items())
        extras += f" TBLPROPERTIES ({pairs})"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet{extras}")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def append(
    df: DataFrame,
    table: str,
    *,
    rows_per_file: int | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """One distributed append; ``rows_per_file`` bounds the size of the files."""
    writer = df.write.format("parquet").mode("append").partitionBy(*partition_by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.saveAsTable(table)


def append_evolving(df: DataFrame, table: str) -> None:
    """Append by name; new columns and nested fields are added to the table, missing ones are null.

    Structs grow at any depth, inside arrays and maps too. Types that fit without loss are
    widened to the table's. What does not fit is not lost: the parts of the row in question go
    as JSON, in their places, into the text column ``_type_conflicts``; there they are null.

    A table that this function creates is a definition over a folder, so that added fields only
    change the definition: files without them read as null. One that another way of writing
    has created is rewritten once for that.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        replace_table(df, table)
        return
    held = spark.table(table).schema
    shape = merged_type(held, df.schema)
    lost = {f.name: misfits(column(f.name), f.dataType, shape[_name_in(shape, f.name)].dataType) for f in df.schema}
    lost = {name: part for name, part in lost.items() if part is not None}
    if lost:
        kept = F.to_json(F.struct(*[part.alias(name) for name, part in lost.items()]))
        df = df.withColumn("__conflicts", F.when(kept != "{}", kept))
        if CONFLICTS not in shape.names:
            shape = StructType([*shape, StructField(CONFLICTS, StringType())])
    nested = any(type_ddl(f.dataType) != type_ddl(shape[f.name].dataType) for f in held)
    added = [f for f in shape if f.name not in held.names]
    if nested:
        _redefine(spark, table, shape)
    elif added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns_ddl(added)})")
    given = {f.name.lower(): f for f in df.schema}
    values = []
    for f in spark.table(table).schema:
        own = given.get(f.name.lower())
        value = as_type(column(own.name), own.dataType, f.dataType) if own else F.lit(None).cast(f.dataType)
        values.append((F.col("__conflicts") if f.name == CONFLICTS and lost else value).alias(f.name))
    df.select(*values).write.insertInto(table)


def _name_in(shape: StructType, name: str) -> str:
    return next(f.name for f in shape if f.name.lower() == name.lower())


def _redefine(spark: SparkSession, table: str, shape: StructType) -> None:
    """Give ``table`` a schema that its own has grown into; its files stay as they are."""
    parts = partition_columns(spark, table)
    current = spark.table(table)
    facts = _description(spark, table)
    if facts.get("Type") != "EXTERNAL":
        held = {f.name: f.dataType for f in current.schema}
        grown = current.select(
            *[(as_type(column(f.name), held[f.name], f.dataType) if f.name in held else F.lit(None).cast(f.dataType)).alias(f.name) for f in shape]
        )
        replace_table(grown, table, facts.get("Comment", ""), partition_by=parts)
        return
    _swap_definition(spark, table, shape, facts["Location"], facts.get("Comment", ""), parts)


def _schema_folder(spark: SparkSession, table: str) -> str:
    """Where the schema of ``table`` keeps its tables; not where checkpoints are."""
    name = table.rsplit(".", 1)[0] if "." in table else spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(name).locationUri.rstrip("/")


def _write_version(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> str:
    folder = f"{_schema_folder(df.sparkSession, label)}/{label.rsplit('.', 1)[-1]}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(folder)
    return folder


def _shape(df: DataFrame) -> list:
    return [(f.name, f.dataType) for f in df.schema]


def _description(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog tells of a table: Type, Location, Comment, ..."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    names = [r["col_name"] for r in rows]
    begin = names.index("# Detailed Table Information") if "# Detailed Table Information" in names else 0
    return {r["col_name"]: r["data_type"] for r in rows[begin:]}


def table_folder(spark: SparkSession, table: str) -> str:
    """The folder below which the files of a table lie."""
    return _description(spark, table)["Location"]


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def replace_table(
    df: DataFrame,
    table: str,
    comment: str = "",
    *,
    partition_by: Sequence[str] = (),
    drop_previous: bool = False,
) -> str:
    """Full refresh: write a new version, then point the table to it. Returns its folder.

    ``df`` may read the table itself. The former files stay for readers still using them
    unless ``drop_previous``. A table whose columns change, or that is partitioned, is
    dropped and created over the new files.
    """
    spark = df.sparkSession
    former = table_folder(spark, table) if drop_previous and table_exists(spark, table) else None
    folder = _write_version(df, table, partition_by)
    _point_to(spark, table, folder, df, comment, partition_by)
    if former:
        delete_folder(spark, former)
    return folder


def _point_to(
    spark: SparkSession,
    table: str,
    folder: str,
    df: DataFrame,
    comment: str,
    partition_by: Sequence[str],
) -> None:
    if (
        not partition_by
        and table_exists(spark, table)
        and _shape(spark.table(table)) == _shape(df)
    ):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
        return
    _swap_definition(spark, table, df.schema, folder, comment, partition_by)


def _text(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _swap_definition(
    spark: SparkSession, table: str, shape: StructType, folder: str, comment: str, partition_by: Sequence[str]
) -> None:
    # The new table is complete under another name before the old one gives up its own, and
    # the old one is dropped last, so a crash never leaves less than one of them.
    mark = uuid.uuid4().hex
    fresh, former = f"{table}_next_{mark}", f"{table}_former_{mark}"
    last = [shape[c] for c in partition_by]
    fields = [f for f in shape if f.name not in partition_by] + last
    layout = f"PARTITIONED BY ({', '.join(map(quoted, partition_by))}) " if partition_by else ""
    note = f" COMMENT {_text(comment)}" if comment else ""
    spark.sql(f"CREATE TABLE {fresh} ({_columns_ddl(fields)}) USING parquet {layout}LOCATION {_text(folder)}{note}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {fresh}")
    replaced = table_exists(spark, table)
    if replaced:
        spark.sql(f"ALTER TABLE {table} RENAME TO {former}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    if replaced:
        spark.sql(f"DROP TABLE {former}")


def _columns_ddl(fields) -> str:
    return ", ".join(f"{quoted(f.name)} {type_ddl(f.dataType)}" for f in fields)


def delete_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a retired version through Spark's own file system client."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def publish_table(df: DataFrame, table: str, comment: str = "") -> DataFrame:
    """Create or replace a table from a query and return it."""
    replace_table(df, table, comment)
    return df.sparkSession.table(table)


def publish_view(df: DataFrame, fields: Sequence[str], view: str) -> DataFrame:
    """Session view over a column list."""
    names = known(df, fields, used_by=f"view {view}", strict=True)
    df.select(*[column(n) for n in names]).createOrReplaceTempView(view)
    return df.sparkSession.table(view)


def publish_table_view(spark: SparkSession, table: str, fields: Sequence[str], view: str) -> DataFrame:
    """Catalog view over a column list of a table."""
    names = known(spark.table(table), fields, used_by=f"view {view}", strict=True)
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(map(quoted, names))} FROM {table}"
    )
    return spark.table(view)


# --- upsert ----------------------------------------------------------------------------

BUCKET = "_bucket"


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with a plain column to partition a table by that has no other: a hash of the key.

    The text form of the key makes 5 and 5L the same. Upsert such a table by the key and the
    bucket together, which says that a key never changes its partition.
    """
    place = F.pmod(F.xxhash64(*[column(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")
    return df.withColumn(BUCKET, place)


def upsert_table(
    updates: DataFrame,
    table: str,
    keys: Sequence[str],
    version: str | None = None,
    *,
    partition_by: Sequence[str] = (),
    drop_previous: bool = False,
) -> None:
    """Upsert into a table; the first call creates it.

    A plain table is rewritten as a whole into a new version; ``drop_previous`` deletes the
    files of the former one, on which readers may still be. Of a table that was created with
    ``partition_by`` only the partitions are read and overwritten, by Spark's dynamic partition
    overwrite, that an update falls into or that hold a row to be replaced; for the latter the
    keys of the table are read, unless the partition columns are part of the key. After a crash
    half-way the same upsert is simply run again.

    New columns are added. A type that does not hold the values of an update is widened, for
    which a partitioned table is rewritten as a whole once.
    """
    spark, keys = updates.sparkSession, list(keys)
    newest = newest_per_key(updates, keys, version)
    if not table_exists(spark, table):
        placed = newest.hint("rebalance", *partition_by) if partition_by else newest
        replace_table(placed, table, partition_by=partition_by)
        return
    parts = partition_columns(spark, table)
    # The updates are used several times below, so they are computed once.
    with staging(spark) as stage:
        fresh = stage(newest, "updates")
        target = spark.table(table)
        merge = replace_few if fits_broadcast(fresh) else replace_by_key
        if parts and in_common_types(target, fresh)[0].schema == target.schema:
            _overwrite_partitions(target, fresh, table, keys, version, parts, merge)
        else:
            merged = merge(target, fresh, keys, version)
            replace_table(merged, table, partition_by=parts, drop_previous=drop_previous)


def _in_partitions(parts: Sequence[str], rows: Sequence[Row]) -> Column:
    """Whether a row lies in one of the partitions; literals, so that others are not listed."""
    if len(parts) == 1:
        values = [r[0] for r in rows if r[0] is not None]
        found = column(parts[0]).isin(values) if values else F.lit(False)
        return found | column(parts[0]).isNull() if len(values) < len(rows) else found
    each = [reduce(and_, [column(p).eqNullSafe(F.lit(v)) for p, v in zip(parts, r, strict=True)]) for r in rows]
    return reduce(or_, each, F.lit(False))


def _overwrite_partitions(
    target: DataFrame, fresh: DataFrame, table: str, keys: list[str], version: str | None, parts: list[str], merge: Callable
) -> None:
    spark = target.sparkSession
    held = {c.lower() for c in target.columns}
    added = [f for f in fresh.schema if f.name.lower() not in held]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns_ddl(added)})")
        target = spark.table(table)
    # One row per partition at most, so these lists are bounded by the table's layout.
    reached = fresh.select(*[column(p) for p in parts]).distinct().collect()
    left = []
    if not {p.lower() for p in parts} <= {k.lower() for k in keys}:
        left = _partitions_of_keys(target, fresh, keys, parts)
    affected = {tuple(r): r for r in [*reached, *left]}
    if not affected:
        return
    merged = merge(target.where(_in_partitions(parts, list(affected.values()))), fresh, keys, version)
    merged = merged.select(*[column(c) for c in target.columns])
    # A partition that all rows have left has nothing to overwrite it with.
    gone = {tuple(r): r for r in left if tuple(r) not in {tuple(x) for x in reached}}
    if gone:
        stay = merged.where(_in_partitions(parts, list(gone.values()))).select(*[column(p) for p in parts]).distinct().collect()
        gone = {k: r for k, r in gone.items() if k not in {tuple(x) for x in stay}}
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        merged.hint("rebalance", *parts).write.mode("overwrite").insertInto(table)
    for row in gone.values():
        spec = ", ".join(f"{quoted(p)} = {'null' if v is None else _text(str(v))}" for p, v in zip(parts, row, strict=True))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions of ``table`` that rows of ``df`` fall into; the others stay as they are."""
    spark = df.sparkSession
    columns = [column(c) for c in spark.table(table).columns]
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.select(*columns).write.mode("overwrite").insertInto(table)


def _partitions_of_keys(target: DataFrame, fresh: DataFrame, keys: list[str], parts: list[str]) -> list[Row]:
    """Partitions that hold a row of an updated key."""
    names = [f"__key_{i}" for i in range(len(keys))]
    wanted = fresh.select(*[column(k).alias(n) for k, n in zip(keys, names, strict=True)])
    if fits_broadcast(wanted):
        wanted = F.broadcast(wanted)
    same = reduce(and_, [column(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)])
    return target.join(wanted, same, "left_semi").select(*[column(p) for p in parts]).distinct().collect()


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def keyed_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of an upserted table without the bucket column, other sessions' upserts included."""
    spark.catalog.refreshTable(table)  # a session remembers the files that it has listed
    return spark.table(table).drop(BUCKET)
