"""Scans of tables, CSV files and landed page files."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions.columns import column
from refinery.operators.raw_json import RAW, to_raw


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType | None = None,
    **options,
) -> DataFrame:
    """CSV with a header. Inferring the types reads the files twice; give a schema at scale."""
    reader = spark.read.options(header=True, **options)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def clean_headers(df: DataFrame) -> DataFrame:
    """Spaces in column names become underscores."""
    names = [c.replace(" ", "_") for c in df.columns]
    repeated = {n for n in names if names.count(n) > 1}
    if repeated:
        raise ValueError(f"headers collide after cleaning: {sorted(repeated)}")
    return df.toDF(*names)


def with_lineage(df: DataFrame, env: str, source_file: Column | None = None) -> DataFrame:
    """Ingestion time, source file and environment of each row."""
    return df.withColumns(
        {
            "_ingest_ts": F.current_timestamp(),
            "_source_file": F.col("_metadata.file_path") if source_file is None else source_file,
            "_env": F.lit(env),
        }
    )


def csv_to_bronze(
    spark: SparkSession, path: str | list[str], env: str, schema=None, **options
) -> DataFrame:
    """CSV rows with clean headers and lineage, ready to append."""
    raw = scan_csv(spark, path, schema, **options)
    with_path = raw.select("*", F.col("_metadata.file_path").alias("_source_file"))
    return clean_headers(with_path).withColumns(
        {"_ingest_ts": F.current_timestamp(), "_env": F.lit(env)}
    )


def csv_to_raw(spark: SparkSession, path: str | list[str], schema=None, **options) -> DataFrame:
    """CSV rows as raw JSON records: timestamps in ISO form, empty cells as JSON null."""
    return to_raw(scan_csv(spark, path, schema, **options))


#: Numbers that a copied text and a variant may write in two ways: fractions, exponents, many digits.
_OTHER_NUMBERS = r"(?:\"\s*:|[\[,])\s*-?\d+(?:[.eE]|\d{17})"


def _record_texts(parsed: DataFrame, paths: Sequence[str]) -> tuple[DataFrame, Column]:
    """The texts of the records that a page (``__text`` and its variant ``__page``) holds at the first
    path with a list, null without one; as a column of the frame that is returned with it.

    A variant is slow to write as text. So where all records are objects, which is seen in the
    variant, their texts are copied from the page, with its order of fields.
    """
    plain = {i: found[1] for i, p in enumerate(paths) if (found := re.fullmatch(r"\$(?:\.(\w+))?", p))}
    # Both are used twice, so they are columns of their own.
    parts = {}
    for i, name in plain.items():
        copied = F.from_json("__text", f"`{name}` array<string>")[name] if name else F.from_json("__text", "array<string>")
        parts |= {f"__copied_{i}": copied, f"__objects_{i}": F.try_variant_get("__page", paths[i], "array<struct<>>")}
    texts = []
    for i, path in enumerate(paths):
        text = F.transform(F.try_variant_get("__page", path, "array<variant>"), lambda record: F.to_json(record))
        if i in plain:
            copied, objects = F.col(f"__copied_{i}"), F.col(f"__objects_{i}")
            same = F.forall(objects, lambda record: record.isNotNull()) & (F.size(copied) == F.size(objects))
            text = F.when(same & ~F.col("__text").rlike(_OTHER_NUMBERS), copied).otherwise(text)
        texts.append(text)
    return parsed.withColumns(parts), F.coalesce(*texts)


def _text_at(path: str) -> Callable[[Column], Column]:
    return lambda record: F.try_variant_get(record, path, "string")


def page_records(
    pages: DataFrame,
    record_paths: Sequence[str],
    text: str = "value",
    fields: Mapping[str, str] | None = None,
) -> DataFrame:
    """The records wrapped in page envelopes, one JSON text per row.

    A page is parsed into a variant, so every field of a record survives, known or
    not. A page without records, or one that is not JSON, yields no rows. ``fields`` (column
    name -> JSON path) takes single fields along as text, without parsing a record again.
    """
    parsed = pages.select(column(text).alias("__text"), F.try_parse_json(column(text)).alias("__page"))
    found, texts = _record_texts(parsed, record_paths)
    # Of a column Spark would infer a filter below, which evaluates all of this once more.
    if not fields:
        return found.select(F.explode(texts).alias(RAW))
    records = F.coalesce(*[F.try_variant_get("__page", p, "array<variant>") for p in record_paths])
    taken = [F.transform(records, _text_at(path)) for path in fields.values()]
    return found.select(F.inline(F.arrays_zip(texts, *taken)).alias(RAW, *fields))


def scan_pages(
    spark: SparkSession,
    path: str | list[str],
    record_paths: Sequence[str],
    *,
    page_per_line: bool = False,
    fields: Mapping[str, str] | None = None,
) -> DataFrame:
    """Records of landed page files: one page per file, or one per line."""
    pages = spark.read.text(path, wholetext=not page_per_line)
    return page_records(pages, record_paths, fields=fields)


def variant_text(record: Column, path: str) -> Column:
    """A field of a raw JSON record as text; null where it is absent."""
    return F.try_variant_get(F.try_parse_json(record), path, "string")
