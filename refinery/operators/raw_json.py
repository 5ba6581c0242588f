"""From raw JSON text to columns and back."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions.columns import column

RAW = "raw_json"
CORRUPT = "_unparsed"


def infer_schema(df: DataFrame, raw: str = RAW) -> str | None:
    """DDL of the struct that fits every object in ``raw``; None when there is none.

    The types are merged by an aggregate on the executors over all rows, so a field that
    appears late is not missed and only the merged schema reaches the driver. Fields with
    conflicting types come back as VARIANT.
    """
    parsed = F.try_parse_json(column(raw))
    merged = (
        df.where(F.schema_of_variant(parsed).startswith("OBJECT<"))
        .agg(F.schema_of_variant_agg(parsed).alias("merged"))
        .first()["merged"]
    )
    if merged is None or not merged.startswith("OBJECT<"):
        return None
    return re.sub(r"\bOBJECT<", "STRUCT<", re.sub(r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE", merged))


def parse_raw(
    df: DataFrame,
    schema: str | T.StructType | None = None,
    raw: str = RAW,
    *,
    keep: tuple[str, ...] = ("ingestion_time",),
    unparsed: str | None = None,
) -> DataFrame:
    """The fields of the JSON object as columns, next to the ``keep`` columns.

    Give the schema, with just the fields that are needed, where it is known. Without one
    it is inferred from all rows. Text that is not a JSON object gives null fields;
    ``unparsed`` adds a column with that text. No rows give an empty frame.

    The text is parsed in a generator, which Spark evaluates once per row: a later filter on
    a field stays above it instead of parsing the text again for itself.
    """
    kept = [column(c) for c in keep]
    if schema is None:
        schema = infer_schema(df, raw)
        if schema is None:
            return df.select(*kept).where(F.lit(False))
    if isinstance(schema, T.StructType):
        struct = T.StructType(list(schema.fields))
    else:
        body = schema.removeprefix("STRUCT<").removesuffix(">") if schema.startswith("STRUCT<") else schema
        struct = T.StructType.fromDDL(body)
    options = {}
    if unparsed:
        struct = struct.add(T.StructField(CORRUPT, T.StringType()))
        options["columnNameOfCorruptRecord"] = CORRUPT
    names = [f"__f{i}" for i in range(len(struct))]
    parsed = F.inline(F.array(F.from_json(column(raw), struct, options))).alias(*names)
    shown = [unparsed if f == CORRUPT else f for f in struct.fieldNames()]
    fields = [F.col(n).alias(s) for n, s in zip(names, shown, strict=True)]
    return df.select(parsed, *kept).select(*fields, *kept)


def to_raw(df: DataFrame, ingested_at=None) -> DataFrame:
    """Each row as one JSON object plus its ingestion time; null fields stay in the text."""
    return df.select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(RAW),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingestion_time"),
    )
