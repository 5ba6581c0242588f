"""Structural cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from refinery.operators.clean import (
    cast_columns,
    columns_to_boolean,
    columns_to_utc,
    require,
    split_metadata,
    standardise_text,
    structural_clean as clean_structure,
    within_ranges,
)
from refinery.operators.dedup import drop_exact_copies, latest_per_key, latest_version
from refinery.queries import query, table


@query("""
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       TRY_CAST(event_type AS INTEGER) AS event_type, CAST(user_id AS VARCHAR) AS user_id
FROM events
""")
def enforce_schema(spark, folder):
    """Text that is a number is cast, text that is not becomes null."""
    events = table(spark, folder, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), "event_type", "user_id"
    )
    return cast_columns(events, {"K": "int", "event_type": "int", "user_id": "string"})


@query("""
SELECT p_partkey, upper(trim('  ' || p_name || ' ')) AS p_name, lower(p_brand) AS p_brand,
       upper(lower(p_type)) AS p_type
FROM part
""")
def standardize_strings(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"),
        "p_brand",
        "p_type",
    )
    return standardise_text(
        part, trim=["p_name"], lower=["p_brand", "p_type"], upper=["P_NAME", "p_type"]
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, NULLIF(l_tax, 0) AS l_tax, NULLIF(l_discount, 0) AS l_discount
FROM lineitem WHERE NULLIF(l_tax, 0) IS NOT NULL AND NULLIF(l_discount, 0) IS NOT NULL
""")
def drop_nulls(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
    )
    return require(rows, ["l_tax", "L_DISCOUNT"])


@query("""
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0
""")
def range_filter_open_bound(spark, folder):
    """A null upper bound is open; it does not drop every row."""
    rows = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return within_ranges(rows, {"C_ACCTBAL": [0, None]})


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_quantity BETWEEN 10 AND 20 AND l_discount <= 0.05
""")
def range_filter(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount"
    )
    return within_ranges(rows, {"l_quantity": [10, 20], "l_discount": [None, 0.05]})


@query("""
SELECT text, lang, MIN(doc_id) AS doc_id FROM documents GROUP BY text, lang
""")
def dedup_exact(spark, folder):
    """Whole texts; of equal rows the one with the smallest excluded value stays."""
    rows = table(spark, folder, "documents").select("text", "lang", "doc_id")
    return drop_exact_copies(rows, exclude=["doc_id"])


@query("""
SELECT NULLIF(l_returnflag, 'N') AS l_returnflag, NULLIF(l_linestatus, 'O') AS l_linestatus
FROM lineitem GROUP BY ALL
""")
def dedup_exact_nulls(spark, folder):
    """Nulls compare equal to nulls."""
    rows = table(spark, folder, "lineitem").select(
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
        F.nullif("l_linestatus", F.lit("O")).alias("l_linestatus"),
    )
    return drop_exact_copies(rows)


LATEST_LINES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM (
  SELECT *, ROW_NUMBER() OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC,
                    l_extendedprice DESC) AS rn
  FROM lineitem) WHERE rn = 1
"""


@query(LATEST_LINES)
def dedup_latest(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    return latest_per_key(
        rows,
        ["l_orderkey", "l_linenumber"],
        "l_shipdate",
        ["l_partkey", "l_suppkey", "l_extendedprice"],
    )


@query("""
SELECT user_id, CAST(ts AS TIMESTAMP) AS ts, event_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
""")
def dedup_latest_text_time(spark, folder):
    """The timestamp arrives as text and is parsed for the comparison."""
    rows = table(spark, folder, "events").select(
        "user_id", F.col("ts").cast("string").alias("ts"), "event_id"
    )
    latest = latest_version(rows, ["user_id"], "ts")
    return latest.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""
SELECT o_orderkey, o_orderdate - INTERVAL 5 HOUR - INTERVAL 30 MINUTE AS o_orderdate FROM orders
""")
def normalize_ts_utc(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    utc = columns_to_utc(rows, ["o_orderdate"], "Asia/Kolkata")
    return utc.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("""
SELECT doc_id, quality = 1 AS quality, CASE toxic WHEN 1 THEN TRUE END AS toxic FROM labels
""")
def normalize_bool(spark, folder):
    """Mapped on trimmed lower-case text; a value outside the map is null."""
    rows = table(spark, folder, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, " YES ").otherwise("No").alias("quality"),
        "toxic",
    )
    return columns_to_boolean(rows, {"quality": {"yes": True, "no": False}, "toxic": {1: True}})


@query("SELECT event_id, event_type, value FROM events")
def metadata_split(spark, folder):
    """The data side of the split."""
    data, _ = split_metadata(table(spark, folder, "events"), ["ts", "user_id", "PROPS"])
    return data


@query("SELECT ts, user_id, props FROM events")
def metadata_split_metadata(spark, folder):
    """The metadata side of the split."""
    _, metadata = split_metadata(table(spark, folder, "events"), ["ts", "user_id", "PROPS"])
    return metadata


@query("""
WITH typed AS (
  SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS l_partkey, l_suppkey, l_extendedprice,
         NULLIF(l_tax, 0) AS l_tax, l_shipdate, lower(l_returnflag) AS l_returnflag,
         l_linestatus
  FROM lineitem),
required AS (SELECT * FROM typed WHERE l_tax IS NOT NULL),
exact AS (SELECT DISTINCT * FROM required),
latest AS (
  SELECT *, ROW_NUMBER() OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
  FROM exact)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax, l_shipdate,
       l_returnflag, l_linestatus = 'F' AS l_linestatus
FROM latest WHERE rn = 1 AND l_extendedprice >= 20000
""")
def structural_clean(spark, folder):
    """The configured chain: cast, text, required, copies, latest, range, boolean, split."""
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        "l_shipdate",
        F.concat(F.lit(" "), "l_returnflag").alias("l_returnflag"),
        "l_linestatus",
        F.lit("dev").alias("_env"),
    )
    config = {
        "schema": {"L_PARTKEY": "string"},
        "trim_columns": ["l_returnflag"],
        "lower_columns": ["l_returnflag"],
        "required_columns": ["l_tax"],
        "dedup_exclude_columns": ["_env"],
        "key_columns": ["l_orderkey", "l_linenumber"],
        "timestamp_column": "l_shipdate",
        "range_rules": {"l_extendedprice": [20000, None]},
        "boolean_map": {"l_linestatus": {"F": True, "O": False}},
        "metadata_columns": ["_env"],
    }
    data, _ = clean_structure(rows, config, tie_break=["l_suppkey", "l_extendedprice"])
    return data
