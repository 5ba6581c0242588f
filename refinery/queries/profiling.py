"""Profiling over orders, lineitem and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from refinery.operators.profile import (
    cardinality,
    duplicates,
    null_rates,
    numeric_distribution,
    profile_metrics,
    time_range,
)
from refinery.queries import query, table


def nullable_lines(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
        "l_shipdate",
    )


LINES_SQL = """
n AS (SELECT l_orderkey, l_linenumber, l_quantity, NULLIF(l_tax, 0) AS l_tax,
             NULLIF(l_returnflag, 'N') AS l_returnflag, l_shipdate FROM lineitem),
d AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY ALL)
"""


def rounded(df, digits=6):
    """Doubles rounded, so that the order of additions does not show."""
    return df.select(
        *[
            F.round(c, digits).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


@query(f"""
WITH {LINES_SQL}
SELECT ROUND(COUNT(*) FILTER (l_tax IS NULL) / COUNT(*), 6) AS l_tax_null_pct,
       ROUND(COUNT(*) FILTER (l_returnflag IS NULL) / COUNT(*), 6) AS l_returnflag_null_pct,
       ROUND(COUNT(*) FILTER (l_shipdate IS NULL) / COUNT(*), 6) AS l_shipdate_null_pct
FROM n
""")
def profile_null_rates(spark, folder):
    return rounded(null_rates(nullable_lines(spark, folder), ["L_TAX", "l_returnflag", "l_shipdate"]))


@query(f"""
WITH {LINES_SQL}
SELECT COUNT(*) FILTER (copies > 1) AS duplicate_key_groups,
       CAST(SUM(copies - 1) AS BIGINT) AS duplicate_rows,
       ROUND(SUM(copies - 1) / SUM(copies), 4) AS duplicate_row_pct,
       CAST(SUM(copies) AS BIGINT) AS total_rows
FROM d
""")
def profile_duplicates(spark, folder):
    return duplicates(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"""
WITH {LINES_SQL}
SELECT MIN(l_quantity) AS l_quantity_min, MAX(l_quantity) AS l_quantity_max,
       ROUND(AVG(l_quantity), 6) AS l_quantity_avg, ROUND(STDDEV(l_quantity), 6) AS l_quantity_stddev,
       MIN(l_tax) AS l_tax_min, MAX(l_tax) AS l_tax_max,
       ROUND(AVG(l_tax), 6) AS l_tax_avg, ROUND(STDDEV(l_tax), 6) AS l_tax_stddev
FROM n
""")
def profile_numeric(spark, folder):
    return rounded(numeric_distribution(nullable_lines(spark, folder), ["l_quantity", "l_tax"]))


@query("""
SELECT MIN(ts) AS ts_min, MAX(ts) AS ts_max FROM events
""")
def profile_ts_range(spark, folder):
    return time_range(table(spark, folder, "events"), ["ts"])


@query()
def profile_cardinality(spark, folder):
    """Approximate by design, so there is no SQL that must agree to the digit."""
    return cardinality(table(spark, folder, "orders"), ["o_custkey", "o_orderpriority"])


CONFIG = {
    "null_rate_cols": ["l_tax", "l_returnflag"],
    "numeric_cols": ["l_quantity"],
    "timestamp_cols": ["l_shipdate"],
    "duplicate_keys": ["l_orderkey", "l_linenumber"],
}


@query(f"""
WITH {LINES_SQL},
m AS (
  SELECT 'null_rate' AS metric_type, 'l_tax_null_pct' AS "column",
         COUNT(*) FILTER (l_tax IS NULL) / COUNT(*) AS metric_value FROM n
  UNION ALL SELECT 'null_rate', 'l_returnflag_null_pct',
         COUNT(*) FILTER (l_returnflag IS NULL) / COUNT(*) FROM n
  UNION ALL SELECT 'numeric_distribution', 'l_quantity_min', MIN(l_quantity) FROM n
  UNION ALL SELECT 'numeric_distribution', 'l_quantity_max', MAX(l_quantity) FROM n
  UNION ALL SELECT 'numeric_distribution', 'l_quantity_avg', AVG(l_quantity) FROM n
  UNION ALL SELECT 'numeric_distribution', 'l_quantity_stddev', STDDEV(l_quantity) FROM n
  UNION ALL SELECT 'timestamp_range', 'l_shipdate_min', epoch(MIN(l_shipdate)) FROM n
  UNION ALL SELECT 'timestamp_range', 'l_shipdate_max', epoch(MAX(l_shipdate)) FROM n
  UNION ALL SELECT 'duplicate_key_groups', 'l_orderkey,l_linenumber',
         CAST(COUNT(*) FILTER (copies > 1) AS DOUBLE) FROM d
  UNION ALL SELECT 'duplicate_rows', 'l_orderkey,l_linenumber', CAST(SUM(copies - 1) AS DOUBLE) FROM d
  UNION ALL SELECT 'duplicate_row_pct', 'l_orderkey,l_linenumber',
         ROUND(SUM(copies - 1) / SUM(copies), 4) FROM d)
SELECT 'lineitem' AS dataset, metric_type, "column", ROUND(metric_value, 6) AS metric_value FROM m
""")
def profile_long_metrics(spark, folder):
    """All configured metrics as rows, from one aggregate and one grouping."""
    metrics = profile_metrics(nullable_lines(spark, folder), "lineitem", CONFIG)
    return rounded(metrics.drop("run_ts"))
