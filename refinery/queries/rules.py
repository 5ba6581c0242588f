"""Quality rules over orders and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from refinery.operators.rules import (
    Run,
    evaluate,
    failed_counts,
    failed_records,
    gate,
    rules_for_columns,
    summarise,
)
from refinery.plans.quality import run_quality
from refinery.queries import new_table, query, table

RUN = Run("orders_check", "orders", "run-1", "2024-01-01T00:00:00")
LABELS = ["rule_id", "column", "rule_type", "severity"]
COUNTS = ["total_records", "passed_records", "failed_records", "unknown_records", "pass_rate"]


def orders(spark, folder):
    """Orders with a nullable priority: '4-NOT SPECIFIED' counts as null."""
    priority = F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))
    return table(spark, folder, "orders").withColumn("o_orderpriority", priority)


ORDERS_SQL = """
o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
             NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority FROM orders)
"""


def rule(rule_id, column, rule_type, severity="error", **params):
    return {
        "rule_id": rule_id,
        "column": column,
        "rule_type": rule_type,
        "severity": severity,
        "description": f"checks {column}",
        "params": params,
    }


ORDER_RULES = [
    *rules_for_columns(
        ["o_orderkey", "o_orderpriority"],
        "not_null",
        id_pattern="{column}_not_null",
        description="checks {column}",
    ),
    rule("status_known", "o_orderstatus", "accepted_values", "warning",
         values=["o", "f"], case_sensitive=False),
    rule("price_range", "o_totalprice", "range", "warning", min=1000, max=400000),
    rule("priority_form", "o_orderpriority", "regex", "warning",
         pattern=r"^[1-3]-\S+$", case_sensitive=False),
    rule("dated_by_customer", "o_orderdate", "custom_sql", "error",
         expression="o_orderdate >= timestamp_ntz '1993-01-01' OR o_custkey > 100"),
]

# (rule_id, column, type, severity, predicate) of the same rules in SQL.
ORDER_RULES_SQL = [
    ("o_orderkey_not_null", "o_orderkey", "not_null", "error", "o_orderkey IS NOT NULL"),
    ("o_orderpriority_not_null", "o_orderpriority", "not_null", "error",
     "o_orderpriority IS NOT NULL"),
    ("status_known", "o_orderstatus", "accepted_values", "warning",
     "lower(o_orderstatus) IN ('o', 'f')"),
    ("price_range", "o_totalprice", "range", "warning", "o_totalprice BETWEEN 1000 AND 400000"),
    ("priority_form", "o_orderpriority", "regex", "warning",
     r"regexp_matches(o_orderpriority, '^[1-3]-\S+$', 'i')"),
    ("dated_by_customer", "o_orderdate", "custom_sql", "error",
     "o_orderdate >= TIMESTAMP '1993-01-01' OR o_custkey > 100"),
]


def summary_sql(rules, source, total="COUNT(*)"):
    return "\nUNION ALL\n".join(
        f"""SELECT '{i}' AS rule_id, '{c}' AS "column", '{t}' AS rule_type, '{s}' AS severity,
       {total} AS total_records,
       COUNT(*) FILTER ({p}) AS passed_records,
       COUNT(*) FILTER (NOT ({p})) AS failed_records,
       COUNT(*) FILTER (({p}) IS NULL) AS unknown_records,
       ROUND(COUNT(*) FILTER ({p}) / {total} * 100, 2) AS pass_rate
FROM {source}"""
        for i, c, t, s, p in rules
    )


@query(f"WITH {ORDERS_SQL} {summary_sql(ORDER_RULES_SQL, 'o')}")
def dq_rule_summary(spark, folder):
    return summarise(orders(spark, folder), ORDER_RULES, RUN).select(*LABELS, *COUNTS)


@query(
    f"WITH {ORDERS_SQL} "
    + "\nUNION ALL\n".join(
        f"SELECT o_orderkey, '{i}' AS rule_id, '{t}' AS rule_type, {p} AS passed FROM o"
        for i, _, t, _, p in ORDER_RULES_SQL
    )
)
def dq_verdicts(spark, folder):
    """Every record and rule with its verdict."""
    verdicts = evaluate(orders(spark, folder), ORDER_RULES, RUN, keep=["o_orderkey"])
    return verdicts.select("o_orderkey", "rule_id", "rule_type", "passed")


LINE_KEY = "concat(l_orderkey, '-', l_linenumber)"


def lines(spark, folder):
    return table(spark, folder, "lineitem").withColumn(
        "line_id", F.concat("l_orderkey", F.lit("-"), "l_linenumber")
    )


LINES_SQL = "l AS (SELECT *, l_orderkey || '-' || l_linenumber AS line_id FROM lineitem)"
UNIQUE_LINES = [rule("line_id_unique", "line_id", "unique")]
REPEATED_SQL = "r AS (SELECT *, COUNT(line_id) OVER (PARTITION BY line_id) AS copies FROM l)"


@query(f"""
WITH {LINES_SQL}, {REPEATED_SQL}
{summary_sql([('line_id_unique', 'line_id', 'unique', 'error', 'copies = 1')], 'r')}
""")
def dq_unique_summary(spark, folder):
    return summarise(lines(spark, folder), UNIQUE_LINES, RUN).select(*LABELS, *COUNTS)


@query(f"""
WITH {LINES_SQL}, {REPEATED_SQL}
SELECT line_id AS column_value, l_partkey, l_suppkey, l_shipdate,
       '[line_id_unique] checks line_id | column: line_id | value: ' || line_id AS failure_reason
FROM r WHERE copies <> 1
""")
def dq_unique_violations(spark, folder):
    failures = failed_records(lines(spark, folder), UNIQUE_LINES, RUN)
    return failures.select("column_value", "l_partkey", "l_suppkey", "l_shipdate", "failure_reason")


@query(f"""
WITH {LINES_SQL}, {REPEATED_SQL}
SELECT line_id, l_partkey, l_suppkey, 'line_id_unique' AS rule_id, copies = 1 AS passed FROM r
""")
def dq_unique_verdicts(spark, folder):
    verdicts = evaluate(
        lines(spark, folder), UNIQUE_LINES, RUN, keep=["line_id", "l_partkey", "l_suppkey"]
    )
    return verdicts.select("line_id", "l_partkey", "l_suppkey", "rule_id", "passed")


def _one_type(rule_type):
    """The records that fail the rules of one type, whatever the severity."""
    chosen = [r for r in ORDER_RULES if r["rule_type"] == rule_type]

    def build(spark, folder):
        failures = failed_records(
            orders(spark, folder), chosen, RUN, severities=("error", "warning")
        )
        return failures.select("rule_id", "severity", "o_orderkey", "o_custkey")

    build.__name__ = f"dq_{rule_type}"
    parts = [
        f"SELECT '{i}' AS rule_id, '{s}' AS severity, o_orderkey, o_custkey FROM o WHERE NOT ({p})"
        for i, _, t, s, p in ORDER_RULES_SQL
        if t == rule_type
    ]
    return query(f"WITH {ORDERS_SQL} " + " UNION ALL ".join(parts))(build)


for _rule_type in ("not_null", "accepted_values", "range", "regex", "custom_sql"):
    _one_type(_rule_type)


QUARANTINE_SQL = " UNION ALL ".join(
    f"""
SELECT '{i}' AS rule_id, '{c}' AS "column", '{t}' AS rule_type, 'error' AS severity,
       {'NULL' if t == 'not_null' else f"strftime({c}, '%Y-%m-%d %H:%M:%S')"} AS column_value,
       '[{i}] checks {c} | column: {c} | value: ' ||
       {"'NULL'" if t == 'not_null' else f"strftime({c}, '%Y-%m-%d %H:%M:%S')"} AS failure_reason,
       o_orderkey, o_custkey, o_totalprice
FROM o WHERE NOT ({p})"""
    for i, c, t, s, p in ORDER_RULES_SQL
    if s == "error"
)


@query(f"WITH {ORDERS_SQL} {QUARANTINE_SQL}")
def dq_quarantine(spark, folder):
    """Error failures with reason and source columns; a null value still gets a reason."""
    failures = failed_records(orders(spark, folder), ORDER_RULES, RUN)
    return failures.select(
        *LABELS, "column_value", "failure_reason", "o_orderkey", "o_custkey", "o_totalprice"
    )


@query(f"""
WITH {ORDERS_SQL}, q AS ({QUARANTINE_SQL})
SELECT rule_id, severity, COUNT(*) AS quarantined_count FROM q GROUP BY ALL
""")
def dq_quarantine_counts(spark, folder):
    return failed_counts(failed_records(orders(spark, folder), ORDER_RULES, RUN))


def _gate_sql(rules, source):
    return f"""
s AS ({summary_sql(rules, source)})
SELECT 'run-1' AS run_id, 'orders_check' AS pipeline_name, 'orders' AS source_table,
       COUNT(*) AS total_rules,
       COUNT(*) FILTER (severity = 'error' AND failed_records > 0) AS error_failures,
       COUNT(*) FILTER (severity = 'warning' AND failed_records > 0) AS warning_failures,
       COUNT(*) FILTER (severity = 'error' AND failed_records > 0) > 0 AS has_errors,
       COUNT(*) FILTER (severity = 'warning' AND failed_records > 0) > 0 AS has_warnings,
       COUNT(*) FILTER (severity = 'error' AND failed_records > 0) = 0 AS passed
FROM s"""


@query(f"WITH {ORDERS_SQL}, {_gate_sql(ORDER_RULES_SQL, 'o')}")
def dq_gate(spark, folder):
    """Closed: an error rule has failures."""
    return gate(summarise(orders(spark, folder), ORDER_RULES, RUN))


@query(
    f"WITH {ORDERS_SQL}, "
    + _gate_sql([r for r in ORDER_RULES_SQL if r[3] == "warning" or r[0] == "o_orderkey_not_null"], "o")
)
def dq_gate_warnings_only(spark, folder):
    """Open: warnings never block."""
    chosen = [
        r
        for r in ORDER_RULES
        if r["severity"] == "warning" or r["rule_id"] == "o_orderkey_not_null"
    ]
    return gate(summarise(orders(spark, folder), chosen, RUN))


def _written(spark, folder):
    """A quality run over orders into new tables; returns the names (report, quarantine)."""
    report, quarantine = new_table(spark, "report"), new_table(spark, "quarantine")
    run_quality(spark, ORDER_RULES, RUN, report, quarantine, orders(spark, folder))
    return report, quarantine


@query(f"""
WITH {ORDERS_SQL}, s AS ({summary_sql(ORDER_RULES_SQL, 'o')})
SELECT 'run-1' AS run_id, '2024-01-01T00:00:00' AS run_timestamp, 'orders_check' AS pipeline_name,
       'orders' AS source_table, s.*, 'checks ' || "column" AS description FROM s
""")
def dq_report_table(spark, folder):
    """The report as written to its table."""
    report, _ = _written(spark, folder)
    return spark.table(report)


@query(f"""
WITH {ORDERS_SQL}, q AS ({QUARANTINE_SQL})
SELECT rule_id, "column", severity, failure_reason, FALSE AS resolved, o_orderkey, o_totalprice FROM q
""")
def dq_quarantine_table(spark, folder):
    """The quarantine as written to its table, with the source columns added to it."""
    _, quarantine = _written(spark, folder)
    return spark.table(quarantine).select(
        "rule_id", "column", "severity", "failure_reason", "resolved", "o_orderkey", "o_totalprice"
    )
