"""Quality results in tables: report, quarantine, resolutions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.functions.columns import column
from refinery.operators.rules import as_quarantine, failed_counts
from refinery.operators.skew import lookup_join
from refinery.sinks.tables import append_evolving, ensure_table

REPORT_DDL = """
    run_id STRING,
    run_timestamp STRING,
    pipeline_name STRING,
    source_table STRING,
    rule_id STRING,
    column STRING,
    rule_type STRING,
    severity STRING,
    description STRING,
    total_records BIGINT,
    passed_records BIGINT,
    failed_records BIGINT,
    pass_rate DOUBLE
"""
QUARANTINE_DDL = """
    run_id STRING,
    run_timestamp STRING,
    pipeline_name STRING,
    source_table STRING,
    rule_id STRING,
    column STRING,
    rule_type STRING,
    severity STRING,
    description STRING,
    column_value STRING,
    failure_reason STRING,
    quarantined_at TIMESTAMP,
    resolved BOOLEAN,
    resolved_at TIMESTAMP,
    resolved_note STRING
"""
RESOLUTION_DDL = """
    run_id STRING,
    rule_id STRING,
    resolved_at TIMESTAMP,
    resolved_note STRING
"""


def write_report(summary: DataFrame, table: str) -> None:
    ensure_table(summary.sparkSession, table, REPORT_DDL, "One row per rule and run")
    append_evolving(summary, table)


def report_lines(summary: DataFrame) -> list[str]:
    """The report as text, one line per rule (as many rows as there are rules)."""
    rows = summary.orderBy("rule_id").collect()
    lines = [
        f"{'ok  ' if r['failed_records'] == 0 else 'FAIL'} {r['rule_id']} [{r['severity']}] "
        f"{r['passed_records']} of {r['total_records']} passed, {r['failed_records']} failed, "
        f"{r['unknown_records']} unknown"
        for r in rows
    ]
    for severity in ("error", "warning"):
        failing = sum(r["severity"] == severity and r["failed_records"] > 0 for r in rows)
        lines.append(f"{severity} rules with failures: {failing}")
    return lines


def ensure_quarantine(spark: SparkSession, table: str) -> None:
    ensure_table(spark, table, QUARANTINE_DDL, "One row per failed record and rule")


def write_quarantine(failures: DataFrame, table: str) -> DataFrame | None:
    """Append failed records with their source columns; returns the counts per rule.

    Without failures the table is left as it is and the result is None. ``failures``
    is read more than once, so pass a staged frame.
    """
    ensure_quarantine(failures.sparkSession, table)
    if failures.isEmpty():
        return None
    append_evolving(as_quarantine(failures), table)
    return failed_counts(failures)


def resolve(spark: SparkSession, table: str, run_id: str, rule_id: str, note: str) -> None:
    """Mark the failures of one rule in one run as resolved. Nothing is ever deleted."""
    ensure_table(spark, table, RESOLUTION_DDL, "Resolutions of quarantined failures")
    spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(rule_id).alias("rule_id"),
        F.current_timestamp().alias("resolved_at"),
        F.lit(note).alias("resolved_note"),
    ).write.insertInto(table)


def with_resolutions(quarantine: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Quarantine rows with the state of their latest resolution.

    Resolutions are grouped first, so a row never multiplies. One rule may account for
    most of the quarantine, hence the lookup that broadcasts a small side or else spreads.
    """
    latest = resolutions.groupBy("run_id", "rule_id").agg(
        F.max(F.struct("resolved_at", "resolved_note")).alias("__latest")
    )
    joined = lookup_join(quarantine, latest, ["run_id", "rule_id"])
    done = F.col("__latest").isNotNull()
    state = {
        "resolved": F.col("resolved") | done,
        "resolved_at": F.coalesce(F.col("__latest.resolved_at"), F.col("resolved_at")),
        "resolved_note": F.coalesce(F.col("__latest.resolved_note"), F.col("resolved_note")),
    }
    return joined.select(*[state.get(c, column(c)).alias(c) for c in quarantine.columns])
