"""One quality run: rules over a frame, report, quarantine, verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from refinery.operators.rules import Run, failed_records, gate, summarise
from refinery.sinks.quality import ensure_quarantine, write_quarantine, write_report
from refinery.sinks.staging import staging


class QualityGateClosed(RuntimeError):
    """Error rules have failures; ``result`` tells which run."""

    def __init__(self, result: dict):
        super().__init__(
            f"{result['error_failures']} error rule(s) failed in run {result['run_id']}; "
            "records are in quarantine, the target was not updated"
        )
        self.result = result


def run_quality(
    spark: SparkSession,
    rules: Sequence[dict],
    run: Run,
    report_table: str,
    quarantine_table: str,
    df: DataFrame | None = None,
) -> dict:
    """Evaluate, write quarantine and report, and return the verdict (9 fields).

    ``df`` should be staged: it is read once for the summary and once for the failures.
    Without it the table ``run.source_table`` is read. Summary and failures are staged,
    so that what is written, reported and judged is the same.
    """
    source = spark.table(run.source_table) if df is None else df
    with staging(spark) as stage:
        summary = stage(summarise(source, rules, run), "summary")
        verdict = gate(summary).first().asDict()
        ensure_quarantine(spark, quarantine_table)
        if verdict["has_errors"]:
            failures = stage(failed_records(source, rules, run, keys_table=stage), "failures")
            write_quarantine(failures, quarantine_table)
        write_report(summary, report_table)
    return verdict


def require_passed(verdict: dict) -> dict:
    if not verdict["passed"]:
        raise QualityGateClosed(verdict)
    return verdict
