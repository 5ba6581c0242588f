"""Validation: string rules, functional dependencies, references, and their gate."""

from __future__ import annotations

import time
import traceback
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions.columns import column, known
from refinery.operators.membership import possible_rows
from refinery.operators.skew import BROADCAST_ROWS, broadcast_join, fits_broadcast

VERSION = "1.0.0"

# --- string rules ----------------------------------------------------------------------


def _breaks_pattern(value: Column, pattern: str) -> Column:
    return value.isNotNull() & ~value.rlike(pattern)


def _outside(value: Column, allowed: Sequence[str]) -> Column:
    return value.isNotNull() & ~F.upper(F.trim(value)).isin([v.upper() for v in allowed])


# Rule type -> (code of a violation, predicate that is true for a violation)
STRING_RULES = {
    "required": ("NULL_NOT_ALLOWED", lambda v, rule: v.isNull()),
    "regex": ("PATTERN_MISMATCH", lambda v, rule: _breaks_pattern(v, rule["pattern"])),
    "no_spaces": ("CONTAINS_WHITESPACE", lambda v, rule: _breaks_pattern(v, r"^\S+$")),
    "allowed_values": ("INVALID_VALUE", lambda v, rule: _outside(v, rule.get("values", []))),
}


def _string_checks(df: DataFrame, rules: Mapping) -> list[tuple[str, str, Column]]:
    """(column, violation code, violation predicate) of every configured rule."""
    checks = []
    for name, config in rules.items():
        for actual in known(df, [name], used_by="string rules"):
            for rule in config.get("rules", []):
                if rule.get("type") not in STRING_RULES:
                    raise ValueError(f"string rules, {name}: unknown type '{rule.get('type')}'")
                code, predicate = STRING_RULES[rule["type"]]
                checks.append((actual, code, predicate(column(actual).cast("string"), rule)))
    return checks


def string_violations(
    df: DataFrame, rules: Mapping, id_cols: Sequence[str] = ()
) -> DataFrame:
    """One row per violated rule and record: id columns, column, value, rule. One scan."""
    ids = known(df, id_cols, used_by="string rules", strict=True)
    checks = _string_checks(df, rules)
    kept = [column(c) for c in ids]
    if not checks:
        shape = [F.lit("").alias(n) for n in ("column", "value", "rule")]
        return df.select(*kept, *shape).where(F.lit(False))
    found = F.array(
        *[
            F.when(
                violated,
                F.struct(
                    F.lit(name).alias("column"),
                    column(name).cast("string").alias("value"),
                    F.lit(code).alias("rule"),
                ),
            )
            for name, code, violated in checks
        ]
    )
    anything = reduce(lambda a, b: a | b, [violated for _, _, violated in checks])
    return (
        df.where(anything)
        .select(*kept, F.explode(F.array_compact(found)).alias("__violation"))
        .select(*kept, "__violation.*")
    )


def _result(validator: str, rows: int, count: int, issues: DataFrame | None) -> dict:
    return {
        "status": "FAIL" if count else "PASS",
        "issues": issues if count else None,
        "metrics": {"rows_checked": rows, "violations_count": count},
        "validator": validator,
        "version": VERSION,
    }


def validate_strings(df: DataFrame, rules: Mapping, id_cols: Sequence[str] = ()) -> dict:
    """Status, metrics and the (lazy) violations; rows and violations are counted in one job."""
    checks = _string_checks(df, rules)
    total = reduce(
        lambda a, b: a + b, [F.count_if(violated) for _, _, violated in checks], F.lit(0)
    )
    row = df.agg(F.count(F.lit(1)).alias("rows"), total.alias("found")).first()
    return _result(
        "field_string_validation",
        row["rows"],
        row["found"],
        string_violations(df, rules, id_cols),
    )


# --- functional dependencies -----------------------------------------------------------

def _dependencies(df: DataFrame, rules: Mapping) -> list[tuple[list[str], str]]:
    checked = []
    for determinant, dependent in rules.items():
        names = [determinant] if isinstance(determinant, str) else list(determinant)
        found = known(df, [*names, dependent], used_by="functional dependencies")
        if len(found) == len(names) + 1:
            checked.append((found[:-1], found[-1]))
    return checked


def _keys(determinant: Sequence[str]) -> list[str]:
    return [f"__d{i}" for i in range(len(determinant))]


def _valued(df: DataFrame, determinant: Sequence[str], dependent: str) -> DataFrame:
    keys = [column(d).alias(k) for d, k in zip(determinant, _keys(determinant), strict=True)]
    value = column(dependent)
    return df.where(value.isNotNull()).select(*keys, value.alias("__value"))


def _violating(df: DataFrame, determinant: Sequence[str], dependent: str) -> DataFrame:
    """Determinants of several values: their smallest and largest value differ.

    Two values per key and task are all that is shuffled, however many rows or values it has.
    """
    extremes = _valued(df, determinant, dependent).groupBy(*_keys(determinant)).agg(
        F.min("__value").alias("__low"), F.max("__value").alias("__high")
    )
    return extremes.where("__low <> __high").drop("__low", "__high")


def _listed(df: DataFrame, determinant: Sequence[str], dependent: str) -> DataFrame:
    names = _keys(determinant)
    # Rows of the other determinants are left out before anything is made distinct.
    rows = possible_rows(_valued(df, determinant, dependent), names, _violating(df, determinant, dependent), names)
    pairs = rows.distinct()
    several = pairs.groupBy(*[F.col(k).alias(f"{k}_of") for k in names]).agg(F.count(F.lit(1)).alias("distinct_count"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in names])
    key = F.struct(*[F.col(k).alias(d) for k, d in zip(names, determinant, strict=True)])
    return pairs.join(several.where("distinct_count > 1"), same).select(
        F.to_json(key, {"ignoreNullFields": "false"}).alias("determinant"),
        F.lit(", ".join(determinant)).alias("column"),
        F.lit(dependent).alias("dependent_column"),
        F.col("__value").cast("string").alias("conflicting_value"),
        "distinct_count",
        F.lit("FUNCTIONAL_DEPENDENCY_VIOLATION").alias("rule"),
    )


def dependency_violations(df: DataFrame, rules: Mapping) -> DataFrame:
    """Determinants that occur with more than one dependent value, one row per value.

    Columns: determinant (JSON of the determinant columns), column, dependent_column,
    conflicting_value, distinct_count (values of the determinant), rule. Nulls do not count as a
    value; a null in a determinant is a value of it.
    """
    parts = [_listed(df, determinant, dependent) for determinant, dependent in _dependencies(df, rules)]
    if not parts:
        return df.sparkSession.createDataFrame(
            [],
            "determinant string, column string, dependent_column string, "
            "conflicting_value string, distinct_count bigint, rule string",
        )
    return reduce(DataFrame.unionByName, parts)


def check_dependencies(df: DataFrame, rules: Mapping) -> dict:
    """Status PASS or FAIL, the number of violating determinants, and the violations."""
    row_count = df.count()
    violating = 0
    issues = []
    for determinant, dependent in _dependencies(df, rules):
        found = _violating(df, determinant, dependent).count()
        violating += found
        if found:
            issues.append(_listed(df, determinant, dependent))
    return _result(
        "functional_dependency_validation",
        row_count,
        violating,
        reduce(DataFrame.unionByName, issues) if issues else None,
    )


# --- references ------------------------------------------------------------------------


def orphans(
    df: DataFrame, key: str, parent: DataFrame, parent_key: str, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows whose key is not null and does not occur in the parent table.

    Few parents, at most ``max_rows``, are broadcast. Otherwise the distinct keys of both tables
    are compared, and rows are shuffled only if a bitmap of the missing keys marks theirs.
    """
    (name,) = known(df, [key], used_by="references", strict=True)
    (theirs,) = known(parent, [parent_key], used_by="references", strict=True)
    parents = parent.select(column(theirs).alias(name)).where(column(name).isNotNull())
    children = df.where(column(name).isNotNull())
    if fits_broadcast(parents, max_rows):
        return broadcast_join(children, parents.distinct(), name, "left_anti")
    missing = children.select(column(name)).distinct().join(parents.distinct(), name, "left_anti")
    return possible_rows(children, [name], missing, [name]).join(missing, name, "left_semi")


def check_references(
    df: DataFrame,
    rules: Mapping[str, tuple[DataFrame, str]],
    id_cols: Sequence[str] = (),
) -> dict:
    """``rules`` maps a column to (parent frame, parent key). Violations as for string rules."""
    parts = []
    for name, (parent, parent_key) in rules.items():
        missing = orphans(df, name, parent, parent_key)
        parts.append(
            missing.select(
                *[column(c) for c in id_cols],
                F.lit(name).alias("column"),
                column(name).cast("string").alias("value"),
                F.lit("REFERENCE_NOT_FOUND").alias("rule"),
            )
        )
    issues = reduce(DataFrame.unionByName, parts) if parts else None
    return _result("reference_validation", df.count(), issues.count() if parts else 0, issues)


# --- orchestration ---------------------------------------------------------------------


class ValidationFailed(RuntimeError):
    """The validation gate is closed."""


@dataclass
class _Section:
    """How one validator went."""

    status: str = "SKIPPED"
    result: dict | None = None
    error: dict | None = None
    duration_ms: int = 0
    reason: str | None = None

    def failed(self) -> bool:
        return self.status == "SUCCESS" and self.result["status"] == "FAIL"

    def shown(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "reason" or v is not None}


def _isolated(name: str, check: Callable[[], dict]) -> _Section:
    """Run one validator; if it breaks down, that is its outcome and the others still run."""
    section, began = _Section(), time.monotonic_ns()
    try:
        section.result, section.status = check(), "SUCCESS"
    except Exception as failure:  # noqa: BLE001 - isolation is the purpose
        section.status = "SYSTEM_ERROR"
        steps = [f"{f.name}:{f.lineno}" for f in traceback.extract_tb(failure.__traceback__)]
        section.error = {"validator": name, "type": type(failure).__name__, "message": str(failure), "trace": " > ".join(steps)}
    section.duration_ms = (time.monotonic_ns() - began) // 1_000_000
    return section


#: The first that holds decides: (final status, whether it holds for the report's meta data).
FINAL_STATUS = (
    ("VALIDATION_SYSTEM_ERROR", lambda meta: meta["system_errors"]),
    ("VALIDATION_FAILED", lambda meta: meta["errors_detected"]),
    ("VALIDATION_PASSED", lambda meta: bool(meta["validators_run"])),
    ("VALIDATION_SKIPPED", lambda meta: True),
)


def run_validation(
    df: DataFrame,
    config: Mapping,
    id_cols: Sequence[str] = (),
    parents: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> dict:
    """Run the configured validators and derive the final status.

    ``field_rules.string_rules`` and ``business_rules.functional_dependencies`` come from
    the config; ``parents`` adds reference checks.
    """
    plan = {
        "field": (
            "field_validation",
            "field_rules" in config,
            lambda: validate_strings(df, config["field_rules"].get("string_rules", {}), id_cols),
        ),
        "business": (
            "business_validation",
            "business_rules" in config,
            lambda: check_dependencies(
                df, config["business_rules"].get("functional_dependencies", {})
            ),
        ),
        "reference": (
            "reference_validation",
            parents is not None,
            lambda: check_references(df, parents, id_cols),
        ),
    }
    meta = {
        "validators_run": [name for name, wanted, _ in plan.values() if wanted],
        "validators_skipped": [name for name, wanted, _ in plan.values() if not wanted],
    }
    sections = {
        key: _isolated(name, check) if wanted else _Section(reason=f"{name} is not configured")
        for key, (name, wanted, check) in plan.items()
    }
    meta["system_errors"] = any(s.status == "SYSTEM_ERROR" for s in sections.values())
    meta["errors_detected"] = any(s.failed() for s in sections.values())
    final = next(status for status, holds in FINAL_STATUS if holds(meta))
    return {**{key: s.shown() for key, s in sections.items()}, "meta": meta, "final_status": final}


def issues_of(report: Mapping, section: str) -> DataFrame | None:
    """The violations of a section; None when it passed, was skipped or broke down."""
    result = (report.get(section) or {}).get("result")
    return result["issues"] if result else None


def close_gate(report: Mapping, env: str, enforced: Sequence[str] = ("dev", "prod")) -> None:
    """Raise in the enforced environments when validation failed or broke down."""
    if env in enforced and report["final_status"] in (
        "VALIDATION_FAILED",
        "VALIDATION_SYSTEM_ERROR",
    ):
        raise ValidationFailed(f"validation ended with {report['final_status']}")
