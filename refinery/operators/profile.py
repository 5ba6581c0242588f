"""Profiling. All one-row metrics of a frame come from one aggregate over one scan;
duplicate keys need a grouping of their own."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions.columns import column, known

ROWS = "total_rows"
Measures = dict[str, Column]


def _null_rates(names: Sequence[str]) -> Measures:
    total = F.count(F.lit(1))
    return {f"{c}_null_pct": F.try_divide(F.count_if(column(c).isNull()), total) for c in names}


def _cardinality(names: Sequence[str]) -> Measures:
    measures = {}
    for c in names:
        distinct = F.approx_count_distinct(column(c))
        measures[f"{c}_distinct_count"] = distinct
        measures[f"{c}_distinct_pct"] = F.round(F.try_divide(distinct, F.count(F.lit(1))), 4)
    return measures


def _numeric(names: Sequence[str]) -> Measures:
    kinds = {"min": F.min, "max": F.max, "avg": F.avg, "stddev": F.stddev}
    return {f"{c}_{kind}": f(column(c)) for c in names for kind, f in kinds.items()}


def _time_range(names: Sequence[str]) -> Measures:
    kinds = {"min": F.min, "max": F.max}
    return {f"{c}_{kind}": f(column(c)) for c in names for kind, f in kinds.items()}


# Config key -> (section of the report, measures, metric type in long form)
SECTIONS: dict[str, tuple[str, Callable[[Sequence[str]], Measures], str]] = {
    "null_rate_cols": ("null_rates", _null_rates, "null_rate"),
    "cardinality_cols": ("cardinality", _cardinality, "cardinality"),
    "numeric_cols": ("numeric_distribution", _numeric, "numeric_distribution"),
    "timestamp_cols": ("timestamp_range", _time_range, "timestamp_range"),
}


def _one_row(df: DataFrame, names: Sequence[str], build, used_by: str) -> DataFrame:
    measures = build(known(df, names, used_by=used_by, strict=True))
    return df.agg(*[m.alias(name) for name, m in measures.items()])


def null_rates(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Share of nulls per column (0-1), one row; null over no rows."""
    return _one_row(df, names, _null_rates, "null_rates")


def cardinality(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Approximate distinct count per column and its share of the rows, one row."""
    return _one_row(df, names, _cardinality, "cardinality")


def numeric_distribution(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Minimum, maximum, mean and sample standard deviation per column, one row."""
    return _one_row(df, names, _numeric, "numeric_distribution")


def time_range(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return _one_row(df, names, _time_range, "time_range")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups with a repeated key, surplus rows, their share of all rows, and all rows.

    The grouping combines before the shuffle, so a key held by a large part of the rows
    moves as one count per task.
    """
    names = known(df, keys, used_by="duplicates", strict=True)
    copies, none = F.col("copies"), F.lit(0)
    return (
        df.groupBy(*[column(k) for k in names])
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.count_if(copies > 1).alias("duplicate_key_groups"),
            F.coalesce(F.sum(copies - 1), none).alias("duplicate_rows"),
            F.coalesce(F.sum(copies), none).alias(ROWS),
        )
        .withColumn(
            "duplicate_row_pct",
            F.coalesce(F.round(F.try_divide("duplicate_rows", ROWS), 4), F.lit(0.0)),
        )
        .select("duplicate_key_groups", "duplicate_rows", "duplicate_row_pct", ROWS)
    )


def _configured(df: DataFrame, config: Mapping) -> list[tuple[str, str, str, Column]]:
    """(section, metric type, name, measure) of every configured one-row metric."""
    found = []
    for key, (section, build, metric_type) in SECTIONS.items():
        names = known(df, config.get(key) or [], used_by=f"profile {key}")
        found += [(section, metric_type, name, m) for name, m in build(names).items()]
    return found


def profile(df: DataFrame, config: Mapping) -> dict[str, dict | None]:
    """The configured checks as a report on the driver: two jobs, whatever the config.

    The values are single numbers per column. A section over no rows or no columns is None.
    """
    report: dict[str, dict | None] = {
        section: None for key, (section, _, _) in SECTIONS.items() if key in config
    }
    metrics = _configured(df, config)
    if metrics:
        numbered = [m.alias(f"m{i}") for i, (_, _, _, m) in enumerate(metrics)]
        row = df.agg(F.count(F.lit(1)).alias(ROWS), *numbered).first()
        if row[ROWS]:
            for i, (section, _, name, _) in enumerate(metrics):
                report[section] = (report[section] or {}) | {name: row[f"m{i}"]}
    if "duplicate_keys" in config:
        keys = list(config["duplicate_keys"] or [])
        counts = duplicates(df, keys).first().asDict() if keys else {}
        report["duplicates"] = {"keys": keys, **counts}
    return report


def profile_metrics(df: DataFrame, dataset: str, config: Mapping) -> DataFrame:
    """The configured checks in long form: dataset, metric_type, column, metric_value, run_ts.

    Timestamps are given as seconds since 1970. Metrics without a value are left out.
    """
    parts = []
    metrics = _configured(df, config)
    if metrics:
        wide = df.agg(*[m.alias(f"m{i}") for i, (_, _, _, m) in enumerate(metrics)])
        timestamps = {f.name for f in wide.schema if f.dataType.typeName().startswith("timestamp")}
        parts.append(
            wide.select(
                F.inline(
                    F.array(
                        *[
                            _metric(kind, name, _number(f"m{i}", f"m{i}" in timestamps))
                            for i, (_, kind, name, _) in enumerate(metrics)
                        ]
                    )
                )
            )
        )
    if config.get("duplicate_keys"):
        label = ",".join(config["duplicate_keys"])
        counted = ("duplicate_key_groups", "duplicate_rows", "duplicate_row_pct")
        rows = F.array(*[_metric(name, label, _number(name)) for name in counted])
        parts.append(duplicates(df, config["duplicate_keys"]).select(F.inline(rows)))
    if not parts:
        raise ValueError("profile_metrics: the config names no check")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.where(F.col("metric_value").isNotNull()).select(
        F.lit(dataset).alias("dataset"), "*", F.current_timestamp().alias("run_ts")
    )


def _number(name: str, is_timestamp: bool = False) -> Column:
    value = F.col(name)
    return (F.unix_micros(value.cast("timestamp")) / 1e6 if is_timestamp else value).cast("double")


def _metric(kind: str, name: str, value: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("metric_type"), F.lit(name).alias("column"), value.alias("metric_value")
    )
