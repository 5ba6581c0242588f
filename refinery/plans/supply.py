"""Supply: CSV -> bronze -> cleaned silver -> validation gate -> KPI tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from refinery.operators.clean import structural_clean
from refinery.operators.profile import profile, profile_metrics
from refinery.operators.validate import close_gate, issues_of, run_validation
from refinery.plans.kpis import publish_kpis
from refinery.sinks.tables import append, ensure_schemas, replace_table, schema_name
from refinery.sources.files import csv_to_bronze

PROJECT = "supply"
# Configurations of the transactions dataset.
PROFILE_CONFIG = {
    "duplicate_keys": ["SKU", "Product_type"],
    "numeric_cols": ["Manufacturing_costs"],
    "timestamp_cols": ["_ingest_ts"],
    "null_rate_cols": ["Product_type", "SKU", "Price"],
}
CLEANING_CONFIG = {
    "schema": {"Product_type": "string", "SKU": "string", "price": "float"},
    "required_columns": ["SKU", "price"],
    "dedup_exclude_columns": ["_ingest_ts", "_env", "_source_file"],
    "range_rules": {"price": [0, None]},
}
VALIDATION_CONFIG = {
    "field_rules": {
        "string_rules": {
            "SKU": {
                "rules": [
                    {"type": "required"},
                    {"type": "no_spaces"},
                    {"type": "regex", "pattern": "^SKU[0-9]+$"},
                ]
            },
            "Product_Type": {
                "rules": [
                    {"type": "allowed_values", "values": ["SKINCARE", "HAIRCARE", "COSMETICS"]}
                ]
            },
        }
    }
}


def setup(spark: SparkSession, envs: Sequence[str] = ("dev", "test", "prod")) -> list[str]:
    """The bronze, silver and gold schemas of every environment."""
    layers = ("bronze", "silver", "gold")
    return [name for env in envs for name in ensure_schemas(spark, env, PROJECT, layers)]


def land_csv(
    spark: SparkSession, path: str, env: str, table: str = "supply_chain_raw", schema=None
) -> str:
    target = f"{schema_name('bronze', env, PROJECT)}.{table}"
    append(csv_to_bronze(spark, path, env, schema), target)
    return target


def refine(
    bronze: DataFrame, cleaning: Mapping, profiling: Mapping, *, profile_after: bool = True
) -> dict:
    """Profile, clean and profile again."""
    silver, metadata = structural_clean(bronze, cleaning)
    return {
        "silver_df": silver,
        "metadata_df": metadata,
        "bronze_report": profile(bronze, profiling),
        "silver_report": profile(silver, profiling) if profile_after else None,
    }


def load_silver(
    spark: SparkSession,
    bronze_table: str,
    env: str,
    cleaning: Mapping = CLEANING_CONFIG,
    profiling: Mapping = PROFILE_CONFIG,
) -> tuple[str, DataFrame]:
    """Clean the bronze table into the silver transactions table; returns it and the metrics.

    The cleaned rows are written first and profiled from the table, so the cleaning runs once.
    """
    bronze = spark.table(bronze_table)
    silver, _ = structural_clean(bronze, cleaning)
    target = f"{schema_name('silver', env, PROJECT)}.transactions"
    replace_table(silver, target)
    metrics = profile_metrics(bronze, "bronze", profiling).unionByName(
        profile_metrics(spark.table(target), "silver", profiling)
    )
    return target, metrics


def validate_silver(
    spark: SparkSession,
    silver_table: str,
    env: str,
    config: Mapping = VALIDATION_CONFIG,
    id_cols: Sequence[str] = (),
) -> dict:
    """Validate, write the field violations, then close the gate where it is enforced."""
    report = run_validation(spark.table(silver_table), config, id_cols)
    issues = issues_of(report, "field")
    if issues is not None:
        replace_table(issues, f"{schema_name('silver', env, PROJECT)}.silver_validation_issues")
    close_gate(report, env)
    return report


def publish_gold(spark: SparkSession, silver_table: str, env: str) -> dict[str, DataFrame]:
    return publish_kpis(spark.table(silver_table), env, PROJECT)
