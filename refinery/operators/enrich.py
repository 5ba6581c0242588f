"""Enrichment of facts: value maps, pattern maps, lookups, scope."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions.columns import column
from refinery.functions.expressions import first_extract, map_patterns, map_values
from refinery.operators.dedup import latest_per_key
from refinery.operators.skew import lookup_join


def add_mapped(df: DataFrame, source: str, target: str, mapping: Mapping) -> DataFrame:
    return df.withColumn(target, map_values(column(source), mapping))


def add_pattern_columns(
    df: DataFrame, source: str, rules: Sequence[Mapping[str, str]], outputs: Sequence[str]
) -> DataFrame:
    """Several columns from the first matching pattern; one pass over the rules for all."""
    if not rules:
        raise ValueError("add_pattern_columns: no rules")
    match = map_patterns(column(source), rules, outputs)
    return df.withColumns({name: match[name] for name in outputs})


def add_first_extract(
    df: DataFrame, target: str, candidates: Sequence[tuple[str, str]], group: int = 1
) -> DataFrame:
    pairs = [(column(c), pattern) for c, pattern in candidates]
    return df.withColumn(target, first_extract(pairs, group))


def in_scope(df: DataFrame, name: str) -> DataFrame:
    return df.where(column(name).isNotNull())


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    newest_by: str | Sequence[str] | None = None,
    **join_options,
) -> DataFrame:
    """Left join to the latest dimension row per key, so that facts never multiply.

    ``newest_by`` orders the versions of one key; without it the other columns decide.
    """
    order = newest_by or [c for c in dimension.columns if c != dimension_key][:1] or [dimension_key]
    current = latest_per_key(dimension, [dimension_key], order)
    drop = [newest_by] if isinstance(newest_by, str) else list(newest_by or [])
    current = current.drop(*drop).withColumnRenamed(dimension_key, fact_key)
    return lookup_join(facts, current, fact_key, "left", bound=dimension, **join_options)


def keyed_lookup(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, spread: int = 64) -> DataFrame:
    """Left join to a dimension that holds every text key once, such as a lookup table.

    Spark broadcasts the dimension if its files are small; else it reads a bucketed table as
    it lies and shuffles the facts alone. Facts without a key match nothing and are dealt out
    under ``spread`` keys that no dimension has.
    """
    nowhere = F.concat(F.lit("\0none "), F.pmod(F.xxhash64(*[column(c) for c in facts.columns]), F.lit(spread)).cast("string"))
    keyed = facts.withColumn("__key", F.coalesce(column(fact_key), nowhere))
    return keyed.join(dimension, F.col("__key") == column(dimension_key), "left").drop("__key", dimension_key)
