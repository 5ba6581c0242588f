"""Configured structural cleaning of a bronze frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions.columns import column, find, known, known_map
from refinery.functions.expressions import to_boolean, to_utc
from refinery.operators.dedup import drop_exact_copies, latest_version


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by map; a value that does not convert becomes null instead of failing the job."""
    wanted = known_map(df, types, used_by="cast_columns")
    return df.withColumns({c: column(c).try_cast(t) for c, t in wanted.items()})


def standardise_text(
    df: DataFrame,
    trim: Sequence[str] = (),
    lower: Sequence[str] = (),
    upper: Sequence[str] = (),
) -> DataFrame:
    """Trim, then lower, then upper; a column listed twice gets both, in that order."""
    steps = ((trim, F.trim), (lower, F.lower), (upper, F.upper))
    changed: dict = {}
    for names, step in steps:
        for c in known(df, names, used_by="standardise_text"):
            changed[c] = step(changed.get(c, column(c)))
    return df.withColumns(changed) if changed else df


def require(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows in which all the named columns hold a value."""
    present = known(df, names, used_by="require")
    return df.dropna(subset=present) if present else df


def within_ranges(df: DataFrame, ranges: Mapping[str, Sequence]) -> DataFrame:
    """Rows inside every inclusive (low, high) range; a None bound is open.

    A null value is outside any range that has a bound.
    """
    for c, (low, high) in known_map(df, ranges, used_by="within_ranges").items():
        if low is not None:
            df = df.where(column(c) >= F.lit(low))
        if high is not None:
            df = df.where(column(c) <= F.lit(high))
    return df


def columns_to_utc(df: DataFrame, names: Sequence[str], source_zone: str = "UTC") -> DataFrame:
    present = known(df, names, used_by="columns_to_utc")
    return df.withColumns({c: to_utc(column(c), source_zone) for c in present}) if present else df


def columns_to_boolean(df: DataFrame, maps: Mapping[str, Mapping]) -> DataFrame:
    present = {
        c: m for c, m in known_map(df, maps, used_by="columns_to_boolean").items() if m
    }
    return df.withColumns({c: to_boolean(column(c), m) for c, m in present.items()}) if present else df


def split_metadata(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """(data without the metadata columns, the metadata columns or None)."""
    present = known(df, names, used_by="split_metadata")
    if not present:
        return df, None
    return df.drop(*present), df.select(*[column(c) for c in present])


def _without_duplicates(
    df: DataFrame, config: Mapping, tie_break: Sequence[str] | None
) -> DataFrame:
    """Exact copies go, then all but the latest version of a key.

    Copies share their key and time, so where versions are ranked by a compared column the
    ranking removes copies too (the first ingested stays), and one shuffle does for both.
    """
    ignored = known(df, config.get("dedup_exclude_columns") or [], used_by="structural_clean")
    keys, timestamp = config.get("key_columns") or [], config.get("timestamp_column")
    if not keys or not timestamp or find(df, timestamp) is None:
        return drop_exact_copies(df, ignored)
    ranked_by = {find(df, c) for c in (*keys, timestamp)}
    if ranked_by & set(ignored):
        return latest_version(drop_exact_copies(df, ignored), keys, timestamp, tie_break)
    compared = [c for c in sorted(df.columns) if c not in ranked_by and c not in ignored]
    first = list(tie_break or [])
    order = first + [c for c in compared if c not in first]
    return latest_version(df, keys, timestamp, order, ignored)


def structural_clean(
    df: DataFrame, config: Mapping | None, tie_break: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """The whole chain. Order matters: values are typed and trimmed before they are
    required, compared as copies, ranked in time and range-checked."""
    config = config or {}

    def setting(key, empty):
        return config.get(key) or empty

    df = cast_columns(df, setting("schema", {}))
    df = standardise_text(
        df,
        trim=setting("trim_columns", []),
        lower=setting("lower_columns", []),
        upper=setting("upper_columns", []),
    )
    df = require(df, setting("required_columns", []))
    df = _without_duplicates(df, config, tie_break)
    df = within_ranges(df, setting("range_rules", {}))
    df = columns_to_utc(df, setting("timestamp_columns", []))
    df = columns_to_boolean(df, setting("boolean_map", {}))
    return split_metadata(df, setting("metadata_columns", []))
