"""Scalar building blocks: value maps, pattern maps, text and time normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def first_true(cases: Sequence[tuple[Column, Column]], default: Column | None = None) -> Column:
    """CASE expression over (condition, value) pairs; null when nothing holds."""
    if not cases:
        return F.lit(None) if default is None else default
    (condition, value), *rest = cases
    chain = reduce(lambda acc, case: acc.when(*case), rest, F.when(condition, value))
    return chain if default is None else chain.otherwise(default)


def map_values(source: Column, mapping: Mapping) -> Column:
    """Exact value lookup; a value outside the mapping becomes null."""
    return first_true([(source == F.lit(k), F.lit(v)) for k, v in mapping.items()])


def map_patterns(
    source: Column, rules: Sequence[Mapping[str, str]], outputs: Sequence[str]
) -> Column:
    """Struct of ``outputs`` from the first rule whose ``pattern`` occurs in the text.

    The text is lower-cased, so patterns are written in lower case.
    """
    text = F.lower(source)
    return first_true(
        [
            (
                text.contains(rule["pattern"]),
                F.struct(*[F.lit(rule.get(name)).cast("string").alias(name) for name in outputs]),
            )
            for rule in rules
        ]
    )


def first_extract(candidates: Sequence[tuple[Column, str]], group: int = 1) -> Column:
    """First non-empty regex capture over (column, pattern) candidates, else null."""
    return F.coalesce(
        *[F.nullif(F.regexp_extract(c, pattern, group), F.lit("")) for c, pattern in candidates]
    )


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def to_boolean(source: Column, mapping: Mapping) -> Column:
    """Boolean from a value map, matched on trimmed lower-case text; else null."""
    text = F.lower(F.trim(source.cast("string")))
    cases = [(text == str(raw).strip().lower(), F.lit(flag)) for raw, flag in mapping.items()]
    return first_true(cases).cast("boolean")


def parse_iso(text: Column) -> Column:
    """Timestamp from ISO-8601 text; text that is not a timestamp becomes null."""
    return F.try_to_timestamp(text)


def format_iso(ts: Column, *, seconds_only: bool = False) -> Column:
    """ISO-8601 text in UTC with a ``Z`` suffix (session time zone must be UTC)."""
    return F.date_format(ts, ISO_SECONDS if seconds_only else ISO_MICROS)


def to_utc(ts: Column, source_zone: str = "UTC") -> Column:
    return F.to_utc_timestamp(ts.cast("timestamp"), source_zone)


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / whole * 100``; null when the whole is 0."""
    value = F.try_divide(part.cast("double"), whole.cast("double")) * 100
    return value if digits is None else F.round(value, digits)


def coverage_band(rate: Column, good: float = 80.0, medium: float = 50.0) -> Column:
    return F.when(rate >= good, "good").when(rate >= medium, "medium").otherwise("poor")
