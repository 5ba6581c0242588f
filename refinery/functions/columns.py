"""Column lookup by name, with the case-insensitive matching Spark SQL uses."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class UnknownColumnWarning(UserWarning):
    """A configured column does not exist in the frame it was meant for."""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """The top-level column called exactly ``name`` (dots and spaces allowed)."""
    return F.col(quoted(name))


def find(df: DataFrame, name: str) -> str | None:
    """The frame's own spelling of ``name``, or None when it has no such column."""
    if name in df.columns:
        return name
    lowered = name.lower()
    return next((c for c in df.columns if c.lower() == lowered), None)


def known(
    df: DataFrame, names: Iterable[str], *, used_by: str, strict: bool = False
) -> list[str]:
    """The frame's spelling of each name; unknown ones are reported, not ignored.

    ``strict`` turns the warning into a ``ValueError``.
    """
    found, missing = [], []
    for name in names:
        actual = find(df, name)
        if actual is None:
            missing.append(name)
        elif actual not in found:
            found.append(actual)
    if missing:
        message = f"{used_by}: no column {', '.join(missing)} in ({', '.join(df.columns)})"
        if strict:
            raise ValueError(message)
        warnings.warn(message, UnknownColumnWarning, stacklevel=3)
    return found


def known_map(df: DataFrame, mapping: dict, *, used_by: str, strict: bool = False) -> dict:
    """``mapping`` keyed by the frame's own column spelling."""
    known(df, mapping, used_by=used_by, strict=strict)
    return {find(df, k): v for k, v in mapping.items() if find(df, k) is not None}
