"""Keyed upsert as a DataFrame expression."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from refinery.functions.columns import column
from refinery.functions.types import fits_losslessly
from refinery.operators.dedup import latest_per_key
from refinery.sinks.staging import stage


def newest_per_key(
    updates: DataFrame, keys: Sequence[str], version: str | None = None
) -> DataFrame:
    """One update per key: the latest by ``version``, else by the other columns."""
    order = version or next((c for c in updates.columns if c not in keys), keys[0])
    return latest_per_key(updates, keys, order)


def replace_by_key(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], version: str | None = None
) -> DataFrame:
    """``merge_rows`` for updates that already hold each key once.

    One full outer join reads both sides once. Keys match null-safely; a null version is the
    oldest, on either side.
    """
    target, updates = in_common_types(target, updates)
    ours = {c.lower(): f"__target_{i}" for i, c in enumerate(target.columns)}
    theirs = {c.lower(): f"__update_{i}" for i, c in enumerate(updates.columns)}
    left = target.select(
        *[column(c).alias(ours[c.lower()]) for c in target.columns], F.lit(True).alias("__in_target")
    )
    right = updates.select(
        *[column(c).alias(theirs[c.lower()]) for c in updates.columns], F.lit(True).alias("__in_updates")
    )
    same = reduce(
        and_, [F.col(ours[k.lower()]).eqNullSafe(F.col(theirs[k.lower()])) for k in keys]
    )
    take = F.col("__in_updates").isNotNull()
    if version and version.lower() in ours and version.lower() in theirs:
        held, new = F.col(ours[version.lower()]), F.col(theirs[version.lower()])
        stale = F.coalesce(held > new, held.isNotNull() & new.isNull())
        take = take & ~(F.col("__in_target").isNotNull() & stale)
    names = [*target.columns, *[c for c in updates.columns if c.lower() not in ours]]
    empty = F.lit(None)
    return left.join(right, same, "full").select(
        *[
            F.when(take, F.col(theirs[c.lower()]) if c.lower() in theirs else empty)
            .otherwise(F.col(ours[c.lower()]) if c.lower() in ours else empty)
            .alias(c)
            for c in names
        ]
    )


def in_common_types(target: DataFrame, updates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the target's names, and one type per shared column.

    The type that holds the other's values losslessly is taken; numbers of which none holds the
    other meet in Spark's common type, anything else as text.
    """
    held = {f.name.lower(): f for f in target.schema}
    updates = updates.withColumnsRenamed({c: held[c.lower()].name for c in updates.columns if c.lower() in held})
    ours, theirs = {}, {}
    for f in updates.schema:
        mine = held.get(f.name.lower())
        if mine is None or mine.dataType == f.dataType:
            continue
        if fits_losslessly(f.dataType, mine.dataType):
            theirs[f.name] = column(f.name).cast(mine.dataType)
        elif fits_losslessly(mine.dataType, f.dataType):
            ours[mine.name] = column(mine.name).cast(f.dataType)
        elif not (isinstance(f.dataType, NumericType) and isinstance(mine.dataType, NumericType)):
            ours[mine.name] = column(mine.name).cast("string")
            theirs[f.name] = column(f.name).cast("string")
    return target.withColumns(ours) if ours else target, updates.withColumns(theirs) if theirs else updates


def replace_few(target: DataFrame, updates: DataFrame, keys: Sequence[str], version: str | None = None) -> DataFrame:
    """``replace_by_key`` for updates that fit in memory: the target is not shuffled.

    Replaced rows are left out by a broadcast anti join and the updates follow as rows of their
    own, so a key that a broken run has left twice in the target is held once again.
    """
    target, updates = in_common_types(target, updates)
    names = [f"__key_{i}" for i in range(len(keys))]
    versioned = bool(version) and any(c.lower() == version.lower() for c in target.columns)
    few = updates.select(
        *[column(k).alias(n) for k, n in zip(keys, names, strict=True)],
        *([column(version).alias("__version")] if versioned else []),
    )
    same = reduce(and_, [column(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)])
    if not versioned:
        kept = target.join(F.broadcast(few), same, "left_anti")
        return kept.unionByName(updates, allowMissingColumns=True)
    held, new = column(version), F.col("__version")
    stale = F.coalesce(held > new, held.isNotNull() & new.isNull())
    kept = target.join(F.broadcast(few), same & ~stale, "left_anti")
    # No more rows than there are updates.
    older = target.join(F.broadcast(few), same & stale).select(*names).distinct()
    return kept.unionByName(updates.join(F.broadcast(older), same, "left_anti"), allowMissingColumns=True)


def merge_rows(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    version: str | None = None,
    *,
    updates_table=stage,
) -> DataFrame:
    """``target`` with the rows of ``updates`` replaced by key, and new keys added.

    Several updates of one key count as their latest (by ``version``, else by the other
    columns). With ``version`` an older update never replaces a newer row; a null version is
    the oldest. Null keys are equal to each other. ``target`` holds each key once. Columns
    only one side has are filled with null. Applying the same updates twice changes nothing.

    The updates are needed several times, so ``updates_table`` writes them down once.
    """
    newest = updates_table(newest_per_key(updates, keys, version))
    return replace_by_key(target, newest, keys, version)
