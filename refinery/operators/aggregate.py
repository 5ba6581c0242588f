"""Reporting aggregates over a gold frame. All of them combine before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions.columns import column, known
from refinery.functions.expressions import coverage_band, percent


def rows() -> Column:
    return F.count(F.lit(1))


def dataset_summary(
    df: DataFrame, distinct: Sequence[str], date: str, total: str = "total"
) -> DataFrame:
    """One row: row count, exact distinct count per column, first and last date.

    Rows are first combined by all the columns together, so that what is repeated per column
    is a combination that occurs, not a row.
    """
    day, n = F.col("__date"), F.col("__n")
    values = [F.col(f"__v{i}") for i in range(len(distinct))]
    taken = df.select(
        *[column(c).alias(f"__v{i}") for i, c in enumerate(distinct)], column(date).alias("__date")
    )
    cells = taken.groupBy(*values).agg(
        rows().alias("__n"), F.min(day).alias("__from"), F.max(day).alias("__to")
    )
    kinds = {c: taken.schema[c].dataType for c in taken.columns}

    def share_of(i: int) -> Column:
        """The combination as a row of column ``i``; the first one carries the other figures."""
        held = [
            (F.col(f"__v{k}") if k == i else F.lit(None).cast(kinds[f"__v{k}"])).alias(f"__v{k}")
            for k in range(len(distinct))
        ]
        return F.struct(F.lit(i).alias("__i"), *held, (n if i == 0 else F.lit(0).cast("long")).alias("__n"))

    listed = cells.select(
        "__from", "__to", F.inline(F.array(*[share_of(i) for i in range(max(len(distinct), 1))]))
    )
    found = listed.groupBy("__i", *values).agg(
        F.sum(n).alias("__n"), F.min("__from").alias("__from"), F.max("__to").alias("__to")
    )
    return found.agg(
        F.coalesce(F.sum(n), F.lit(0).cast("long")).alias(total),
        *[F.count(values[i]).alias(f"{c}_cnt") for i, c in enumerate(distinct)],
        F.min("__from").alias("earliest"),
        F.max("__to").alias("latest"),
    )


def count_panels(df: DataFrame, panels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Counts of many panels from one scan: ``panel``, the columns of all panels, ``count``.

    ``panels`` names the columns that each panel counts by; none gives the number of rows. A
    column that a panel does not count by is null there. Rows are first combined by all the
    columns together, so that the grouping sets repeat combinations, not rows. An empty frame
    gives no counts.
    """
    keys = {p: known(df, k, used_by="count_panels", strict=True) for p, k in panels.items()}
    names = list(dict.fromkeys(c for own in keys.values() for c in own))
    cells = df.groupBy(*[column(c) for c in names]).agg(rows().alias("__n"))
    # The number that Spark gives a set has a bit for each column left out, the first the highest.
    # Panels that count by the same columns are one set, listed under each name.
    sets: dict[int, list[str]] = {}
    for panel, own in keys.items():
        left_out = sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in own)
        sets.setdefault(left_out, []).append(panel)
    if names:
        counted = cells.groupingSets(
            [[column(c) for c in keys[same[0]]] for same in sets.values()], *[column(c) for c in names]
        ).agg(
            F.grouping_id().alias("__set"),
            F.sum("__n").alias("count"),
        )
    else:
        counted = cells.where("__n > 0").select(F.lit(0).alias("__set"), F.col("__n").alias("count"))
    label = F.element_at(
        F.create_map(*[x for number, same in sets.items() for x in (F.lit(number).cast("long"), F.array(*[F.lit(p) for p in same]))]),
        F.col("__set").cast("long"),
    )
    return counted.select(F.explode(label).alias("panel"), *[column(c) for c in names], "count")


def panel_counts(counts: DataFrame, panels: Mapping[str, Sequence[str]], panel: str) -> DataFrame:
    """The counts of one panel of ``count_panels`` by its own columns."""
    keys = known(counts, panels[panel], used_by="panel_counts", strict=True)
    return counts.where(F.col("panel") == panel).select(*[column(c) for c in keys], "count")


def count_by(
    df: DataFrame, keys: str | Sequence[str], *, order: str | None = "key", name: str = "count"
) -> DataFrame:
    """Rows per key, ordered by ``key``, by ``count`` (descending) or not at all (None)."""
    names = [keys] if isinstance(keys, str) else list(keys)
    columns = [column(k) for k in names]
    counts = df.groupBy(*columns).agg(rows().alias(name))
    if order is None:
        return counts
    return counts.orderBy(*([F.desc(name)] if order == "count" else []), *columns)


def crosstab(
    df: DataFrame, row: str, col: str, values: Sequence | None = None
) -> DataFrame:
    """Counts of ``row`` x ``col`` with 0 for empty cells; rows with a null in either are left out.

    Give the ``values`` of ``col`` where they are known: otherwise Spark first has to
    find them, and it refuses more than ``spark.sql.pivotMaxValues``.
    """
    complete = df.where(column(row).isNotNull() & column(col).isNotNull())
    counts = complete.groupBy(column(row), column(col)).agg(rows().alias("n"))
    wide = counts.groupBy(column(row)).pivot(col, list(values) if values is not None else None)
    return wide.agg(F.sum("n")).fillna(0)


def shares(df: DataFrame, key: str, within: str | None = None) -> DataFrame:
    """Count per key and its share in percent, of all rows or of the rows of its group.

    Totals come from the counts, not from the rows, and are joined or read as one number,
    so that no window has to gather all groups in one task.
    """
    if within is None:
        counts = df.groupBy(column(key)).agg(rows().alias("count"))
        total = counts.agg(F.sum("count").alias("total")).scalar()
        return counts.withColumn("share", percent(F.col("count"), total))
    counts = df.groupBy(column(within), column(key)).agg(rows().alias("count"))
    totals = counts.groupBy(column(within).alias("__group")).agg(F.sum("count").alias("__total"))
    return (
        counts.join(totals, column(within).eqNullSafe(F.col("__group")), "inner")
        .withColumn("share", percent(F.col("count"), F.col("__total")))
        .drop("__group", "__total")
    )


def monthly_trend(df: DataFrame, date: str) -> DataFrame:
    month = F.date_trunc("month", column(date)).alias("month")
    return df.groupBy(month).agg(rows().alias("count")).orderBy("month")


def top_k(df: DataFrame, key: str, k: int, *, skip_null: bool = True) -> DataFrame:
    """The ``k`` most frequent values; equal counts are ordered by value.

    Spark turns order and limit into a per-task top-k, so no full sort takes place.
    """
    chosen = df.where(column(key).isNotNull()) if skip_null else df
    counts = chosen.groupBy(column(key)).agg(rows().alias("count"))
    return counts.orderBy(F.desc("count"), column(key)).limit(k)


# --- completeness ----------------------------------------------------------------------


def _filled(df: DataFrame, name: str, empty_is_missing: bool) -> Column:
    value = column(name)
    if empty_is_missing and df.schema[name].dataType.typeName() == "string":
        return value.isNotNull() & (value != "")
    return value.isNotNull()


def _rate(df: DataFrame, name: str, empty_is_missing: bool = False) -> Column:
    return percent(F.count_if(_filled(df, name, empty_is_missing)), rows(), 1)


def completeness(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Share of non-null values per field in percent (one decimal), one row per field."""
    names = known(df, fields, used_by="completeness", strict=True)
    wide = df.agg(*[_rate(df, c).alias(f"f{i}") for i, c in enumerate(names)])
    cells = [
        F.struct(F.lit(c).alias("field"), F.col(f"f{i}").alias("completeness"))
        for i, c in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*cells))).withColumn(
        "band", coverage_band(F.col("completeness"))
    )


def quality_by_group(
    df: DataFrame, group: str, fields: Sequence[str], date: str, total: str = "total_tickets"
) -> DataFrame:
    """Per group: rows, completeness of the fields, first and last date."""
    return (
        df.groupBy(column(group))
        .agg(
            rows().alias(total),
            *[_rate(df, c).alias(f"{c}_%") for c in fields],
            F.min(column(date)).alias("earliest_ticket"),
            F.max(column(date)).alias("latest_ticket"),
        )
        .orderBy(column(group))
    )


def field_inventory(
    df: DataFrame, fields: Sequence[tuple[str, str]], group: str, groups: Sequence[str]
) -> DataFrame:
    """Per field: description and coverage per group; empty text counts as missing.

    One aggregate over the whole frame, whatever the number of fields; a group without
    rows has coverage 0.
    """
    names = known(df, [f for f, _ in fields], used_by="field_inventory", strict=True)
    wide = (
        df.where(column(group).isin(list(groups)))
        .groupBy(column(group).alias("__group"))
        .agg(*[_rate(df, c, True).alias(f"f{i}") for i, c in enumerate(names)])
    )
    cells = [
        F.struct(
            F.lit(c).alias("field"), F.lit(text).alias("description"), F.col(f"f{i}").alias("rate")
        )
        for i, (c, (_, text)) in enumerate(zip(names, fields, strict=True))
    ]
    # The aggregate over no rows keeps every field in the result when no group has rows.
    blank = df.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("__group"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("field"),
                        F.lit(text).alias("description"),
                        F.lit(0.0).alias("rate"),
                    )
                    for c, (_, text) in zip(names, fields, strict=True)
                ]
            )
        ),
    )
    long = wide.select(F.col("__group").cast("string").alias("__group"), F.inline(F.array(*cells)))
    return (
        long.unionByName(blank)
        .groupBy("field", "description")
        .agg(
            *[
                F.coalesce(F.max(F.when(F.col("__group") == g, F.col("rate"))), F.lit(0.0)).alias(
                    f"{g} Coverage %"
                )
                for g in groups
            ]
        )
    )


def field_states(df: DataFrame, name: str) -> DataFrame:
    """One row: how often the field has real content, is empty text, or is null."""
    value = column(name)
    real, empty, null = value.isNotNull() & (value != ""), value == "", value.isNull()
    return df.agg(
        F.count_if(real).alias("real"),
        F.count_if(empty).alias("empty"),
        F.count_if(null).alias("null"),
    )


def counted_ratio(df: DataFrame, condition: Column) -> DataFrame:
    """One row: rows that meet the condition, all rows, and the ratio in percent."""
    return df.agg(F.count_if(condition).alias("matching"), rows().alias("total")).withColumn(
        "ratio", percent(F.col("matching"), F.col("total"), 1)
    )
