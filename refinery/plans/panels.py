"""The figures behind the reporting panels over a gold tickets frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions.columns import column
from refinery.operators.aggregate import (
    completeness,
    count_by,
    count_panels,
    counted_ratio,
    crosstab,
    dataset_summary,
    field_inventory,
    field_states,
    monthly_trend,
    quality_by_group,
    shares,
    top_k,
)

# Fields whose completeness a group panel shows.
COMPLETENESS_FIELDS = (
    "category",
    "subcategory",
    "priority",
    "urgency",
    "ticket_status",
    "country_program",
    "job_title",
)
# The audited silver fields; each is described by its name in plain words.
AUDITED_FIELDS = (
    "ticket_id", "created_date", "OC", "business", "domain", "country_program", "category", "subcategory",
    "priority", "urgency", "status", "ticket_status", "caller_email", "caller_name", "job_title",
    "country_program_extract",
)
FIELD_DESCRIPTIONS = tuple((name, name.replace("_", " ")) for name in AUDITED_FIELDS)


def overview(gold: DataFrame) -> DataFrame:
    return dataset_summary(
        gold, ["OC", "country_program", "category", "subcategory"], "created_date"
    )


#: The count panels, and what their shares are taken of.
COUNT_PANELS = {
    "tickets": (),
    "volume": ("OC",),
    "status": ("OC", "ticket_status"),
    "priority": ("priority", "OC"),
    "subcategories": ("OC", "subcategory"),
    "countries": ("OC", "country_program"),
    "urgency_by_priority": ("OC", "urgency", "priority"),
    "trend": ("OC", "month"),
}


def counts_at_once(gold: DataFrame, panels: Mapping[str, Sequence[str]] = COUNT_PANELS) -> DataFrame:
    """All count panels, totals included, from one scan; ``month`` is that of the creation."""
    by_month = gold.withColumn("month", F.date_trunc("month", "created_date"))
    return count_panels(by_month, panels)


def comparison(gold: DataFrame, centres: Sequence[str]) -> dict[str, DataFrame]:
    """Side by side: volume with share, status split, priority and urgency per centre."""
    return {
        "volume": shares(gold, "OC"),
        "status": shares(gold.where(F.col("ticket_status").isNotNull()), "ticket_status", "OC"),
        "status_table": crosstab(gold, "OC", "ticket_status", ["Closed", "Open"]),
        "priority": crosstab(gold, "priority", "OC", centres),
        "urgency": crosstab(gold, "urgency", "OC", centres),
    }


def deep_dive(
    gold: DataFrame,
    centre: str,
    priorities: Sequence[str] | None = None,
    *,
    subcategories: int = 10,
    countries: int = 15,
) -> dict[str, DataFrame]:
    """One centre: trend, top lists, urgency x priority, completeness, coverage."""
    own = gold.where(F.col("OC") == centre)
    return {
        "trend": monthly_trend(own, "created_date"),
        "top_subcategories": top_k(own, "subcategory", subcategories),
        "top_countries": top_k(own, "country_program", countries),
        "urgency_by_priority": crosstab(own, "urgency", "priority", priorities),
        "completeness": completeness(own, COMPLETENESS_FIELDS),
        "with_country": counted_ratio(own, F.col("country_program").isNotNull()),
    }


def quality_summary(gold: DataFrame) -> DataFrame:
    return quality_by_group(
        gold, "OC", ["country_program", "priority", "subcategory"], "created_date"
    )


def filled_values(gold: DataFrame, centre: str, field: str) -> DataFrame:
    """Counts of the non-empty values of a field in one centre, most frequent first, with shares."""
    value = column(field)
    own = gold.where((F.col("OC") == centre) & value.isNotNull() & (value != ""))
    return shares(own, field).orderBy(F.desc("count"), field)


def job_titles(gold: DataFrame, centre: str) -> dict[str, DataFrame]:
    return {
        "values": filled_values(gold, centre, "job_title"),
        "states": field_states(gold, "job_title"),
        "volume": count_by(gold, "OC"),
    }


def inventory(silver: DataFrame, centres: Sequence[str]) -> DataFrame:
    return field_inventory(silver, FIELD_DESCRIPTIONS, "OC", centres)
