"""The seven KPIs kept by batch: what a batch adds is stored, older transactions are not read again.

A state has a row per batch and product with the sums that the KPIs are made of. Sums of sums are
the sums of all rows, so ratios are taken when the KPIs are read. A batch, usually a day of
ingestion, is a partition of the state table: running it again replaces it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.plans.kpis import PRODUCT
from refinery.sinks.tables import overwrite_partitions, publish_table, replace_table, schema_name, table_exists

# Sums of a state, by what they add up.
_SUMS = {
    "revenue": "revenue_generated",
    "cost": "manufacturing_costs + shipping_costs",
    "shipping": "shipping_costs",
    "inventory": "stock_levels * manufacturing_costs",
}


def kpi_state(transactions: DataFrame, batch: str) -> DataFrame:
    """What one batch adds, one row per product, and a row without product or rows, by which a
    batch that has become empty replaces its former self."""
    in_time = F.count_if(F.col("shipping_times") <= F.col("lead_time"))
    sums = [F.sum(F.expr(value).cast("double")).alias(name) for name, value in _SUMS.items()]
    found = transactions.groupBy(F.col(PRODUCT).cast("string").alias(PRODUCT)).agg(
        *sums, in_time.alias("on_time"), F.count(F.lit(1)).alias("rows")
    )
    blank = transactions.sparkSession.range(1).select(
        *[F.lit(None if t in ("string", "double") else 0).cast(t).alias(n) for n, t in found.dtypes]
    )
    return found.unionByName(blank).withColumn("batch", F.lit(batch))


def add_to_kpis(transactions: DataFrame, state_table: str, batch: str) -> None:
    """Store what the batch adds in place of what it added before. Other batches are not touched."""
    state = kpi_state(transactions, batch)
    if table_exists(transactions.sparkSession, state_table):
        overwrite_partitions(state, state_table)
    else:
        replace_table(state, state_table, "Sums of the KPIs by batch", partition_by=["batch"])


def _totals(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in [*_SUMS, "on_time", "rows"]])


def kpis_of(states: DataFrame) -> dict[str, DataFrame]:
    """The KPI tables by name, equal to those of ``plans.kpis`` over all transactions."""
    company = _totals(states, [])
    products = _totals(states, [PRODUCT]).where("rows > 0")
    profit = [
        F.col("revenue").alias("total_revenue"),
        F.col("cost").alias("total_cost"),
        (F.col("revenue") - F.col("cost")).alias("profit"),
        F.try_divide(F.col("revenue") - F.col("cost"), F.col("revenue")).alias("profit_margin"),
    ]
    shipping = F.try_divide("shipping", "revenue")
    on_time = F.try_divide("on_time", F.nullif("rows", F.lit(0))).alias("on_time_delivery_rate")
    return {
        "company_profit_kpi": company.select(*profit),
        "product_profit_kpi": products.select(PRODUCT, *profit).orderBy(F.desc("profit_margin"), PRODUCT),
        "inventory_efficient_kpi": products.select(
            PRODUCT,
            F.col("inventory").alias("inventory_value"),
            F.col("revenue").alias("sales_value"),
            F.try_divide("inventory", "revenue").alias("inventory_efficiency"),
        ).orderBy(F.desc("inventory_efficiency"), PRODUCT),
        "shipping_cost_impact_kpi": company.select(
            F.col("revenue").alias("total_revenue"),
            F.col("shipping").alias("total_shipping_costs"),
            shipping.alias("shipping_cost_impact"),
        ),
        "product_shipping_cost_kpi": products.select(
            PRODUCT,
            F.col("revenue").alias("total_revenue"),
            F.col("shipping").alias("total_shipping_cost"),
            shipping.alias("shipping_cost_ratio"),
        ).orderBy(F.desc("shipping_cost_ratio"), PRODUCT),
        "on_time_delivery_kpi": company.select(on_time),
        "product_on_time_delivery_kpi": products.select(PRODUCT, on_time).orderBy(
            "on_time_delivery_rate", PRODUCT
        ),
    }


def publish_kept_kpis(states: DataFrame, env: str, project: str = "supply") -> dict[str, DataFrame]:
    """Create or replace the seven KPI tables in the gold schema of ``env`` from the kept sums."""
    gold = schema_name("gold", env, project)
    return {name: publish_table(kpi, f"{gold}.{name}") for name, kpi in kpis_of(states).items()}
