"""Supply KPIs over a transactions frame, and the dashboard datasets over the KPI tables.

Columns used: product_type, revenue_generated, manufacturing_costs, shipping_costs,
stock_levels, shipping_times, lead_time (any spelling of case).
A ratio with a zero denominator is null. A row where either cost is null adds no cost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.sinks.tables import publish_table, schema_name

PRODUCT = "product_type"


def _revenue() -> Column:
    return F.sum("revenue_generated")


def _cost() -> Column:
    return F.sum(F.col("manufacturing_costs") + F.col("shipping_costs"))


def _with_profit(totals: DataFrame) -> DataFrame:
    profit = F.col("total_revenue") - F.col("total_cost")
    return totals.withColumns(
        {"profit": profit, "profit_margin": F.try_divide(profit, F.col("total_revenue"))}
    )


def company_profit(transactions: DataFrame) -> DataFrame:
    totals = transactions.agg(_revenue().alias("total_revenue"), _cost().alias("total_cost"))
    return _with_profit(totals)


def product_profit(transactions: DataFrame) -> DataFrame:
    totals = transactions.groupBy(PRODUCT).agg(
        _revenue().alias("total_revenue"), _cost().alias("total_cost")
    )
    return _with_profit(totals).orderBy(F.desc("profit_margin"), PRODUCT)


def inventory_efficiency(transactions: DataFrame) -> DataFrame:
    value = F.sum(F.col("stock_levels") * F.col("manufacturing_costs"))
    return (
        transactions.groupBy(PRODUCT)
        .agg(value.alias("inventory_value"), _revenue().alias("sales_value"))
        .withColumn("inventory_efficiency", F.try_divide("inventory_value", "sales_value"))
        .orderBy(F.desc("inventory_efficiency"), PRODUCT)
    )


def shipping_cost_impact(transactions: DataFrame) -> DataFrame:
    return transactions.agg(
        _revenue().alias("total_revenue"), F.sum("shipping_costs").alias("total_shipping_costs")
    ).withColumn("shipping_cost_impact", F.try_divide("total_shipping_costs", "total_revenue"))


def product_shipping_cost(transactions: DataFrame) -> DataFrame:
    return (
        transactions.groupBy(PRODUCT)
        .agg(
            _revenue().alias("total_revenue"),
            F.sum("shipping_costs").alias("total_shipping_cost"),
        )
        .withColumn("shipping_cost_ratio", F.try_divide("total_shipping_cost", "total_revenue"))
        .orderBy(F.desc("shipping_cost_ratio"), PRODUCT)
    )


def _on_time_rate() -> Column:
    """A delivery whose times are unknown counts as late."""
    on_time = F.col("shipping_times") <= F.col("lead_time")
    return F.avg(F.when(on_time, 1).otherwise(0)).alias("on_time_delivery_rate")


def on_time_delivery(transactions: DataFrame) -> DataFrame:
    return transactions.agg(_on_time_rate())


def product_on_time_delivery(transactions: DataFrame) -> DataFrame:
    return (
        transactions.groupBy(PRODUCT)
        .agg(_on_time_rate())
        .orderBy("on_time_delivery_rate", PRODUCT)
    )


KPI_TABLES = {
    "company_profit_kpi": company_profit,
    "product_profit_kpi": product_profit,
    "inventory_efficient_kpi": inventory_efficiency,
    "shipping_cost_impact_kpi": shipping_cost_impact,
    "product_shipping_cost_kpi": product_shipping_cost,
    "on_time_delivery_kpi": on_time_delivery,
    "product_on_time_delivery_kpi": product_on_time_delivery,
}


def publish_kpis(transactions: DataFrame, env: str, project: str = "supply") -> dict[str, DataFrame]:
    """Create or replace the seven KPI tables in the gold schema of ``env``."""
    gold = schema_name("gold", env, project)
    return {
        name: publish_table(build(transactions), f"{gold}.{name}")
        for name, build in KPI_TABLES.items()
    }


# Dashboard dataset -> (KPI table, columns shown)
DASHBOARD = {
    "company_profit_and_loss": (
        "company_profit_kpi",
        ("total_revenue", "total_cost", "profit", "profit_margin"),
    ),
    "product_performance": ("product_profit_kpi", (PRODUCT, "profit")),
    "product_efficiency": ("inventory_efficient_kpi", (PRODUCT, "inventory_efficiency")),
    "shipping_cost_analysis": ("product_shipping_cost_kpi", (PRODUCT, "shipping_cost_ratio")),
    "delivery_performance": ("product_on_time_delivery_kpi", (PRODUCT, "on_time_delivery_rate")),
}


def dashboard_datasets(kpis: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The dashboard datasets whose KPI table is given."""
    return {
        name: kpis[table].select(*shown)
        for name, (table, shown) in DASHBOARD.items()
        if table in kpis
    }


def profit_counter(company: DataFrame) -> DataFrame:
    """The counter of the dashboard: total profit and margin (the table has one row)."""
    return company.agg(
        F.sum("profit").alias("profit"), F.sum("profit_margin").alias("profit_margin")
    )


def profit_by_product(products: DataFrame) -> DataFrame:
    """The bars of the dashboard, largest profit first."""
    return (
        products.groupBy(PRODUCT)
        .agg(F.sum("profit").alias("profit"))
        .orderBy(F.desc("profit"), PRODUCT)
    )
