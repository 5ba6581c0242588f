"""Gold aggregates over the ticket stand-in, KPIs over the transaction stand-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from refinery.functions.expressions import coverage_band as band_of, percent
from refinery.operators.aggregate import (
    completeness,
    count_by,
    counted_ratio,
    crosstab,
    dataset_summary as summary_of,
    field_inventory as inventory_of,
    field_states,
    monthly_trend as trend_of,
    quality_by_group,
    shares,
    top_k as most_frequent,
)
from refinery.plans import kpis
from refinery.plans.panels import COUNT_PANELS, counts_at_once, filled_values
from refinery.queries import query
from refinery.queries.profiling import rounded
from refinery.queries.standins import (
    CENTRES,
    DELIVERIES_SQL,
    PRIORITIES,
    TICKETS_SQL,
    TRANSACTIONS_SQL,
    deliveries,
    tickets,
    transactions,
)


def ticket_sql(sql):
    return query(f"WITH {TICKETS_SQL} {sql}")


@ticket_sql("""
SELECT COUNT(*) AS total, COUNT(DISTINCT "OC") AS "OC_cnt",
       COUNT(DISTINCT country_program) AS country_program_cnt,
       COUNT(DISTINCT category) AS category_cnt, COUNT(DISTINCT subcategory) AS subcategory_cnt,
       MIN(created_date) AS earliest, MAX(created_date) AS latest
FROM tickets
""")
def dataset_summary(spark, folder):
    return summary_of(
        tickets(spark, folder),
        ["OC", "country_program", "category", "subcategory"],
        "created_date",
    )


@ticket_sql('SELECT "OC", COUNT(*) AS count FROM tickets GROUP BY ALL')
def count_by_group(spark, folder):
    return count_by(tickets(spark, folder), "OC")


@ticket_sql('SELECT "OC", priority, COUNT(*) AS count FROM tickets GROUP BY ALL')
def count_by_two_keys(spark, folder):
    return count_by(tickets(spark, folder), ["OC", "priority"], order="count")


def _cells(column, values):
    return ", ".join(f"""COUNT(*) FILTER ({column} = '{v}') AS "{v}" """ for v in values)


@ticket_sql(f"""
SELECT "OC", {_cells('ticket_status', ['Closed', 'Open'])}
FROM tickets WHERE ticket_status IS NOT NULL GROUP BY ALL
""")
def crosstab_status(spark, folder):
    """Unmapped statuses are left out and get no column."""
    return crosstab(tickets(spark, folder), "OC", "ticket_status", ["Closed", "Open"])


@ticket_sql(f"""
SELECT priority, {_cells('"OC"', CENTRES)}
FROM tickets WHERE priority IS NOT NULL AND "OC" IS NOT NULL GROUP BY ALL
""")
def crosstab_priority_group(spark, folder):
    """The columns are found in the data."""
    return crosstab(tickets(spark, folder), "priority", "OC")


@ticket_sql(f"""
SELECT subcategory, {_cells('priority', PRIORITIES)}
FROM tickets WHERE priority IS NOT NULL AND "OC" = 'BUILDING' GROUP BY ALL
""")
def crosstab_one_group(spark, folder):
    own = tickets(spark, folder).where(F.col("OC") == "BUILDING")
    return crosstab(own, "subcategory", "priority", PRIORITIES)


@ticket_sql("""
SELECT "OC", COUNT(*) AS count, ROUND(COUNT(*) / (SELECT COUNT(*) FROM tickets) * 100, 6) AS share
FROM tickets GROUP BY ALL
""")
def share_of_total(spark, folder):
    return rounded(shares(tickets(spark, folder), "OC"))


@ticket_sql("""
SELECT "OC", ticket_status, COUNT(*) AS count,
       ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY "OC") * 100, 6) AS share
FROM tickets GROUP BY "OC", ticket_status
""")
def share_within_group(spark, folder):
    return rounded(shares(tickets(spark, folder), "ticket_status", "OC"))


@ticket_sql("""
SELECT CAST(date_trunc('month', created_date) AS TIMESTAMP) AS month, COUNT(*) AS count
FROM tickets WHERE "OC" = 'BUILDING' GROUP BY ALL
""")
def monthly_trend(spark, folder):
    own = tickets(spark, folder).where(F.col("OC") == "BUILDING")
    return trend_of(own, "created_date").withColumn("month", F.col("month").cast("timestamp_ntz"))


# The stand-in has no urgency; its status takes that place.
PANELS = COUNT_PANELS | {"urgency_by_priority": ("OC", "status", "priority")}
_PANEL_KEYS = list(dict.fromkeys(c for keys in PANELS.values() for c in keys))


def _panel_sql(panel, keys):
    cells = ", ".join(f'{"" if c in keys else "NULL AS "}"{c}"' for c in _PANEL_KEYS)
    return f"SELECT '{panel}' AS panel, {cells}, COUNT(*) AS count FROM dated GROUP BY ALL"


@ticket_sql(
    ", dated AS (SELECT *, CAST(date_trunc('month', created_date) AS TIMESTAMP) AS month FROM tickets) "
    + " UNION ALL ".join(_panel_sql(p, k) for p, k in PANELS.items())
)
def panels_one_scan(spark, folder):
    """Every count panel as grouping sets over the combinations that occur."""
    return counts_at_once(tickets(spark, folder), PANELS).withColumn("month", F.col("month").cast("timestamp_ntz"))


FIELDS = ["category", "subcategory", "priority", "ticket_status", "country_program", "job_title"]


def _band(rate):
    return f"CASE WHEN {rate} >= 80 THEN 'good' WHEN {rate} >= 50 THEN 'medium' ELSE 'poor' END"


@ticket_sql(
    "SELECT field, completeness, "
    + _band("completeness")
    + " AS band FROM ("
    + " UNION ALL ".join(
        f"SELECT '{f}' AS field, ROUND(COUNT({f}) / COUNT(*) * 100, 1) AS completeness "
        "FROM tickets WHERE \"OC\" = 'MACHINERY'"
        for f in FIELDS
    )
    + ")"
)
def completeness_by_group(spark, folder):
    """Per field of one group, with its coverage band."""
    return completeness(tickets(spark, folder).where(F.col("OC") == "MACHINERY"), FIELDS)


@ticket_sql("""
SELECT "OC", COUNT(*) AS total_tickets,
       ROUND(COUNT(country_program) / COUNT(*) * 100, 1) AS "country_program_%",
       ROUND(COUNT(priority) / COUNT(*) * 100, 1) AS "priority_%",
       ROUND(COUNT(subcategory) / COUNT(*) * 100, 1) AS "subcategory_%",
       MIN(created_date) AS earliest_ticket, MAX(created_date) AS latest_ticket
FROM tickets GROUP BY "OC"
""")
def dq_summary_by_group(spark, folder):
    return quality_by_group(
        tickets(spark, folder), "OC", ["country_program", "priority", "subcategory"], "created_date"
    )


AUDITED = ["ticket_id", "created_date", "OC", *FIELDS, "status"]


def _coverage(field, group):
    filled = f"{field} IS NOT NULL"
    if field not in ("ticket_id", "created_date"):
        filled += f" AND {field} <> ''"
    inside = f"\"OC\" = '{group}'"
    return (
        f"COALESCE(ROUND(COUNT(*) FILTER ({inside} AND {filled}) "
        f'/ NULLIF(COUNT(*) FILTER ({inside}), 0) * 100, 1), 0.0) AS "{group} Coverage %"'
    )


@ticket_sql(
    " UNION ALL ".join(
        f"SELECT '{f}' AS field, 'about {f}' AS description, "
        + ", ".join(_coverage(f, g) for g in ("BUILDING", "HOUSEHOLD", "NOWHERE"))
        + " FROM tickets"
        for f in AUDITED
    )
)
def field_inventory(spark, folder):
    """Empty text is missing; a group without rows has 0. One job for all fields."""
    return inventory_of(
        tickets(spark, folder),
        [(f, f"about {f}") for f in AUDITED],
        "OC",
        ["BUILDING", "HOUSEHOLD", "NOWHERE"],
    )


@ticket_sql("""
SELECT COUNT(*) FILTER (job_title <> '') AS "real", COUNT(*) FILTER (job_title = '') AS empty,
       COUNT(*) FILTER (job_title IS NULL) AS "null"
FROM tickets
""")
def field_state_split(spark, folder):
    return field_states(tickets(spark, folder), "job_title")


@ticket_sql("""
SELECT job_title, COUNT(*) AS count,
       ROUND(COUNT(*) / SUM(COUNT(*)) OVER () * 100, 6) AS share
FROM tickets WHERE "OC" = 'BUILDING' AND job_title <> '' GROUP BY job_title
""")
def filled_value_shares(spark, folder):
    return rounded(filled_values(tickets(spark, folder), "BUILDING", "job_title"))


@ticket_sql("""
SELECT COUNT(*) FILTER (country_program IS NOT NULL) AS matching, COUNT(*) AS total,
       ROUND(COUNT(*) FILTER (country_program IS NOT NULL) / COUNT(*) * 100, 1) AS ratio
FROM tickets WHERE "OC" = 'HOUSEHOLD'
""")
def rows_with_field(spark, folder):
    own = tickets(spark, folder).where(F.col("OC") == "HOUSEHOLD")
    return counted_ratio(own, F.col("country_program").isNotNull())


@ticket_sql("""
SELECT r.band, COUNT(*) AS groups FROM (
  SELECT subcategory, CASE WHEN rate >= 80 THEN 'good' WHEN rate >= 50 THEN 'medium' ELSE 'poor' END AS band
  FROM (SELECT subcategory, COUNT(*) FILTER (ticket_status IS NOT NULL) / COUNT(*) * 100 AS rate
        FROM tickets GROUP BY ALL)) r
GROUP BY ALL
""")
def coverage_band(spark, folder):
    """Groups per coverage band of one field."""
    rate = percent(F.count("ticket_status"), F.count(F.lit(1)))
    rates = tickets(spark, folder).groupBy("subcategory").agg(band_of(rate).alias("band"))
    return rates.groupBy("band").agg(F.count(F.lit(1)).alias("groups"))


@ticket_sql("""
SELECT subcategory, COUNT(*) AS count FROM tickets WHERE "OC" = 'BUILDING' AND subcategory IS NOT NULL
GROUP BY ALL ORDER BY count DESC, subcategory LIMIT 10
""")
def top_k(spark, folder):
    return most_frequent(
        tickets(spark, folder).where(F.col("OC") == "BUILDING"), "subcategory", 10
    )


# --- KPIs ------------------------------------------------------------------------------


def tx_sql(sql, source=TRANSACTIONS_SQL):
    return query(f"WITH {source} {sql}")


def money(df):
    """Amounts to cents, ratios to six digits."""
    ratios = {"profit_margin", "inventory_efficiency", "shipping_cost_impact", "shipping_cost_ratio"}
    return df.select(
        *[
            F.round(c, 6 if c in ratios else 2).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


PROFIT = """
SUM(revenue_generated) AS revenue, SUM(manufacturing_costs + shipping_costs) AS cost
"""
COMPANY_SQL = f"""
SELECT ROUND(revenue, 2) AS total_revenue, ROUND(cost, 2) AS total_cost,
       ROUND(revenue - cost, 2) AS profit, ROUND((revenue - cost) / NULLIF(revenue, 0), 6) AS profit_margin
FROM (SELECT {PROFIT} FROM tx)"""
PRODUCT_SQL = f"""
SELECT product_type, ROUND(revenue, 2) AS total_revenue, ROUND(cost, 2) AS total_cost,
       ROUND(revenue - cost, 2) AS profit, ROUND((revenue - cost) / NULLIF(revenue, 0), 6) AS profit_margin
FROM (SELECT product_type, {PROFIT} FROM tx GROUP BY product_type)"""


@tx_sql(COMPANY_SQL)
def kpi_company_profit(spark, folder):
    return money(kpis.company_profit(transactions(spark, folder)))


@tx_sql(PRODUCT_SQL)
def kpi_product_profit(spark, folder):
    return money(kpis.product_profit(transactions(spark, folder)))


INVENTORY_SQL = """
SELECT product_type, ROUND(v, 2) AS inventory_value, ROUND(s, 2) AS sales_value,
       ROUND(v / NULLIF(s, 0), 6) AS inventory_efficiency
FROM (SELECT product_type, SUM(stock_levels * manufacturing_costs) AS v,
             SUM(revenue_generated) AS s FROM tx GROUP BY product_type)
"""


@tx_sql(INVENTORY_SQL)
def kpi_inventory_efficiency(spark, folder):
    return money(kpis.inventory_efficiency(transactions(spark, folder)))


@tx_sql("""
SELECT ROUND(r, 2) AS total_revenue, ROUND(s, 2) AS total_shipping_costs,
       ROUND(s / NULLIF(r, 0), 6) AS shipping_cost_impact
FROM (SELECT SUM(revenue_generated) AS r, SUM(shipping_costs) AS s FROM tx)
""")
def kpi_shipping_impact(spark, folder):
    return money(kpis.shipping_cost_impact(transactions(spark, folder)))


SHIPPING_SQL = """
SELECT product_type, ROUND(r, 2) AS total_revenue, ROUND(s, 2) AS total_shipping_cost,
       ROUND(s / NULLIF(r, 0), 6) AS shipping_cost_ratio
FROM (SELECT product_type, SUM(revenue_generated) AS r, SUM(shipping_costs) AS s
      FROM tx GROUP BY product_type)
"""


@tx_sql(SHIPPING_SQL)
def kpi_product_shipping(spark, folder):
    return money(kpis.product_shipping_cost(transactions(spark, folder)))


@tx_sql("""
SELECT ROUND(AVG(CASE WHEN shipping_times <= lead_time THEN 1 ELSE 0 END), 6) AS on_time_delivery_rate
FROM tx
""", DELIVERIES_SQL)
def kpi_on_time(spark, folder):
    """A delivery with an unknown time is late."""
    return rounded(kpis.on_time_delivery(deliveries(spark, folder)))


ON_TIME_SQL = """
SELECT product_type,
       ROUND(AVG(CASE WHEN shipping_times <= lead_time THEN 1 ELSE 0 END), 6) AS on_time_delivery_rate
FROM tx GROUP BY product_type
"""


@tx_sql(ON_TIME_SQL, DELIVERIES_SQL)
def kpi_product_on_time(spark, folder):
    return rounded(kpis.product_on_time_delivery(deliveries(spark, folder)))


# --- dashboard -------------------------------------------------------------------------


def shown(dataset, frame):
    """A dashboard dataset over the KPI frame it belongs to."""
    kpi_table, _ = kpis.DASHBOARD[dataset]
    return kpis.dashboard_datasets({kpi_table: kpis.KPI_TABLES[kpi_table](frame)})[dataset]


@tx_sql(f"SELECT total_revenue, total_cost, profit, profit_margin FROM ({COMPANY_SQL})")
def dashboard_company(spark, folder):
    return money(shown("company_profit_and_loss", transactions(spark, folder)))


@tx_sql(f"SELECT product_type, profit FROM ({PRODUCT_SQL})")
def dashboard_products(spark, folder):
    return money(shown("product_performance", transactions(spark, folder)))


@tx_sql(f"SELECT product_type, inventory_efficiency FROM ({INVENTORY_SQL})")
def dashboard_efficiency(spark, folder):
    return money(shown("product_efficiency", transactions(spark, folder)))


@tx_sql(f"SELECT product_type, shipping_cost_ratio FROM ({SHIPPING_SQL})")
def dashboard_shipping(spark, folder):
    return money(shown("shipping_cost_analysis", transactions(spark, folder)))


@tx_sql(f"SELECT product_type, on_time_delivery_rate FROM ({ON_TIME_SQL})", DELIVERIES_SQL)
def dashboard_delivery(spark, folder):
    return rounded(shown("delivery_performance", deliveries(spark, folder)))


@tx_sql(f"SELECT SUM(profit) AS profit, SUM(profit_margin) AS profit_margin FROM ({COMPANY_SQL})")
def dashboard_profit_counter(spark, folder):
    return money(kpis.profit_counter(kpis.company_profit(transactions(spark, folder))))


@tx_sql(f"SELECT product_type, SUM(profit) AS profit FROM ({PRODUCT_SQL}) GROUP BY ALL")
def dashboard_profit_by_product(spark, folder):
    return money(kpis.profit_by_product(kpis.product_profit(transactions(spark, folder))))
