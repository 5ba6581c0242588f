"""Ticket and transaction frames made from the shared tables, in Spark and in SQL.

The tables hold no nulls, so both forms make them with NULLIF.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.functions.expressions import map_values
from refinery.queries import table

CENTRES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
STATUSES = {"O": "Open", "F": "Closed"}


def tickets(spark: SparkSession, folder: str) -> DataFrame:
    """orders left join customer; centre = market segment, two statuses mapped, one not."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    rows = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
    status = F.col("o_orderstatus")
    return rows.select(
        F.col("o_orderkey").alias("ticket_id"),
        F.col("o_orderdate").alias("created_date"),
        F.col("c_mktsegment").alias("OC"),
        F.when(F.col("c_nationkey") >= 5, F.concat(F.lit("C"), "c_nationkey")).alias(
            "country_program"
        ),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority"),
        F.concat("c_mktsegment", F.lit("/"), "o_orderstatus").alias("category"),
        F.concat(F.lit("S"), "c_nationkey").alias("subcategory"),
        status.alias("status"),
        map_values(status, STATUSES).alias("ticket_status"),
        F.when(F.col("c_acctbal") < 0, F.lit(""))
        .when(F.col("c_acctbal") > 1000, F.concat(F.lit("T"), F.substring("c_name", -1, 1)))
        .alias("job_title"),
    )


TICKETS_SQL = """
tickets AS (
  SELECT o_orderkey AS ticket_id, o_orderdate AS created_date, c_mktsegment AS "OC",
         CASE WHEN c_nationkey >= 5 THEN 'C' || c_nationkey END AS country_program,
         NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS priority,
         c_mktsegment || '/' || o_orderstatus AS category,
         'S' || c_nationkey AS subcategory,
         o_orderstatus AS status,
         CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Closed' END AS ticket_status,
         CASE WHEN c_acctbal < 0 THEN ''
              WHEN c_acctbal > 1000 THEN 'T' || right(c_name, 1) END AS job_title
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
"""


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem join part, with the columns the product and cost KPIs use."""
    line, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    return line.join(part, line["l_partkey"] == part["p_partkey"]).select(
        F.col("p_type").alias("product_type"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue_generated"),
        (F.col("p_retailprice") * F.col("l_quantity") * 0.6).alias("manufacturing_costs"),
        (F.col("l_extendedprice") * F.nullif("l_tax", F.lit(0.0))).alias("shipping_costs"),
        F.col("p_size").alias("stock_levels"),
    )


TRANSACTIONS_SQL = """
tx AS (
  SELECT p_type AS product_type,
         l_extendedprice * (1 - l_discount) AS revenue_generated,
         p_retailprice * l_quantity * 0.6::DOUBLE AS manufacturing_costs,
         l_extendedprice * NULLIF(l_tax, 0) AS shipping_costs,
         p_size AS stock_levels
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their days since the order and an allowed time of 30 days."""
    line, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    orders = table(spark, folder, "orders")
    return (
        line.join(orders, line["l_orderkey"] == orders["o_orderkey"])
        .join(part, line["l_partkey"] == part["p_partkey"])
        .select(
            F.col("p_type").alias("product_type"),
            F.date_diff("l_shipdate", "o_orderdate").alias("shipping_times"),
            F.when(F.col("l_tax") > 0, F.lit(30)).alias("lead_time"),
        )
    )


DELIVERIES_SQL = """
tx AS (
  SELECT p_type AS product_type,
         date_diff('day', o_orderdate, l_shipdate) AS shipping_times,
         CASE WHEN l_tax > 0 THEN 30 END AS lead_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
"""
