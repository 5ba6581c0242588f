"""Raw JSON parsing, value and pattern maps, lookups, silver tickets."""

from __future__ import annotations

from pyspark.sql import functions as F

from refinery.functions.columns import column
from refinery.functions.expressions import (
    blank_to_null as nullify_blank,
    format_iso,
    map_values,
    parse_iso,
)
from refinery.operators.enrich import (
    add_first_extract,
    add_mapped,
    add_pattern_columns,
    in_scope,
    lookup,
)
from refinery.operators.raw_json import parse_raw
from refinery.plans.incidents import IncidentSettings, silver_tickets as build_silver_tickets
from refinery.queries import query, table
from refinery.queries.standins import STATUSES


@query("SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_id, ts FROM events")
def parse_raw_json(spark, folder):
    return parse_raw(
        table(spark, folder, "events"), "k INT", raw="props", keep=("event_id", "ts")
    )


@query("SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id FROM events")
def parse_raw_json_inferred(spark, folder):
    """The schema is merged from all rows, not from a sample."""
    return parse_raw(table(spark, folder, "events"), raw="props", keep=("event_id",))


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
                      ELSE CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
       CASE WHEN event_type = 'error' THEN substr(props, 1, length(props) - 1) END AS unparsed
FROM events
""")
def parse_raw_json_unparsed(spark, folder):
    """Text that is cut off gives null fields and is shown, not thrown."""
    cut = F.expr("substring(props, 1, length(props) - 1)")
    rows = table(spark, folder, "events").withColumn(
        "props", F.when(F.col("event_type") == "error", cut).otherwise(F.col("props"))
    )
    return parse_raw(rows, "k INT", raw="props", keep=("event_id",), unparsed="unparsed")


@query("""
SELECT o_orderkey, o_orderstatus,
       CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Closed' END AS ticket_status
FROM orders
""")
def status_map(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return add_mapped(rows, "o_orderstatus", "ticket_status", STATUSES)


URL_RULES = [
    {"pattern": "example.com", "site": "C", "kind": "commercial"},
    {"pattern": "/en/", "site": "E"},
    {"pattern": "example.net", "site": "N", "kind": "network"},
]


@query("""
SELECT page_id,
       CASE WHEN contains(lower(url), 'example.com') THEN 'C'
            WHEN contains(lower(url), '/en/') THEN 'E'
            WHEN contains(lower(url), 'example.net') THEN 'N' END AS site,
       CASE WHEN contains(lower(url), 'example.com') THEN 'commercial'
            WHEN contains(lower(url), '/en/') THEN NULL
            WHEN contains(lower(url), 'example.net') THEN 'network' END AS kind
FROM pages
""")
def pattern_map(spark, folder):
    """First matching pattern wins for all outputs."""
    rows = table(spark, folder, "pages").select("page_id", F.upper("url").alias("url"))
    return add_pattern_columns(rows, "url", URL_RULES, ["site", "kind"]).drop("url")


URL_PATTERNS = [r"^https?://(blog|www|m)\.", r"[?&]utm_source=([a-z]+)", r"(?i)/([A-Z]{2})/[0-9]+#"]


@query(r"""
SELECT page_id, COALESCE(NULLIF(regexp_extract(url, '^https?://(blog|www|m)\.', 1), ''),
                         NULLIF(regexp_extract(url, '[?&]utm_source=([a-z]+)', 1), ''),
                         NULLIF(regexp_extract(url, '(?i)/([A-Z]{2})/[0-9]+#', 1), '')) AS origin
FROM pages
""")
def regex_extract_fallback(spark, folder):
    rows = table(spark, folder, "pages").select("page_id", "url")
    return add_first_extract(rows, "origin", [("url", p) for p in URL_PATTERNS]).drop("url")


@query("""
SELECT conv_id, turn, NULLIF(trim(replace(role, 'user', '  ')), '') AS role FROM conversations
""")
def blank_to_null(spark, folder):
    blanked = F.replace(F.col("role"), F.lit("user"), F.lit("  "))
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", nullify_blank(blanked).alias("role")
    )


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso_seconds, ts AS parsed
FROM events
""")
def iso_timestamps(spark, folder):
    """ISO text with microseconds and with whole seconds, and back."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, folder, "events").select(
        "event_id",
        format_iso(ts).alias("iso"),
        format_iso(ts, seconds_only=True).alias("iso_seconds"),
        parse_iso(format_iso(ts)).cast("timestamp_ntz").alias("parsed"),
    )


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Closed' END AS scope
FROM orders WHERE o_orderstatus IN ('O', 'F')
""")
def scope_filter(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", map_values(column("o_orderstatus"), STATUSES).alias("scope")
    )
    return in_scope(rows, "scope")


@query("""
WITH newest AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders)
SELECT c_custkey, c_name, o_orderkey, o_orderstatus
FROM customer LEFT JOIN newest ON c_custkey = o_custkey AND rn = 1
""")
def enrich_left_dedup(spark, folder):
    """Many versions per key on the right, and still one row per fact."""
    facts = table(spark, folder, "customer").select("c_custkey", "c_name")
    versions = table(spark, folder, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus"
    )
    return lookup(facts, versions, "c_custkey", "o_custkey", "o_orderdate")


@query("""
SELECT l_orderkey, l_linenumber, NULLIF(l_suppkey, 7) AS l_suppkey, s_name, s_nationkey
FROM lineitem LEFT JOIN supplier ON NULLIF(l_suppkey, 7) = s_suppkey
""")
def enrich_left_spread(spark, folder):
    """The other way of the lookup: hot keys (and the null key) salted, nothing broadcast whole."""
    facts = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_suppkey", F.lit(7)).alias("l_suppkey")
    )
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return lookup(
        facts, suppliers, "l_suppkey", "s_suppkey", max_rows=0, hot_rows=550, copies=8
    )


# The stand-in names its categories "<segment>: orders"; a country is the host of the caller's
# mail, or else the last digit of a customer's number, if that is 5.
SETTINGS = IncidentSettings(
    category_rules=[
        dict(pattern="building:", OC="BLD", business="Construction", domain="Homes"),
        *[dict(pattern=p, OC="MEC", business="Engineering", domain="Machines") for p in ("automobile:", "machinery:")],
    ],
    country_patterns=[("caller_email", r"@nation(\d+)\.test$"), ("caller_name", r"\d(5)$")],
)
# Statuses of the raw incidents made from orders.
RAW_STATUS = {"O": "New", "F": "Closed", "P": "Waiting for Supplier"}


def raw_incidents(spark, folder, where="true"):
    """orders join customer as raw incident JSON; one incident per customer, many versions.

    Only orders that meet ``where`` are made into JSON.
    """
    rows = table(spark, folder, "orders").where(where).join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )

    def named(value, *more):
        return F.struct(*more, value.alias("name"))

    def iso(ts):
        return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'")

    nation = F.col("c_nationkey").cast("string")
    email = F.when(
        F.col("c_acctbal") > 5000, F.concat(F.lit("orders@nation"), nation, F.lit(".test"))
    ).otherwise(F.lit("orders@hq.test"))
    # Versions of an incident of one day follow each other by the order's key.
    modified = F.col("o_orderdate") + F.expr("INTERVAL 1 DAY") + F.make_dt_interval(secs=F.col("o_orderkey") / 1000)
    incident = F.struct(
        F.col("o_custkey").cast("string").alias("id"),
        named(
            F.when(F.col("c_nationkey") >= 5, F.concat(F.lit("Country "), nation)),
            nation.alias("id"),
        ).alias("object"),
        named(F.concat(F.initcap("c_mktsegment"), F.lit(": orders"))).alias("category"),
        named(F.col("o_orderpriority")).alias("subcategory"),
        F.struct(
            F.col("o_custkey").cast("string").alias("id"),
            F.col("c_name").alias("dynamicName"),
            email.alias("email"),
        ).alias("caller"),
        named(map_values(F.col("o_orderstatus"), RAW_STATUS)).alias("processingStatus"),
        named(F.col("o_orderpriority")).alias("priority"),
        named(F.col("o_orderstatus")).alias("urgency"),
        iso(F.col("o_orderdate")).alias("creationDate"),
        iso(modified).alias("modificationDate"),
    )
    return rows.select(
        F.to_json(incident).alias("raw_json"),
        F.timestamp_seconds("o_orderkey").alias("ingestion_time"),
    )


def raw_persons(spark, folder):
    title = F.when(F.col("c_acctbal") < 0, F.lit("  ")).otherwise(F.col("c_mktsegment"))
    person = F.struct(
        F.col("c_custkey").cast("string").alias("id"), title.alias("jobTitle")
    )
    return table(spark, folder, "customer").select(
        F.to_json(person).alias("raw_json"),
        F.timestamp_seconds("c_custkey").alias("ingestion_time"),
    )


def raw_services(spark, folder):
    service = F.struct(
        F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")
    )
    return table(spark, folder, "nation").select(
        F.to_json(service).alias("raw_json"),
        F.timestamp_seconds("n_nationkey").alias("ingestion_time"),
    )


SILVER_SQL = """
v AS (
  SELECT *, c_mktsegment = 'BUILDING' AS built, CAST(c_nationkey AS VARCHAR) AS nation,
         ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')),
silver AS (
  SELECT CAST(o_custkey AS VARCHAR) AS ticket_id, o_orderdate AS created_date,
         IF(built, 'BLD', 'MEC') AS "OC", IF(built, 'Construction', 'Engineering') AS business,
         IF(built, 'Homes', 'Machines') AS domain,
         IF(c_nationkey >= 5, 'Country ' || nation, NULL) AS country_program,
         o_orderpriority AS priority, o_orderstatus AS urgency,
         c_mktsegment[1] || lower(c_mktsegment[2:]) || ': orders' AS category,
         o_orderpriority AS subcategory,
         CASE o_orderstatus WHEN 'O' THEN 'New' WHEN 'F' THEN 'Closed' ELSE 'Waiting for Supplier' END AS status,
         IF(o_orderstatus = 'F', 'Closed', 'Open') AS ticket_status,
         IF(c_acctbal > 5000, 'orders@nation' || nation || '.test', 'orders@hq.test') AS caller_email,
         c_name AS caller_name,
         IF(c_acctbal >= 0, c_mktsegment, NULL) AS job_title,
         CASE WHEN c_acctbal > 5000 THEN nation WHEN suffix(c_name, '5') THEN '5' END AS country_program_extract,
         o_orderdate + INTERVAL 1 DAY + to_milliseconds(o_orderkey) AS modification_ts
  FROM v WHERE rn = 1)
"""


def without_zone(df):
    return df.withColumns(
        {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"}
    )


@query(f"WITH {SILVER_SQL} SELECT * FROM silver")
def silver_tickets(spark, folder):
    """The whole silver transformation, from raw JSON of three sources to 17 columns."""
    tickets = build_silver_tickets(
        raw_incidents(spark, folder),
        raw_persons(spark, folder),
        raw_services(spark, folder),
        SETTINGS,
    )
    return without_zone(tickets)
