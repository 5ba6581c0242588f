"""Landing, incremental load, upsert, quality tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from refinery.operators.incremental import current_marks, high_water_mark as mark_of, newer_than
from refinery.operators.raw_json import parse_raw, to_raw
from refinery.operators.upsert import merge_rows
from refinery.queries import new_table, query, table
from refinery.sinks.quality import with_resolutions
from refinery.sinks.staging import new_folder
from refinery.sinks.tables import BUCKET, append, append_evolving, keyed_rows, replace_table, upsert_table, with_bucket
from refinery.sources.files import clean_headers, csv_to_bronze, csv_to_raw, page_records

ORDER_FIELDS = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority
FROM orders
""")
def raw_json_roundtrip(spark, folder):
    """Rows to raw JSON records and back: every value survives, nulls too."""
    orders = table(spark, folder, "orders").withColumn(
        "o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW"))
    )
    return parse_raw(to_raw(orders), ORDER_FIELDS, keep=())


@query(r"""
SELECT doc_id, UNNEST(string_split(text, E'\n')) AS line FROM documents
""")
def page_envelope_explode(spark, folder):
    """Pages with their records under ``results``: one page per document, a record per line."""
    lines = F.transform(
        F.split("text", "\n"), lambda t: F.struct(F.col("doc_id"), t.alias("line"))
    )
    pages = table(spark, folder, "documents").select(
        F.to_json(F.struct(lines.alias("results"), F.lit("more").alias("next"))).alias("value")
    )
    return parse_raw(page_records(pages, ["$.results"]), "doc_id BIGINT, line STRING", keep=())


@query("""
SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def page_envelope_list_or_results(spark, folder):
    """Pages that are a bare list or an object with ``results``; unknown fields survive."""
    props = F.from_json("props", "k INT").alias("props")
    rows = F.array(F.struct("event_id", "user_id", "event_type", props))
    wrapped = F.to_json(F.struct(rows.alias("results")))
    pages = table(spark, folder, "events").select(
        F.when(F.col("event_type") == "click", wrapped).otherwise(F.to_json(rows)).alias("value")
    )
    parsed = parse_raw(
        page_records(pages, ["$.results", "$"]),
        "event_id BIGINT, user_id BIGINT, event_type STRING, props STRUCT<k: INT>",
        keep=(),
    )
    return parsed.select("event_id", "user_id", "event_type", F.col("props.k").alias("k"))


@query("""
SELECT c_custkey AS Customer_Key, c_mktsegment AS Market_Segment, c_acctbal AS Balance FROM customer
""")
def header_normalize(spark, folder):
    return clean_headers(
        table(spark, folder, "customer").select(
            F.col("c_custkey").alias("Customer Key"),
            F.col("c_mktsegment").alias("Market Segment"),
            F.col("c_acctbal").alias("Balance"),
        )
    )


CSV_SCHEMA = "`Order Key` BIGINT, `Order Status` STRING, `Total Price` DOUBLE, `Priority` STRING"


def orders_as_csv(spark, folder):
    """Orders written as CSV files with spaces in the header and empty cells."""
    path = new_folder(spark, "orders-csv")
    table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("Order Key"),
        F.col("o_orderstatus").alias("Order Status"),
        F.col("o_totalprice").alias("Total Price"),
        F.nullif("o_orderpriority", F.lit("2-HIGH")).alias("Priority"),
    ).write.csv(path, header=True)
    return path


@query("""
SELECT o_orderkey AS Order_Key, o_orderstatus AS Order_Status, o_totalprice AS Total_Price,
       NULLIF(o_orderpriority, '2-HIGH') AS Priority, TRUE AS from_csv, TRUE AS timed, 'dev' AS _env
FROM orders
""")
def csv_bronze(spark, folder):
    """CSV scan with clean headers, source file, ingestion time and environment, appended to a table."""
    bronze = csv_to_bronze(spark, orders_as_csv(spark, folder), "dev", CSV_SCHEMA)
    name = new_table(spark, "bronze")
    append(bronze, name, rows_per_file=1_000_000)
    return spark.table(name).select(
        "Order_Key",
        "Order_Status",
        "Total_Price",
        "Priority",
        F.endswith("_source_file", F.lit(".csv")).alias("from_csv"),
        F.col("_ingest_ts").isNotNull().alias("timed"),
        "_env",
    )


@query("""
SELECT o_orderkey AS order_key, o_orderstatus AS order_status,
       NULLIF(o_orderpriority, '2-HIGH') AS priority, o_orderpriority = '2-HIGH' AS null_is_written
FROM orders
""")
def csv_raw_records(spark, folder):
    """CSV rows as raw JSON records; an empty cell is a JSON null, not a missing field."""
    raw = csv_to_raw(spark, orders_as_csv(spark, folder), CSV_SCHEMA)
    written = F.contains("raw_json", F.lit('"Priority":null')).alias("null_is_written")
    parsed = parse_raw(
        raw.select("raw_json", written), CSV_SCHEMA, keep=("null_is_written",)
    )
    return parsed.select(
        F.col("Order Key").alias("order_key"),
        F.col("Order Status").alias("order_status"),
        F.col("Priority").alias("priority"),
        "null_is_written",
    )


@query("SELECT event_id, ts, user_id FROM events WHERE ts > TIMESTAMP '2024-01-02 12:00:00'")
def incremental_filter(spark, folder):
    """Strictly newer than the mark; the comparison reaches the Parquet reader."""
    events = table(spark, folder, "events").select("event_id", "ts", "user_id")
    return newer_than(events, "ts", datetime(2024, 1, 2, 12))


@query("SELECT MAX(ts) AS last_run FROM events")
def high_water_mark(spark, folder):
    return mark_of(table(spark, folder, "events"), "ts")


@query("""
SELECT event_type AS pipeline, CAST(user_id AS VARCHAR) AS endpoint, MAX(ts) AS last_run
FROM events GROUP BY ALL
""")
def state_latest_marks(spark, folder):
    """The newest mark per pipeline and endpoint in an append-only state table."""
    state = table(spark, folder, "events").select(
        F.col("event_type").alias("pipeline"),
        F.col("user_id").cast("string").alias("endpoint"),
        F.col("ts").alias("last_run"),
        F.col("ts").alias("updated_at"),
    )
    return current_marks(state)


def pages_and_labels(spark, folder):
    """Target and updates with keys on both sides, on the left only and on the right only."""
    pages = table(spark, folder, "pages").select(
        F.col("page_id").alias("id"), F.col("url").alias("note"), F.lit(-1).alias("score")
    )
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("id"), F.lit("label").alias("note"), F.col("quality").alias("score")
    )
    return pages, labels


UPSERT_SQL = """
SELECT page_id AS id, url AS note, -1 AS score FROM pages
WHERE page_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'label', quality FROM labels
"""


@query(UPSERT_SQL)
def upsert_merge(spark, folder):
    pages, labels = pages_and_labels(spark, folder)
    return merge_rows(pages, labels, ["id"])


@query(UPSERT_SQL)
def upsert_table_replaced(spark, folder):
    """Through tables: create, upsert, and the same upsert again, which changes nothing."""
    pages, labels = pages_and_labels(spark, folder)
    name = new_table(spark, "keyed")
    for rows in (pages, labels, labels):
        upsert_table(rows, name, ["id"])
    return keyed_rows(spark, name)


@query(UPSERT_SQL)
def upsert_table_bucketed(spark, folder):
    """The same on a table partitioned by key hash, where only touched partitions are rewritten."""
    pages, labels = pages_and_labels(spark, folder)
    name = new_table(spark, "bucketed")
    for rows in (pages, labels):
        upsert_table(with_bucket(rows, ["id"], 4), name, ["id", BUCKET], partition_by=[BUCKET])
    return keyed_rows(spark, name)


@query("""
SELECT o_orderkey AS id, o_orderpriority AS place, CAST(o_custkey AS BIGINT) AS amount, NULL AS note FROM orders
WHERE o_orderkey % 3 <> 0 AND NOT (o_orderpriority = '1-URGENT')
UNION ALL
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN '2-HIGH' ELSE o_orderpriority END,
       CAST(o_custkey AS BIGINT) + 1, o_orderstatus FROM orders
WHERE o_orderkey % 3 = 0 OR o_orderpriority = '1-URGENT'
""")
def upsert_partitioned(spark, folder):
    """A table partitioned by a plain column: rows change, move to another partition and empty one."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("place"),
        F.col("o_custkey").cast("long").alias("amount"), "o_orderstatus",
    )
    name = new_table(spark, "partitioned")
    upsert_table(orders.drop("o_orderstatus"), name, ["id"], partition_by=["place"])
    changed = orders.where("id % 3 = 0 or place = '1-URGENT'").select(
        "id", F.when(F.col("place") == "1-URGENT", F.lit("2-HIGH")).otherwise(F.col("place")).alias("place"),
        (F.col("amount") + 1).alias("amount"), F.col("o_orderstatus").alias("note"),
    )
    upsert_table(changed, name, ["id"])
    return spark.table(name)


@query("""
SELECT s_suppkey AS id, s_nationkey % 4 AS place,
       CASE WHEN s_suppkey % 5 = 0 THEN 3000000000 + s_suppkey ELSE CAST(s_nationkey AS BIGINT) END AS amount,
       'partitioned' AS layout FROM supplier
UNION ALL
SELECT s_suppkey, s_nationkey % 4,
       CASE WHEN s_suppkey % 5 = 0 THEN 3000000000 + s_suppkey ELSE CAST(s_nationkey AS BIGINT) END,
       'plain' FROM supplier
""")
def upsert_wider_type(spark, folder):
    """Updates of a wider type than the table's, in both layouts."""
    start = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.pmod("s_nationkey", F.lit(4)).alias("place"), F.col("s_nationkey").cast("int").alias("amount")
    )
    wide = start.where("id % 5 = 0").withColumn("amount", F.lit(3_000_000_000) + F.col("id"))
    found = []
    for layout, parts in (("plain", []), ("partitioned", ["place"])):
        name = new_table(spark, "wider")
        upsert_table(start, name, ["id"], partition_by=parts)
        upsert_table(wide, name, ["id"])
        found.append(spark.table(name).select("id", "place", "amount", F.lit(layout).alias("layout")))
    return found[0].unionByName(found[1])


@query("""
WITH u AS (SELECT l_orderkey AS id, MAX(l_shipdate) AS version, 'line' AS origin
           FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS id, COALESCE(u.version, o_orderdate) AS version, COALESCE(origin, 'order') AS origin
FROM orders LEFT JOIN u ON o_orderkey = id AND u.version >= o_orderdate
""")
def upsert_version_guard(spark, folder):
    """An update that is older than the row it would replace is left out."""
    target = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("version"),
        F.lit("order").alias("origin"),
    )
    updates = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_shipdate").alias("version"),
        F.lit("line").alias("origin"),
    )
    return merge_rows(target, updates, ["id"], version="version")


@query("""
SELECT c_custkey AS id, c_mktsegment AS label, NULL::DOUBLE AS amount, NULL AS _type_conflicts FROM customer
UNION ALL
SELECT s_suppkey, NULL, s_acctbal, '{"label":' || s_nationkey || '}' FROM supplier
""")
def append_schema_evolution(spark, folder):
    """A second source with a new column and one of another type: nothing is lost."""
    name = new_table(spark, "evolving")
    append_evolving(
        table(spark, folder, "customer").select(
            F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("label")
        ),
        name,
    )
    append_evolving(
        table(spark, folder, "supplier").select(
            F.col("s_suppkey").alias("id"),
            F.col("s_nationkey").alias("label"),
            F.col("s_acctbal").alias("amount"),
        ),
        name,
    )
    return spark.table(name)


@query("""
SELECT c_custkey AS id, c_mktsegment AS segment, NULL::DOUBLE AS balance, NULL AS tag, c_nationkey AS code,
       NULL AS label, NULL AS _type_conflicts FROM customer
UNION ALL
SELECT s_suppkey, NULL, s_acctbal, s_name, NULL, 'n' || s_nationkey,
       '{"info":{"segment":' || s_suppkey || '},"places":[{"code":"x' || s_nationkey || '"}]}' FROM supplier
""")
def append_nested_field(spark, folder):
    """New fields inside a struct and inside an array of structs; the one type that clashes is kept as JSON."""
    name = new_table(spark, "nested")
    append_evolving(
        table(spark, folder, "customer").select(
            F.col("c_custkey").alias("id"),
            F.struct(F.col("c_mktsegment").alias("segment")).alias("info"),
            F.array(F.struct(F.col("c_nationkey").alias("code"))).alias("places"),
        ),
        name,
    )
    append_evolving(
        table(spark, folder, "supplier").select(
            F.col("s_suppkey").alias("id"),
            F.struct(
                F.col("s_acctbal").alias("balance"), F.array("s_name").alias("tags"), F.col("s_suppkey").alias("segment")
            ).alias("info"),
            F.array(F.struct(F.concat(F.lit("x"), "s_nationkey").alias("code"), F.concat(F.lit("n"), "s_nationkey").alias("label"))).alias("places"),
        ),
        name,
    )
    return spark.table(name).select(
        "id", "info.segment", "info.balance", F.get("info.tags", F.lit(0)).alias("tag"),
        F.col("places")[0]["code"].alias("code"), F.col("places")[0]["label"].alias("label"), "_type_conflicts",
    )


@query("SELECT s_suppkey, s_name, s_acctbal + 1 AS s_acctbal FROM supplier")
def table_full_refresh(spark, folder):
    """A table is overwritten from a query that reads the table itself."""
    name = new_table(spark, "refreshed")
    replace_table(table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal"), name)
    replace_table(spark.table(name).withColumn("s_acctbal", F.col("s_acctbal") + 1), name)
    return spark.table(name)


@query("""
WITH r AS (
  SELECT event_type AS rule_id, user_id AS run_id, MAX(ts) AS resolved_at,
         arg_max(event_id, ts) AS note
  FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL)
SELECT event_id, event_type AS rule_id, user_id AS run_id, r.rule_id IS NOT NULL AS resolved,
       r.resolved_at, CAST(r.note AS VARCHAR) AS resolved_note
FROM events e LEFT JOIN r ON e.event_type = r.rule_id AND e.user_id = r.run_id
""")
def quarantine_resolution(spark, folder):
    """Resolutions are separate rows; the latest per run and rule decides the state."""
    events = table(spark, folder, "events")
    quarantine = events.select(
        "event_id",
        F.col("event_type").alias("rule_id"),
        F.col("user_id").alias("run_id"),
        F.lit(False).alias("resolved"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit(None).cast("string").alias("resolved_note"),
    )
    resolutions = events.where(F.col("event_type").isin("click", "view")).select(
        F.col("event_type").alias("rule_id"),
        F.col("user_id").alias("run_id"),
        F.col("ts").alias("resolved_at"),
        F.col("event_id").cast("string").alias("resolved_note"),
    )
    return with_resolutions(quarantine, resolutions)
