"""Whole flows over the test tables: files to bronze to silver to gold, through tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from refinery.operators.clean import structural_clean
from refinery.operators.profile import profile_metrics
from refinery.plans import incidents, kpis, supply
from refinery.queries import literal_rows, new_table, query, table
from refinery.queries.enrichment import (
    SETTINGS,
    SILVER_SQL,
    raw_incidents,
    raw_persons,
    raw_services,
    without_zone,
)
from refinery.queries.profiling import rounded
from refinery.queries.reporting import PRODUCT_SQL, money
from refinery.queries.standins import TRANSACTIONS_SQL, transactions
from refinery.sinks.staging import new_folder
from refinery.sinks.tables import append, publish_view, upsert_table
from refinery.sources.datasets import Dataset
from refinery.sources.files import csv_to_bronze

def _put_pages(rows, path):
    """A page per line, added to the landing folder."""
    pages = rows.select(F.concat(F.lit('{"results":['), "raw_json", F.lit("]}")).alias("value"))
    pages.write.mode("append").text(path)


def _landed(spark, folder):
    """Incidents, persons and services as landed pages, one page per line, then as bronze."""
    state = new_table(spark, "state")
    names = {n: new_table(spark, n) for n in ("incidents", "persons", "services")}
    sources = {"incidents": raw_incidents, "persons": raw_persons, "services": raw_services}
    for name, build in sources.items():
        path = new_folder(spark, f"pages-{name}")
        _put_pages(build(spark, folder), path)
        field = "modificationDate" if name == "incidents" else None
        spec = Dataset(name, "desk", path, "NEXT", names[name], field)
        incidents.land_dataset(spark, spec, state, page_per_line=True)
    return names, state


@query("""
SELECT COUNT(*) AS records, MAX(o_orderdate + INTERVAL 1 DAY + to_milliseconds(o_orderkey)) AS mark
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def flow_landing(spark, folder):
    """Pages to bronze: all records, and the mark that was kept."""
    names, state = _landed(spark, folder)
    mark = spark.table(state).where("endpoint = 'incidents'").agg(F.max("last_run").alias("mark"))
    counts = spark.table(names["incidents"]).agg(F.count(F.lit(1)).alias("records"))
    return counts.select("records", mark.scalar().cast("timestamp_ntz").alias("mark"))


def _half(half):
    return f"o_custkey % 2 = {half}"


@query(f"""
SELECT 1 AS run, COUNT(*) AS records, COUNT(*) AS in_table FROM orders JOIN customer ON o_custkey = c_custkey WHERE {_half(0)}
UNION ALL
SELECT 2, COUNT(*) FILTER ({_half(1)}), COUNT(*) FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL
SELECT 3, 0, COUNT(*) FROM orders JOIN customer ON o_custkey = c_custkey
""")
def flow_landing_twice(spark, folder):
    """A folder that grows, landed by its ledger: each run takes the new files, the last finds none.

    The dataset has no incremental field, so nothing but the ledger keeps old records out.
    """
    state, ledger, bronze = (new_table(spark, n) for n in ("state", "ledger", "bronze"))
    path = new_folder(spark, "pages-growing")
    spec = Dataset("incidents", "desk", path, "NEXT", bronze, None)
    runs = []
    for run, half in enumerate((0, 1, None), 1):
        if half is not None:
            _put_pages(raw_incidents(spark, folder, _half(half)), path)
        written, _ = incidents.land_dataset(spark, spec, state, ledger=ledger, page_per_line=True)
        runs.append((run, written, spark.table(bronze).count()))
    return literal_rows(spark, runs, "run int, records bigint, in_table bigint")


@query("""
SELECT get AS load, COUNT(*) AS records, COUNT(DISTINCT o_orderkey) AS distinct_records
FROM orders JOIN customer ON o_custkey = c_custkey, (VALUES ('first'), ('full')) AS loads(get) GROUP BY get
""")
def flow_full_reload(spark, folder):
    """A full load replaces what earlier loads have written, whatever the ledger holds."""
    state, ledger, bronze = (new_table(spark, n) for n in ("state", "ledger", "bronze"))
    path = new_folder(spark, "pages-full")
    _put_pages(raw_incidents(spark, folder), path)
    spec = Dataset("incidents", "desk", path, "NEXT", bronze, "modificationDate")
    found = []
    for load in ("first", "full"):
        incidents.land_dataset(spark, spec, state, ledger=ledger, full_load=load == "full", page_per_line=True)
        held = spark.table(bronze).agg(F.count("*").alias("records"), F.count_distinct("raw_json").alias("distinct_records")).first()
        found.append((load, held["records"], held["distinct_records"]))
    return literal_rows(spark, found, "load string, records bigint, distinct_records bigint")


@query(f"WITH {SILVER_SQL} SELECT * FROM silver")
def flow_silver(spark, folder):
    """Pages to bronze to the gated silver table, with all shipped rules and all 17 columns."""
    names, state = _landed(spark, folder)
    tables = incidents.IncidentTables(
        **names,
        silver=new_table(spark, "silver"),
        state=state,
        report=new_table(spark, "report"),
        quarantine=new_table(spark, "quarantine"),
    )
    incidents.load_silver(spark, tables, SETTINGS)
    return without_zone(spark.table(tables.silver).select(*incidents.SILVER_COLUMNS))


@query(f"""
WITH {SILVER_SQL}
SELECT ticket_id, "OC", country_program, ticket_status, urgency, created_date, priority, category,
       subcategory, job_title
FROM silver
""")
def gold_view(spark, folder):
    """The ten columns of the reporting view over silver tickets in a table."""
    tickets = incidents.silver_tickets(
        raw_incidents(spark, folder),
        raw_persons(spark, folder),
        raw_services(spark, folder),
        SETTINGS,
    )
    name = new_table(spark, "silver")
    upsert_table(tickets, name, ["ticket_id"], "modification_ts", partition_by=["OC"])
    view = publish_view(
        spark.table(name), incidents.GOLD_COLUMNS, f"gold_{uuid.uuid4().hex}"
    )
    return without_zone(view)


SUPPLY_SCHEMA = (
    "`Product type` STRING, `Revenue generated` DOUBLE, `Manufacturing costs` DOUBLE, "
    "`Shipping costs` DOUBLE, `Stock levels` INT, `Line` STRING"
)


def _supply_csv(spark, folder):
    """The transaction stand-in as CSV with spaces in the header and a number per line, so
    that only repeated landings are copies."""
    rows = transactions(spark, folder)
    path = new_folder(spark, "supply-csv")
    spaced = [c.capitalize().replace("_", " ") for c in rows.columns]
    rows.toDF(*spaced).withColumn("Line", F.monotonically_increasing_id()).write.csv(path, header=True)
    return path


@query(f"WITH {TRANSACTIONS_SQL} {PRODUCT_SQL}")
def flow_supply_kpi(spark, folder):
    """CSV to bronze, landed twice, cleaned to silver, published as a KPI table."""
    supply.setup(spark, ["queries"])
    bronze = new_table(spark, "supply")
    path = _supply_csv(spark, folder)
    for _ in range(2):
        append(csv_to_bronze(spark, path, "queries", SUPPLY_SCHEMA), bronze)
    config = {
        "trim_columns": ["product_type"],
        "required_columns": ["product_type", "revenue_generated"],
        "dedup_exclude_columns": ["_ingest_ts", "_source_file", "_env"],
        "range_rules": {"revenue_generated": [0, None]},
    }
    silver, _ = supply.load_silver(spark, bronze, "queries", config, {"duplicate_keys": ["line"]})
    return money(kpis.product_profit(spark.table(silver)))


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, NULLIF(l_tax, 0) AS l_tax FROM lineitem),
both_layers AS (
  SELECT 'bronze' AS dataset, * FROM l
  UNION ALL SELECT DISTINCT 'silver', * FROM l WHERE l_tax IS NOT NULL),
d AS (SELECT dataset, l_orderkey, COUNT(*) AS copies FROM both_layers GROUP BY ALL)
SELECT dataset, 'null_rate' AS metric_type, 'l_tax_null_pct' AS "column",
       ROUND(COUNT(*) FILTER (l_tax IS NULL) / COUNT(*), 6) AS metric_value
FROM both_layers GROUP BY dataset
UNION ALL SELECT dataset, 'duplicate_key_groups', 'l_orderkey', CAST(COUNT(*) FILTER (copies > 1) AS DOUBLE)
FROM d GROUP BY dataset
UNION ALL SELECT dataset, 'duplicate_rows', 'l_orderkey', CAST(SUM(copies - 1) AS DOUBLE) FROM d GROUP BY dataset
UNION ALL SELECT dataset, 'duplicate_row_pct', 'l_orderkey', ROUND(SUM(copies - 1) / SUM(copies), 4)
FROM d GROUP BY dataset
""")
def profile_before_after(spark, folder):
    """The same profile before and after cleaning."""
    bronze = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_tax", F.lit(0.0)).alias("l_tax")
    )
    silver, _ = structural_clean(bronze, {"required_columns": ["l_tax"]})
    config = {"null_rate_cols": ["l_tax"], "duplicate_keys": ["l_orderkey"]}
    both = profile_metrics(bronze, "bronze", config).unionByName(
        profile_metrics(silver, "silver", config)
    )
    return rounded(both.drop("run_ts"))
