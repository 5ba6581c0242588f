"""What runs lead to: gates, refusals, second runs, reports, merged profiles."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from refinery.operators.profile import cardinality
from refinery.operators.profile_state import STATE_DDL, profile_of, profile_state
from refinery.operators.rules import summarise
from refinery.operators.validate import ValidationFailed, close_gate, run_validation
from refinery.plans import incidents
from refinery.plans.kpi_state import add_to_kpis, kpis_of
from refinery.plans.quality import QualityGateClosed
from refinery.queries import literal_rows, new_table, query, table
from refinery.queries.enrichment import SETTINGS, SILVER_SQL, raw_incidents, raw_persons, raw_services, without_zone
from refinery.queries.flows import _half, _put_pages
from refinery.queries.rules import RUN, rule
from refinery.queries.validation import PEOPLE_SQL, RULES, people
from refinery.sinks.staging import new_folder
from refinery.sinks.tables import append, ensure_table, publish_table_view, table_exists
from refinery.sources.datasets import Dataset


def _desk(spark, folder):
    """Empty tables of the flow, a function that lands rows by the ledger, and lookups in bronze."""
    labels = ("incidents", "persons", "services", "silver", "state", "report", "quarantine")
    tables = incidents.IncidentTables(**{n: new_table(spark, n) for n in labels})
    ledger, marks = new_table(spark, "ledger"), new_table(spark, "landing_state")
    folders = {n: new_folder(spark, f"pages-{n}") for n in labels[:3]}

    def land(name, rows, field=None):
        _put_pages(rows, folders[name])
        spec = Dataset(name, "desk", folders[name], "NEXT", getattr(tables, name), field)
        return incidents.land_dataset(spark, spec, marks, ledger=ledger, page_per_line=True)

    land("persons", raw_persons(spark, folder))
    land("services", raw_services(spark, folder))
    return tables, land


@query(f"WITH {SILVER_SQL} SELECT * FROM silver")
def flow_silver_second_run(spark, folder):
    """Silver after two runs: the second starts from the stored mark and takes the new half only."""
    tables, land = _desk(spark, folder)
    for half in (0, 1):
        land("incidents", raw_incidents(spark, folder, _half(half)))
        incidents.load_silver(spark, tables, SETTINGS)
    if incidents.load_silver(spark, tables, SETTINGS) is not None:
        raise AssertionError("nothing was new")
    return without_zone(spark.table(tables.silver).select(*incidents.SILVER_COLUMNS))


@query(f"""
WITH {SILVER_SQL}
SELECT COUNT(*) > 0 AS closed, COUNT(*) AS quarantined, FALSE AS silver_exists, 0::BIGINT AS marks
FROM silver WHERE status = 'Waiting for Supplier'
""")
def flow_gate_closed(spark, folder):
    """A status that the map does not know: the gate closes, records go to quarantine, no mark moves."""
    tables, land = _desk(spark, folder)
    land("incidents", raw_incidents(spark, folder))
    known = {k: v for k, v in SETTINGS.status_map.items() if k != "Waiting for Supplier"}
    closed = False
    try:
        incidents.load_silver(spark, tables, replace(SETTINGS, status_map=known))
    except QualityGateClosed:
        closed = True
    held = spark.table(tables.quarantine).agg(F.count("*").alias("quarantined"))
    marks = spark.table(tables.state).agg(F.count("*").alias("marks"))
    return held.select(
        F.lit(closed).alias("closed"), "quarantined", F.lit(table_exists(spark, tables.silver)).alias("silver_exists"), marks.scalar().alias("marks")
    )


@query(f"WITH {SILVER_SQL} SELECT * FROM silver")
def flow_silver_by_lookups(spark, folder):
    """Silver from persons and services that are kept in bucketed lookup tables over two runs."""
    tables, land = _desk(spark, folder)
    tables = replace(tables, person_lookup=new_table(spark, "person_lookup"), service_lookup=new_table(spark, "service_lookup"))
    for half in (0, 1):
        land("incidents", raw_incidents(spark, folder, _half(half)))
        incidents.load_silver(spark, tables, SETTINGS)
    return without_zone(spark.table(tables.silver).select(*incidents.SILVER_COLUMNS))


@query("SELECT n_nationkey, n_name FROM nation")
def gold_catalog_view(spark, folder):
    """A catalog view over a column list of a table."""
    name = new_table(spark, "nations")
    append(table(spark, folder, "nation"), name)
    return publish_table_view(spark, name, ["N_NationKey", "n_name"], new_table(spark, "view"))


@query("""
SELECT kind AS rule_type, kind = 'range' AS accepted, CASE WHEN kind = 'range' THEN failed END AS failed_records
FROM (SELECT COUNT(*) FILTER (o_totalprice < 50000) AS failed FROM orders), (VALUES ('range'), ('between'), ('UNIQUE')) AS kinds(kind)
""")
def dq_unknown_rule_type(spark, folder):
    """A rule of a type that is not known is refused before any job; the same rule as a range runs."""
    orders, found = table(spark, folder, "orders"), []
    for kind in ("range", "between", "UNIQUE"):
        try:
            row = summarise(orders, [rule("price", "o_totalprice", kind, min=50_000)], RUN).first()
            found.append((kind, True, row["failed_records"]))
        except ValueError as refused:
            found.append((kind, "unknown rule_type" not in str(refused), None))
    return literal_rows(spark, found, "rule_type string, accepted boolean, failed_records bigint")


@query("""
SELECT 'dated' AS rule_id, COUNT(*) AS total_records, COUNT(*) FILTER (ok) AS passed_records,
       COUNT(*) FILTER (NOT ok) AS failed_records, COUNT(*) FILTER (ok IS NULL) AS unknown_records
FROM (SELECT l_receiptdate < l_shipdate + INTERVAL 20 DAY AND NULLIF(l_tax, 0) < 0.07 AS ok FROM (
  SELECT *, l_shipdate + to_days(CAST(l_linenumber * 5 AS INTEGER)) AS l_receiptdate FROM lineitem))
""")
def dq_custom_sql_failing(spark, folder):
    """An expression over several columns that some records fail and for some is unknown."""
    lines = table(spark, folder, "lineitem").withColumns(
        {"l_receiptdate": F.col("l_shipdate") + F.make_dt_interval(F.col("l_linenumber") * 5), "l_tax": F.nullif("l_tax", F.lit(0.0))}
    )
    checked = rule("dated", "l_receiptdate", "custom_sql", expression="l_receiptdate < l_shipdate + INTERVAL 20 DAY AND l_tax < 0.07")
    names = ["rule_id", "total_records", "passed_records", "failed_records", "unknown_records"]
    return summarise(lines, [checked], RUN).select(*names)


@query(f"""
WITH {PEOPLE_SQL},
f AS (SELECT COUNT(*) AS n FROM (
  SELECT c_custkey FROM p WHERE c_mktsegment IS NULL
  UNION ALL SELECT c_custkey FROM p WHERE c_name LIKE '% %'
  UNION ALL SELECT c_custkey FROM p WHERE NOT regexp_matches(c_name, '^Customer#[0-9]*[1-4]$')
  UNION ALL SELECT c_custkey FROM p WHERE upper(trim(padded)) NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD'))),
b AS (SELECT COUNT(*) AS n FROM (SELECT padded FROM p GROUP BY padded HAVING COUNT(DISTINCT c_mktsegment) > 1)),
s AS (SELECT 'field' AS section, n FROM f UNION ALL SELECT 'business', n FROM b UNION ALL SELECT 'reference', NULL)
SELECT section, CASE WHEN section = 'reference' THEN 'SKIPPED' ELSE 'SUCCESS' END AS status,
       n AS violations, 'VALIDATION_FAILED' AS final_status, TRUE AS gate_closed FROM s
""")
def validation_report(spark, folder):
    """All validators in one report, a section each, and the gate that it closes."""
    config = {
        "field_rules": {"string_rules": RULES},
        "business_rules": {"functional_dependencies": {"padded": "c_mktsegment"}},
    }
    report = run_validation(people(spark, folder), config, ["c_custkey"])
    closed = False
    try:
        close_gate(report, "prod")
    except ValidationFailed:
        closed = True
    found = []
    for section in ("field", "business", "reference"):
        result = report[section]["result"]
        violations = result["metrics"]["violations_count"] if result else None
        found.append((section, report[section]["status"], violations, report["final_status"], closed))
    return literal_rows(spark, found, "section string, status string, violations bigint, final_status string, gate_closed boolean")


@query("""
SELECT COUNT(DISTINCT o_custkey) > 0 AS custkey_close, COUNT(DISTINCT o_orderpriority) > 0 AS priority_close FROM orders
""")
def profile_cardinality_close(spark, folder):
    """The approximate counts lie within a tenth of the exact ones."""
    orders, names = table(spark, folder, "orders"), ["o_custkey", "o_orderpriority"]
    found = cardinality(orders, names)
    for n in names:
        exact = orders.agg(F.count_distinct(n).alias("exact")).scalar()
        close = F.abs(F.col(f"{n}_distinct_count") - exact) <= 0.1 * exact
        found = found.withColumn(f"{n.split('_')[1].removeprefix('order')}_close", close)
    return found.select("custkey_close", "priority_close")


def _merged_sql(name, number):
    return f"""
SELECT '{name}' AS "column", COUNT(*) AS rows, COUNT(*) - COUNT({name}) AS nulls, COUNT(DISTINCT {name}) > 0 AS distinct_close,
       MIN({number}) AS low, MAX({number}) AS high, ROUND(AVG({number}), 4) AS avg, ROUND(STDDEV({number}), 4) AS stddev
FROM l"""


@query(
    "WITH l AS (SELECT *, NULLIF(l_tax, 0) AS tax FROM lineitem)"
    + " UNION ALL ".join(
        _merged_sql(n, e)
        for n, e in (
            ("l_orderkey", "CAST(l_orderkey AS DOUBLE)"), ("l_quantity", "CAST(l_quantity AS DOUBLE)"), ("tax", "tax"),
            ("l_returnflag", "NULL::DOUBLE"), ("l_shipdate", "CAST(epoch(l_shipdate) AS DOUBLE)"),
        )
    )
)
def profile_merged(spark, folder):
    """States of five batches, appended to a table and merged there, against a profile of all rows."""
    lines = table(spark, folder, "lineitem").withColumn("tax", F.nullif("l_tax", F.lit(0.0)))
    names = ["l_orderkey", "l_quantity", "tax", "l_returnflag", "l_shipdate"]
    states = new_table(spark, "profile_states")
    ensure_table(spark, states, STATE_DDL, "Profile states of batches")
    for batch in range(5):
        profile_state(lines.where(F.col("l_linenumber") % 5 == batch), names, f"batch {batch}").write.insertInto(states)
    whole = lines.agg(*[F.count_distinct(n).alias(n) for n in names])
    exact = whole.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("exact")) for n in names])))
    found = profile_of(spark.table(states)).join(F.broadcast(exact), "column")  # a row per column
    return found.select(
        "column", "rows", "nulls", (F.abs(F.col("distinct_count") - F.col("exact")) <= 0.05 * F.col("exact") + 1).alias("distinct_close"),
        "low", "high", F.round("avg", 4).alias("avg"), F.round("stddev", 4).alias("stddev"),
    )


_KEPT = (
    ("company_profit_kpi", "(r - c) / r", "NULL"), ("product_profit_kpi", "(r - c) / r", "NOT NULL"),
    ("inventory_efficient_kpi", "i / r", "NOT NULL"), ("shipping_cost_impact_kpi", "s / r", "NULL"),
    ("product_shipping_cost_kpi", "s / r", "NOT NULL"), ("on_time_delivery_kpi", "t", "NULL"),
    ("product_on_time_delivery_kpi", "t", "NOT NULL"),
)


@query(
    """
WITH tx AS (
  SELECT p_type AS product_type, l_extendedprice * (1 - l_discount) AS revenue, l_extendedprice * NULLIF(l_tax, 0) AS shipping,
         p_retailprice * l_quantity * 0.6::DOUBLE AS making, p_size AS stock,
         CASE WHEN l_tax > 0 AND date_diff('day', o_orderdate, l_shipdate) <= 30 THEN 1 ELSE 0 END AS in_time
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
sums AS (
  SELECT product_type, SUM(revenue) AS r, SUM(making + shipping) AS c, SUM(shipping) AS s, SUM(stock * making) AS i, AVG(in_time) AS t
  FROM tx GROUP BY GROUPING SETS ((product_type), ()))
"""
    + " UNION ALL ".join(
        f"SELECT '{name}' AS kpi, product_type, ROUND({value}, 6) AS value FROM sums WHERE product_type IS {test}"
        for name, value, test in _KEPT
    )
)
def kpi_after_two_batches(spark, folder):
    """The seven KPIs from kept sums: one batch lands, another in part and then once more as a whole."""
    line, part, orders = (table(spark, folder, n) for n in ("lineitem", "part", "orders"))
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.select(
        F.col("l_linenumber").alias("number"),
        F.col("p_type").alias("product_type"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue_generated"),
        (F.col("p_retailprice") * F.col("l_quantity") * 0.6).alias("manufacturing_costs"),
        (F.col("l_extendedprice") * F.nullif("l_tax", F.lit(0.0))).alias("shipping_costs"),
        F.col("p_size").alias("stock_levels"),
        F.date_diff("l_shipdate", "o_orderdate").alias("shipping_times"),
        F.when(F.col("l_tax") > 0, F.lit(30)).alias("lead_time"),
    )
    states = new_table(spark, "kpi_states")
    for batch, chosen in (("a", "number <= 2"), ("b", "number = 4"), ("b", "number > 2")):
        add_to_kpis(rows.where(chosen), states, batch)
    found = None
    for name, kpi in kpis_of(spark.table(states)).items():
        product = F.col("product_type") if "product_type" in kpi.columns else F.lit(None).cast("string")
        shown = kpi.select(F.lit(name).alias("kpi"), product.alias("product_type"), F.round(kpi.columns[-1], 6).alias("value"))
        found = shown if found is None else found.unionByName(shown)
    return found
