"""Both flows from landed files to gold, with re-runs, closed gates and streams."""

import json
from dataclasses import replace
from datetime import UTC, datetime, timedelta

import pytest
from support import rows
from pyspark.sql import functions as F

from refinery.operators.incremental import last_mark
from refinery.operators.validate import ValidationFailed
from refinery.plans import incidents, supply
from refinery.plans.incidents import IncidentSettings, IncidentTables, land_dataset, load_silver
from refinery.plans.quality import QualityGateClosed
from refinery.sinks.tables import keyed_rows, table_exists
from refinery.sources.datasets import Dataset
from refinery.streaming.incremental import land_new_pages, upsert_new_rows

SETTINGS = IncidentSettings(
    category_rules=[
        dict(pattern="heating", OC="N", business="Homes", domain="Warmth"),
        dict(pattern="water", OC="S", business="Homes", domain="Pipes"),
    ],
    country_patterns=[("caller_email", r"@([a-z]+)\.example"), ("caller_name", r"\(([A-Z][a-z])\)$")],
)


def incident(key, modified, status="New", category="Heating and boilers", created="2024-01-01T00:00:00Z", **more):
    return {
        "id": key,
        "object": {"id": "o1", "name": "Landia"},
        "category": {"name": category} if category else None,
        "caller": {"id": "p1", "dynamicName": "Nobody (Oz)", "email": "nobody@mail.test"},
        "processingStatus": {"name": status},
        "priority": {"name": "P1"},
        "creationDate": created,
        "modificationDate": modified,
        **more,
    }


class Landing:
    """A landing folder, its tables, and short forms of the flow's steps."""

    def __init__(self, spark, new_table, folder):
        self.spark, self.folder, self.pages = spark, folder, 0
        names = ("incidents", "persons", "services", "silver", "state", "report", "quarantine")
        self.tables = IncidentTables(**{n: new_table(n) for n in names})
        self.state = new_table("ingestion_state")

    def put(self, *records, name="incidents"):
        target = self.folder / name
        target.mkdir(exist_ok=True)
        self.pages += 1
        (target / f"{self.pages}.json").write_text(json.dumps({"results": records, "next": None}))

    def land(self, name="incidents", field="modificationDate", **options):
        spec = Dataset(name, "desk", str(self.folder / name), "NEXT", getattr(self.tables, name), field)
        return land_dataset(self.spark, spec, self.state, **options)

    def silver(self, **options):
        return load_silver(self.spark, self.tables, SETTINGS, **options)

    def rows(self, *columns):
        return rows(keyed_rows(self.spark, self.tables.silver).select(*columns))


@pytest.fixture
def landing(spark, new_table, tmp_path):
    return Landing(spark, new_table, tmp_path)


@pytest.mark.parametrize("parts", [[], ["OC"]])
def test_incidents_from_pages_to_gold(spark, landing, new_table, parts):
    landing.put(
        incident("1", "2024-01-02T00:00:00Z"),
        incident("1", "2024-01-03T00:00:00Z", "Closed"),
        incident("2", None, "in  progress", "WATER pipes"),
        incident("3", "2024-01-02T00:00:00Z", category="elsewhere"),
        incident("4", "2024-01-02T00:00:00Z", category=None),
    )
    landing.put({"id": "p1", "jobTitle": " "}, name="persons")
    landing.put({"id": "p1", "jobTitle": "cook"}, {"id": "p2", "jobTitle": "x"}, name="persons")
    landing.put({"id": "o1", "name": "svc"}, {"id": "o1", "name": "svc again"}, name="services")
    assert landing.land() == (5, datetime(2024, 1, 3, tzinfo=UTC))
    assert landing.land("persons", None) == (3, None)
    assert landing.land("services", None) == (2, None)

    with pytest.raises(QualityGateClosed) as closed:
        landing.silver(partition_by=parts)
    assert closed.value.result["error_failures"] == 1  # the unmapped status has no ticket status
    assert not table_exists(spark, landing.tables.silver)
    assert last_mark(spark.table(landing.tables.state), "silver_incidents", "incidents") is None
    held = spark.table(landing.tables.quarantine)
    assert rows(held.select("rule_id", "ticket_id")) == [("incidents_ticket_status_not_null", "2")]

    # The source corrects the record; only new records are landed.
    landing.put(incident("2", "2024-02-01T00:00:00Z", "In Progress", "WATER pipes"))
    assert landing.land() == (1, datetime(2024, 2, 1, tzinfo=UTC))
    assert landing.silver(partition_by=parts)["passed"]
    assert landing.rows("ticket_id", "OC", "ticket_status", "country_program_extract") == [
        ("1", "N", "Closed", "Oz"),
        ("2", "S", "Open", "Oz"),
    ]
    assert landing.rows("job_title")[0][0] in ("cook", None)
    assert spark.table(landing.tables.report).count() == 18
    assert set(keyed_rows(spark, landing.tables.silver).columns) == set(incidents.SILVER_COLUMNS)

    # Nothing new: nothing happens.
    assert landing.silver(partition_by=parts) is None

    # A later version updates one ticket and leaves the other alone.
    landing.put(incident("1", "2024-03-01T00:00:00Z", "Reopened"))
    landing.land()
    assert landing.silver(partition_by=parts)["passed"]
    assert landing.rows("ticket_id", "status") == [("1", "Reopened"), ("2", "In Progress")]

    # Reading all of bronze again arrives at the same table.
    assert landing.silver(full_load=True, partition_by=parts)["passed"]
    assert landing.rows("ticket_id", "status") == [("1", "Reopened"), ("2", "In Progress")]

    view = incidents.publish_gold(spark, landing.tables.silver, new_table("gold"))
    assert view.columns == list(incidents.GOLD_COLUMNS) and view.count() == 2


def test_modification_before_creation_closes_the_gate(landing):
    landing.put(incident("1", "2023-01-01T00:00:00Z"))
    landing.land()
    with pytest.raises(QualityGateClosed):
        landing.silver()


def test_full_load_replaces_bronze(spark, landing):
    landing.put(incident("1", "2024-01-02T00:00:00Z"))
    assert landing.land()[0] == 1 and landing.land()[0] == 0
    assert landing.land(full_load=True)[0] == 1
    assert spark.table(landing.tables.incidents).count() == 1
    assert spark.table(landing.tables.incidents).columns[-1] == incidents.INGESTION_DATE


def test_incremental_silver_prunes_bronze_days(spark, landing):
    landing.put(incident("1", "2024-01-02T00:00:00Z"))
    landing.land()
    from refinery.operators.incremental import newer_than

    bronze = spark.table(landing.tables.incidents)
    read = newer_than(bronze, "ingestion_time", datetime(2999, 1, 1), date_partition="ingestion_date")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan
    assert read.count() == 0


def test_tabular_dataset(spark, new_table, tmp_path):
    (tmp_path / "rates.csv").write_text("code,rate\nEUR,1.0\nUSD,\n")
    table = new_table("rates")
    spec = Dataset("rates", "files", str(tmp_path / "rates.csv"), "TABULAR_FILE", table)
    assert land_dataset(spark, spec, new_table("state")) == (2, None)
    records = [json.loads(r["raw_json"]) for r in spark.table(table).collect()]
    assert records == [{"code": "EUR", "rate": 1.0}, {"code": "USD", "rate": None}]


CSV = """Product type,SKU,Price,Revenue generated,Manufacturing costs,Shipping costs,Stock levels,Shipping times,Lead time
haircare,SKU1,10.5,100,20,5,3,4,7
haircare,SKU1,10.5,100,20,5,3,4,7
skincare,SKU2,5,50,10,5,1,9,7
cosmetics,SKU3,free,50,10,5,1,9,7
cosmetics,SKU4,-1,50,10,5,1,9,7
"""


@pytest.fixture
def landed(spark, tmp_path):
    supply.setup(spark)
    path = tmp_path / "supply.csv"
    path.write_text(CSV)
    name = f"raw_{tmp_path.name.replace('-', '_')}"
    bronze = supply.land_csv(spark, str(path), "dev", name)
    # Landing the same file again only repeats rows that differ in lineage.
    supply.land_csv(spark, str(path), "dev", name)
    return bronze


def test_supply_from_csv_to_dashboard(spark, landed):
    assert spark.table(landed).count() == 10
    silver, metrics = supply.load_silver(spark, landed, "dev")
    assert rows(spark.table(silver).select("SKU", "Price")) == [("SKU1", 10.5), ("SKU2", 5.0)]
    found = {(r["dataset"], r["metric_type"]): r["metric_value"] for r in metrics.collect()}
    assert found["bronze", "duplicate_rows"] == 6.0 and found["silver", "duplicate_rows"] == 0.0
    report = supply.validate_silver(spark, silver, "dev", id_cols=["SKU"])
    assert report["final_status"] == "VALIDATION_PASSED"
    tables = supply.publish_gold(spark, silver, "dev")
    assert tuple(tables["company_profit_kpi"].first()) == (150.0, 40.0, 110.0, pytest.approx(110 / 150))
    assert rows(spark.table("supply_dev_gold.product_on_time_delivery_kpi")) == [
        ("haircare", 1.0),
        ("skincare", 0.0),
    ]
    # Running everything again replaces, it does not add.
    supply.load_silver(spark, landed, "dev")
    supply.publish_gold(spark, silver, "dev")
    assert spark.table("supply_dev_gold.company_profit_kpi").count() == 1


def test_refine_returns_both_profiles(spark, landed):
    result = supply.refine(spark.table(landed), supply.CLEANING_CONFIG, supply.PROFILE_CONFIG)
    assert result["metadata_df"] is None and result["silver_df"].count() == 2
    assert result["bronze_report"]["duplicates"]["duplicate_rows"] == 6
    assert result["silver_report"]["duplicates"]["duplicate_rows"] == 0


def test_violations_are_written_before_the_gate_closes(spark, landed):
    silver, _ = supply.load_silver(spark, landed, "dev")
    strict = {"field_rules": {"string_rules": {"product_type": {"rules": [{"type": "regex", "pattern": "^h"}]}}}}
    with pytest.raises(ValidationFailed):
        supply.validate_silver(spark, silver, "dev", strict, ["SKU"])
    assert rows(spark.table("supply_dev_silver.silver_validation_issues")) == [
        ("SKU2", "Product_type", "skincare", "PATTERN_MISMATCH")
    ]
    report = supply.validate_silver(spark, silver, "test", strict, ["SKU"])
    assert report["final_status"] == "VALIDATION_FAILED"


def test_streams_load_new_files_only(spark, new_table, tmp_path):
    landing, bronze, silver = tmp_path / "in", tmp_path / "bronze", new_table("streamed")
    landing.mkdir()

    def page(name, *records):
        (landing / name).write_text(json.dumps({"results": records}))

    def run():
        land_new_pages(spark, str(landing), str(bronze), str(tmp_path / "c1"), ["$.results"])
        upsert_new_rows(
            spark,
            str(bronze),
            str(tmp_path / "c2"),
            lambda raw: raw.select(
                F.get_json_object("raw_json", "$.id").alias("id"),
                F.get_json_object("raw_json", "$.v").cast("int").alias("v"),
            ),
            silver,
            ["id"],
            "v",
            partition_by=["id"],
        )

    page("1.json", {"id": "a", "v": 1}, {"id": "b", "v": 1})
    run()
    assert rows(keyed_rows(spark, silver).select("id", "v")) == [("a", 1), ("b", 1)]
    page("2.json", {"id": "a", "v": 5}, {"id": "c", "v": 2}, {"id": "b", "v": 0})
    run()
    run()
    assert rows(keyed_rows(spark, silver).select("id", "v")) == [("a", 5), ("b", 1), ("c", 2)]
    assert spark.read.parquet(str(bronze)).count() == 5


def test_ledger_opens_new_files_only(landing, new_table):
    import os

    ledger = new_table("ledger")
    landing.put(incident("1", None), incident("2", None))
    first = landing.folder / "incidents" / "1.json"
    os.utime(first, (1_700_000_000, 1_700_000_000))
    assert landing.land(field=None, ledger=ledger) == (2, None)
    size = first.stat().st_size
    first.write_bytes(b"!" * size)  # unreadable, but neither size nor time has changed
    os.utime(first, (1_700_000_000, 1_700_000_000))
    assert landing.land(field=None, ledger=ledger) == (0, None)
    landing.put(incident("3", None))
    landing.put(incident("4", None))
    assert landing.land(field=None, ledger=ledger, max_files=1)[0] == 1
    assert landing.land(field=None, ledger=ledger, max_files=1)[0] == 1
    assert landing.land(field=None, ledger=ledger)[0] == 0
    assert landing.spark.table(ledger).count() == 3 and landing.spark.table(landing.tables.incidents).count() == 4
    # A file older than the bound is not listed; without the bound it is found.
    landing.put(incident("5", None))
    os.utime(landing.folder / "incidents" / f"{landing.pages}.json", (1_600_000_000, 1_600_000_000))
    assert landing.land(field=None, ledger=ledger, late_by=timedelta(days=1))[0] == 0
    assert landing.land(field=None, ledger=ledger)[0] == 1
    # A changed file is landed again, and a full load takes all files.
    first.write_text(json.dumps({"results": [incident("1", None)], "next": None}))
    assert landing.land(field=None, ledger=ledger)[0] == 1
    assert landing.land(field=None, ledger=ledger, full_load=True)[0] == 4
    assert landing.spark.table(landing.tables.incidents).count() == 4
    assert landing.land(field=None, ledger=ledger)[0] == 0


def test_lookups_are_kept_and_not_shuffled(spark, landing, new_table):
    tables = replace(landing.tables, person_lookup=new_table("person_lookup"), service_lookup=new_table("service_lookup"))

    def load():
        landing.land()
        landing.land("persons", None, ledger=ledger)
        load_silver(spark, tables, SETTINGS)
        return landing.rows("ticket_id", "job_title")

    ledger = new_table("ledger")
    landing.put({"id": "p1", "jobTitle": "cook"}, {"id": None, "jobTitle": "nobody"}, name="persons")
    landing.put(incident("1", "2024-01-02T00:00:00Z"), incident("2", "2024-01-02T00:00:00Z", caller=None))
    assert load() == [("1", "cook"), ("2", None)]
    landing.put({"id": "p1", "jobTitle": "baker"}, {"id": "p2", "jobTitle": "x"}, name="persons")
    landing.put(incident("3", "2024-01-03T00:00:00Z"))
    assert load() == [("1", "cook"), ("2", None), ("3", "baker")]
    held = spark.table(tables.person_lookup)
    assert rows(held.select("person_id", "job_title")) == [("p1", "baker"), ("p2", "x")]
    before = set(held.inputFiles())
    landing.put(incident("4", "2024-01-04T00:00:00Z"))
    assert len(load()) == 4 and set(spark.table(tables.person_lookup).inputFiles()) == before
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        known = (spark.table(t) for t in (tables.person_lookup, tables.service_lookup))
        tickets = incidents.silver_tickets_by_lookups(spark.table(tables.incidents), *known, SETTINGS)
        plan = tickets._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 2
    # One exchange for the latest versions and one per join, all of tickets.
    assert plan.count("Exchange hashpartitioning") == 3
