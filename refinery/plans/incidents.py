"""Incidents: landed pages -> raw bronze -> silver tickets -> gold view.

Values that differ between organisations (category patterns, patterns that find a country
in a caller) are settings; only the status map is fixed here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from refinery.functions.columns import find
from refinery.functions.expressions import blank_to_null, parse_iso
from refinery.operators.dedup import latest_per_key
from refinery.operators.enrich import (
    add_first_extract,
    add_mapped,
    add_pattern_columns,
    in_scope,
    keyed_lookup,
    lookup,
)
from refinery.operators.incremental import (
    STATE_DDL,
    advance_mark,
    highest,
    last_mark,
    micros,
    newer_than,
    utc_datetime,
)
from refinery.operators.raw_json import RAW, parse_raw
from refinery.operators.rules import Run, rules_for_columns
from refinery.plans.quality import require_passed, run_quality
from refinery.sinks.lookups import upsert_lookup
from refinery.sinks.staging import staging
from refinery.sinks.tables import (
    append,
    ensure_table,
    publish_table_view,
    replace_table,
    table_exists,
    upsert_table,
)
from refinery.sources import ledger as files_of
from refinery.sources.datasets import Dataset
from refinery.sources.files import csv_to_raw, scan_pages, variant_text

# Processing status -> ticket status.
STATUS_MAP = {
    "Closed": "Closed",
    "Completed": "Closed",
    "Cancelled": "Closed",
    "New": "Open",
    "Assigned": "Open",
    "In Progress": "Open",
    "Waiting for Supplier": "Open",
    "Waiting for Caller": "Open",
    "Waiting for Approval": "Open",
    "Waiting for Release": "Open",
    "Reopened": "Open",
    "Response received": "Open",
}

# The fields read from the raw JSON of incidents and of the lookups.
INCIDENT_SCHEMA = """
    id STRING,
    object STRUCT<id: STRING, name: STRING>,
    category STRUCT<name: STRING>,
    subcategory STRUCT<name: STRING>,
    caller STRUCT<id: STRING, dynamicName: STRING, email: STRING>,
    processingStatus STRUCT<name: STRING>,
    priority STRUCT<name: STRING>,
    urgency STRUCT<name: STRING>,
    creationDate STRING,
    modificationDate STRING
"""
PERSON_SCHEMA = "id STRING, jobTitle STRING, personExtraFieldA STRING, personExtraFieldB STRING"
SERVICE_SCHEMA = "id STRING, name STRING"

# The silver columns in their order, and those of the gold view.
SILVER_COLUMNS = (
    "ticket_id",
    "created_date",
    "OC",
    "business",
    "domain",
    "country_program",
    "priority",
    "urgency",
    "category",
    "subcategory",
    "status",
    "ticket_status",
    "caller_email",
    "caller_name",
    "job_title",
    "country_program_extract",
    "modification_ts",
)
GOLD_COLUMNS = (
    "ticket_id",
    "OC",
    "country_program",
    "ticket_status",
    "urgency",
    "created_date",
    "priority",
    "category",
    "subcategory",
    "job_title",
)
# Bronze is partitioned by this column, so that an incremental read lists new days only.
INGESTION_DATE = "ingestion_date"
CATEGORY_OUTPUTS = ("OC", "business", "domain")


def ticket_rules(prefix: str = "incidents") -> list[dict]:
    """The shipped rules for silver tickets."""
    return [
        *rules_for_columns(
            ["ticket_id", "status", "ticket_status", "created_date", "category"],
            "not_null",
            id_pattern=f"{prefix}_{{column}}_not_null",
            description="{column} is filled in.",
        ),
        {
            "rule_id": f"{prefix}_id_unique",
            "column": "ticket_id",
            "rule_type": "unique",
            "severity": "error",
            "description": "A ticket occurs once per run.",
        },
        {
            "rule_id": f"{prefix}_status_accepted_values",
            "column": "status",
            "rule_type": "accepted_values",
            "severity": "warning",
            "params": {"values": list(STATUS_MAP), "case_sensitive": False},
            "description": "The status is a known processing status, in any case.",
        },
        {
            "rule_id": f"{prefix}_modification_ts_not_before_created_date",
            "column": "modification_ts",
            "rule_type": "custom_sql",
            "severity": "error",
            "params": {
                "expression": "modification_ts IS NULL OR modification_ts >= created_date"
            },
            "description": "A ticket is not modified before it is created.",
        },
        {
            "rule_id": f"{prefix}_modification_ts_null_flag",
            "column": "modification_ts",
            "rule_type": "not_null",
            "severity": "warning",
            "description": "Shows tickets that were never modified.",
        },
    ]


@dataclass(frozen=True)
class IncidentSettings:
    """``category_rules``: dicts with pattern, OC, business, domain (first match wins).
    ``country_patterns``: (column, regex) tried in order, group 1 is the country."""

    category_rules: Sequence[Mapping[str, str]]
    country_patterns: Sequence[tuple[str, str]]
    status_map: Mapping[str, str] = field(default_factory=lambda: dict(STATUS_MAP))


@dataclass(frozen=True)
class IncidentTables:
    incidents: str
    persons: str
    services: str
    silver: str
    state: str
    report: str
    quarantine: str
    #: Lookup tables that are kept from run to run; without them bronze is looked up whole.
    person_lookup: str | None = None
    service_lookup: str | None = None


# --- transformations -------------------------------------------------------------------


# Where the columns of a ticket lie in the record.
TICKET_FIELDS = {
    "incident_id": "id",
    "object_id": "object.id",
    "country_program": "object.name",
    "caller_id": "caller.id",
    "caller_name": "caller.dynamicName",
    "caller_email": "caller.email",
}
NAMED_OBJECTS = {"status": "processingStatus"} | {c: c for c in ("category", "subcategory", "priority", "urgency")}
TICKET_TIMES = {"created_date": "creationDate", "modification_ts": "modificationDate"}


def select_incident_fields(parsed: DataFrame) -> DataFrame:
    paths = TICKET_FIELDS | {name: f"{source}.name" for name, source in NAMED_OBJECTS.items()}
    values = {name: F.col(path) for name, path in paths.items()}
    values |= {name: parse_iso(F.col(path)) for name, path in TICKET_TIMES.items()}
    return parsed.select(*[value.alias(name) for name, value in values.items()], "ingestion_time")


def person_lookup(persons_raw: DataFrame) -> DataFrame:
    """Persons with the time of each version; blank job titles are null."""
    return parse_raw(persons_raw, PERSON_SCHEMA).select(
        F.col("id").alias("person_id"),
        blank_to_null(F.col("jobTitle")).alias("job_title"),
        F.col("personExtraFieldA").alias("person_extra_a"),
        F.col("personExtraFieldB").alias("person_extra_b"),
        F.col("ingestion_time").alias("person_seen"),
    )


def service_lookup(services_raw: DataFrame) -> DataFrame:
    return parse_raw(services_raw, SERVICE_SCHEMA).select(
        F.col("id").alias("service_id"),
        F.col("name").alias("service_name"),
        F.col("ingestion_time").alias("service_seen"),
    )


def silver_tickets(
    incidents_raw: DataFrame,
    persons_raw: DataFrame,
    services_raw: DataFrame,
    settings: IncidentSettings,
) -> DataFrame:
    """Silver tickets from raw JSON frames.

    Rows out of scope and older versions of a ticket go before the lookups are joined: the
    result is the same, and only surviving rows are shuffled or probed.
    """
    tickets = _current_tickets(incidents_raw, settings)
    tickets = lookup(tickets, person_lookup(persons_raw), "caller_id", "person_id", "person_seen")
    tickets = lookup(
        tickets, service_lookup(services_raw), "object_id", "service_id", "service_seen"
    )
    return tickets.withColumnRenamed("incident_id", "ticket_id").select(*SILVER_COLUMNS)


def _current_tickets(incidents_raw: DataFrame, settings: IncidentSettings) -> DataFrame:
    tickets = select_incident_fields(parse_raw(incidents_raw, INCIDENT_SCHEMA))
    tickets = add_pattern_columns(tickets, "category", settings.category_rules, CATEGORY_OUTPUTS)
    tickets = in_scope(tickets, "OC")
    tickets = latest_per_key(tickets, ["incident_id"], ["modification_ts", "ingestion_time"])
    tickets = add_mapped(tickets, "status", "ticket_status", settings.status_map)
    return add_first_extract(tickets, "country_program_extract", settings.country_patterns)


def silver_tickets_by_lookups(
    incidents_raw: DataFrame, persons: DataFrame, services: DataFrame, settings: IncidentSettings
) -> DataFrame:
    """``silver_tickets`` from lookup tables, which hold every person and service once."""
    tickets = _current_tickets(incidents_raw, settings)
    tickets = keyed_lookup(tickets, persons.drop("person_seen"), "caller_id", "person_id")
    tickets = keyed_lookup(tickets, services.drop("service_seen"), "object_id", "service_id")
    return tickets.withColumnRenamed("incident_id", "ticket_id").select(*SILVER_COLUMNS)


def refresh_lookups(spark: SparkSession, tables: IncidentTables, pipeline: str = "silver_incidents", **options) -> None:
    """Bring the lookup tables up to date from the bronze rows since their own marks."""
    ensure_table(spark, tables.state, STATE_DDL, "High-water marks")
    wanted = (
        (tables.persons, tables.person_lookup, person_lookup, "person_id", "person_seen"),
        (tables.services, tables.service_lookup, service_lookup, "service_id", "service_seen"),
    )
    for source, target, build, key, seen in wanted:
        bronze = _or_empty(spark, source)
        mark = last_mark(spark.table(tables.state), pipeline, target)
        prune = {"date_partition": find(bronze, INGESTION_DATE)}
        upto = highest(newer_than(bronze, "ingestion_time", mark, **prune), "ingestion_time")
        if upto is None and table_exists(spark, target):
            continue
        fresh = newer_than(bronze, "ingestion_time", mark, upto=upto, **prune)
        upsert_lookup(build(fresh), target, key, seen, **options)
        advance_mark(tables.state, pipeline, target, upto, bronze)


# --- flows -----------------------------------------------------------------------------


def _read_records(spark: SparkSession, dataset: Dataset, **read_options) -> DataFrame:
    """Raw records with the time of their last change (null without an incremental field)."""
    path = f"$.{dataset.incremental_field}"
    if dataset.pagination == "TABULAR_FILE":
        records = csv_to_raw(spark, dataset.path, **read_options)
        text = variant_text(F.col(RAW), path)
    else:
        fields = {"__text": path} if dataset.incremental_field else {}
        records = scan_pages(
            spark, dataset.path, dataset.record_paths, fields=fields, **read_options
        )
        text = F.col("__text")
    changed = parse_iso(text) if dataset.incremental_field else F.lit(None).cast("timestamp")
    return records.select(RAW, changed.alias("__changed"))


def land_dataset(
    spark: SparkSession,
    dataset: Dataset,
    state_table: str,
    *,
    full_load: bool = False,
    rows_per_file: int | None = None,
    ledger: str | None = None,
    late_by: timedelta | None = None,
    max_files: int | None = None,
    **read_options,
) -> tuple[int, datetime | None]:
    """Landed files of one dataset -> its bronze table, then its mark.

    A full load replaces the table, anything else appends records after the mark; once
    there is a mark, records without the incremental field come with a full load only. A
    full load that finds no record leaves the table alone. Returns (records written, new mark
    or None).

    With a ``ledger`` table only files are opened that it does not have (a full load opens
    all), and they are entered once their records are written. ``late_by`` bounds how much older
    than the newest landed file a new one can be; older ones are then not even listed.
    ``max_files`` leaves files, the newest first, to the next run.
    """
    ensure_table(spark, state_table, STATE_DDL, "High-water marks")
    if ledger is None:
        return _land(spark, dataset, state_table, full_load, rows_per_file, read_options)
    ensure_table(spark, ledger, files_of.LEDGER_DDL, "Landed files")
    landed = files_of.landed_files(spark.table(ledger), dataset.pipeline, dataset.name)
    since = None if late_by is None or full_load else files_of.newest_landed(landed, late_by)
    found = files_of.list_files(spark, dataset.path, since)
    if not full_load:
        found = files_of.new_files(found, landed)
        if max_files is not None:
            found = found.orderBy("modified", "path").limit(max_files)
    with staging(spark) as stage:
        batch = stage(found, "files")
        # The paths that the reader is given; Spark holds the same list for a whole folder.
        paths = [r["path"] for r in batch.select("path").collect()]
        if not paths:
            return 0, None
        done = _land(spark, replace(dataset, path=paths), state_table, full_load, rows_per_file, read_options)
        files_of.record(batch, ledger, dataset.pipeline, dataset.name)
    return done


def _land(
    spark: SparkSession, dataset: Dataset, state_table: str, full_load: bool, rows_per_file: int | None, read_options: dict
) -> tuple[int, datetime | None]:
    records = _read_records(spark, dataset, **read_options)
    if dataset.incremental_field:
        mark = last_mark(
            spark.table(state_table), dataset.pipeline, dataset.name, full_load=full_load
        )
        records = newer_than(records, "__changed", mark)
    if full_load and records.isEmpty():
        return 0, None
    # Count and mark are observed while the records are written, so files are read once.
    landed = Observation("landed")
    now = F.current_timestamp()
    rows = records.observe(
        landed,
        F.count(F.lit(1)).alias("rows"),
        F.max(micros(F.col("__changed"))).alias("mark"),
    ).select(RAW, now.alias("ingestion_time"), F.to_date(now).alias(INGESTION_DATE))
    layout = {"partition_by": [INGESTION_DATE]}
    if full_load:
        replace_table(rows, dataset.bronze_table, **layout)
    else:
        append(rows, dataset.bronze_table, rows_per_file=rows_per_file, **layout)
    reached = utc_datetime(landed.get["mark"])
    advance_mark(state_table, dataset.pipeline, dataset.name, reached, rows)
    return landed.get["rows"], reached


def load_silver(
    spark: SparkSession,
    tables: IncidentTables,
    settings: IncidentSettings,
    rules: Sequence[Mapping] | None = None,
    *,
    pipeline: str = "silver_incidents",
    endpoint: str = "incidents",
    full_load: bool = False,
    partition_by: Sequence[str] = (),
    drop_previous: bool = False,
) -> dict | None:
    """New bronze records -> quality gate -> silver upsert -> mark. None when nothing is new.

    The upper bound of the batch is fixed before it is read, so records that arrive
    meanwhile belong to the next run. A closed gate raises and leaves silver and mark alone.
    """
    ensure_table(spark, tables.state, STATE_DDL, "High-water marks")
    bronze = spark.table(tables.incidents)
    mark = last_mark(spark.table(tables.state), pipeline, endpoint, full_load=full_load)
    prune = {"date_partition": find(bronze, INGESTION_DATE)}
    fresh = newer_than(bronze, "ingestion_time", mark, **prune)
    upto = highest(fresh, "ingestion_time")
    if upto is None:
        return None
    fresh = newer_than(bronze, "ingestion_time", mark, upto=upto, **prune)
    if tables.person_lookup and tables.service_lookup:
        refresh_lookups(spark, tables, pipeline)
        known = (spark.table(t) for t in (tables.person_lookup, tables.service_lookup))
        tickets = silver_tickets_by_lookups(fresh, *known, settings)
    else:
        known = (_or_empty(spark, t) for t in (tables.persons, tables.services))
        tickets = silver_tickets(fresh, *known, settings)
    run = Run(pipeline_name=pipeline, source_table=tables.silver)
    with staging(spark) as stage:
        batch = stage(tickets, "tickets")
        verdict = run_quality(
            spark, rules or ticket_rules(), run, tables.report, tables.quarantine, batch
        )
        require_passed(verdict)
        upsert_table(
            batch,
            tables.silver,
            ["ticket_id"],
            "modification_ts",
            partition_by=partition_by,
            drop_previous=drop_previous,
        )
    advance_mark(tables.state, pipeline, endpoint, upto, bronze)
    return verdict


def _or_empty(spark: SparkSession, table: str) -> DataFrame:
    """A lookup table that has not been landed yet counts as empty."""
    if table_exists(spark, table):
        return spark.table(table)
    return spark.createDataFrame([], f"{RAW} STRING, ingestion_time TIMESTAMP")


def publish_gold(spark: SparkSession, silver_table: str, view: str) -> DataFrame:
    return publish_table_view(spark, silver_table, GOLD_COLUMNS, view)
