"""Profiling, validation and reporting aggregates."""

from datetime import datetime

import pytest
from support import rows
from pyspark.sql import functions as F

from refinery.functions.columns import UnknownColumnWarning
from refinery.operators.aggregate import (
    completeness,
    count_by,
    count_panels,
    counted_ratio,
    crosstab,
    dataset_summary,
    field_inventory,
    field_states,
    monthly_trend,
    panel_counts,
    shares,
    top_k,
)
from refinery.operators.profile import cardinality, duplicates, null_rates, profile, profile_metrics
from refinery.operators.profile_state import merge_states, profile_of, profile_state
from refinery.operators.validate import (
    ValidationFailed,
    check_dependencies,
    check_references,
    close_gate,
    _violating,
    dependency_violations,
    issues_of,
    orphans,
    run_validation,
    string_violations,
    validate_strings,
)
from refinery.plans import kpis, panels

# --- profiling -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def items(spark):
    t = datetime(1970, 1, 2)
    data = [("a", 1.0, t), ("a", 3.0, t), (None, None, t), ("b", 2.0, None)]
    return spark.createDataFrame(data, "SKU string, price double, at timestamp")


CONFIG = {
    "duplicate_keys": ["sku"],
    "numeric_cols": ["price"],
    "timestamp_cols": ["at"],
    "null_rate_cols": ["SKU", "Price"],
    "cardinality_cols": ["SKU"],
}


def test_profile_report(items):
    assert profile(items, CONFIG) == {
        "null_rates": {"SKU_null_pct": 0.25, "price_null_pct": 0.25},
        "cardinality": {"SKU_distinct_count": 2, "SKU_distinct_pct": 0.5},
        "numeric_distribution": {"price_min": 1.0, "price_max": 3.0, "price_avg": 2.0, "price_stddev": 1.0},
        "timestamp_range": {"at_min": datetime(1970, 1, 2), "at_max": datetime(1970, 1, 2)},
        "duplicates": {
            "keys": ["sku"],
            "duplicate_key_groups": 1,
            "duplicate_rows": 1,
            "duplicate_row_pct": 0.25,
            "total_rows": 4,
        },
    }


def test_profile_over_no_rows_or_columns(items):
    empty = profile(items.where("false"), CONFIG)
    assert empty["null_rates"] is None and empty["timestamp_range"] is None
    assert empty["duplicates"]["duplicate_row_pct"] == 0.0
    assert profile(items, {"timestamp_cols": [], "duplicate_keys": []}) == {
        "timestamp_range": None,
        "duplicates": {"keys": []},
    }
    with pytest.warns(UnknownColumnWarning):
        assert profile(items, {"null_rate_cols": ["nowhere"]}) == {"null_rates": None}


def test_metrics_in_long_form(items):
    metrics = profile_metrics(items, "items", CONFIG)
    assert metrics.columns == ["dataset", "metric_type", "column", "metric_value", "run_ts"]
    found = {(r["metric_type"], r["column"]): r["metric_value"] for r in metrics.collect()}
    assert found["null_rate", "SKU_null_pct"] == 0.25
    assert found["cardinality", "SKU_distinct_count"] == 2.0
    assert found["timestamp_range", "at_max"] == 86400.0
    assert found["duplicate_rows", "sku"] == 1.0
    assert len(found) == 13
    assert profile_metrics(items.where("false"), "x", {"numeric_cols": ["price"]}).count() == 0
    with pytest.raises(ValueError):
        profile_metrics(items, "x", {})


def test_approximate_count_is_close(spark):
    df = spark.range(20_000).select((F.col("id") % 5_000).alias("k"))
    found = cardinality(df, ["k"]).first()["k_distinct_count"]
    assert abs(found - 5_000) < 0.15 * 5_000


def test_single_checks(items):
    assert null_rates(items, ["sku"]).first()["SKU_null_pct"] == 0.25
    assert duplicates(items, ["sku", "price"]).first()["duplicate_rows"] == 0


# --- validation ------------------------------------------------------------------------

STRINGS = {
    "SKU": {"rules": [{"type": "required"}, {"type": "no_spaces"}, {"type": "regex", "pattern": "^S[0-9]+$"}]},
    "KIND": {"rules": [{"type": "allowed_values", "values": ["Soap", "CREAM"]}]},
}


@pytest.fixture(scope="module")
def goods(spark):
    data = [(1, "S1", " soap "), (2, None, "cream"), (3, "S 2", "oil"), (4, "", None)]
    return spark.createDataFrame(data, "id int, sku string, kind string")


def test_string_violations(goods):
    assert rows(string_violations(goods, STRINGS, ["ID"])) == [
        (2, "sku", None, "NULL_NOT_ALLOWED"),
        (3, "kind", "oil", "INVALID_VALUE"),
        (3, "sku", "S 2", "CONTAINS_WHITESPACE"),
        (3, "sku", "S 2", "PATTERN_MISMATCH"),
        (4, "sku", "", "CONTAINS_WHITESPACE"),
        (4, "sku", "", "PATTERN_MISMATCH"),
    ]


def test_string_result(goods):
    result = validate_strings(goods, STRINGS)
    assert result["status"] == "FAIL"
    assert result["metrics"] == {"rows_checked": 4, "violations_count": 6}
    assert result["issues"].count() == 6
    clean = validate_strings(goods.where("id = 1"), STRINGS)
    assert (clean["status"], clean["issues"]) == ("PASS", None)
    assert validate_strings(goods, {})["status"] == "PASS"
    with pytest.raises(ValueError):
        validate_strings(goods, {"sku": {"rules": [{"type": "rhyme"}]}})


@pytest.fixture(scope="module")
def prices(spark):
    data = [("a", "x", 1), ("a", "x", 2), ("b", "x", 1), ("b", "y", 1), (None, "x", 1), (None, "y", 1), ("c", None, 1), ("c", "x", 1)]
    return spark.createDataFrame(data, "sku string, kind string, price int")


def test_dependencies_side_by_side(prices):
    found = dependency_violations(prices, {"SKU": "kind", ("sku", "kind"): "price"})
    shown = found.select("determinant", "column", "dependent_column", "conflicting_value", "distinct_count")
    assert rows(shown) == [
        ('{"sku":"a","kind":"x"}', "sku, kind", "price", "1", 2),
        ('{"sku":"a","kind":"x"}', "sku, kind", "price", "2", 2),
        ('{"sku":"b"}', "sku", "kind", "x", 2),
        ('{"sku":"b"}', "sku", "kind", "y", 2),
        ('{"sku":null}', "sku", "kind", "x", 2),
        ('{"sku":null}', "sku", "kind", "y", 2),
    ]


def test_dependency_status(prices):
    result = check_dependencies(prices, {"sku": "kind", ("sku", "kind"): "price"})
    assert result["status"] == "FAIL"
    assert result["metrics"] == {"rows_checked": 8, "violations_count": 3}
    holds = check_dependencies(prices, {"price": "price"})
    assert (holds["status"], holds["issues"]) == ("PASS", None)
    with pytest.warns(UnknownColumnWarning):
        assert check_dependencies(prices, {"nowhere": "kind"})["status"] == "PASS"
        assert dependency_violations(prices, {"nowhere": "kind"}).count() == 0


def test_every_value_is_listed(spark):
    df = spark.range(500).select(F.lit("k").alias("k"), F.col("id").alias("v"))
    found = dependency_violations(df, {"k": "v"}).collect()
    assert {r["distinct_count"] for r in found} == {500}
    assert sorted(int(r["conflicting_value"]) for r in found) == list(range(500))
    assert check_dependencies(df, {"k": "v"})["metrics"]["violations_count"] == 1


def test_dependencies_are_decided_by_extremes(spark):
    df = spark.range(1_000).selectExpr("id % 100 AS k", "IF(id = 7, 1L, id % 100) AS v")
    plan = _violating(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "min(" in plan and "max(" in plan and plan.count("Exchange") == 1 and "distinct" not in plan
    assert rows(dependency_violations(df, {"k": "v"}).select("determinant", "conflicting_value")) == [('{"k":7}', "1"), ('{"k":7}', "7")]


def test_only_possible_orphans_are_shuffled(spark):
    children = spark.range(3_000).selectExpr("IF(id % 50 = 0, null, IF(id < 5, -id - 1, id % 40)) AS k", "repeat('x', 100) AS load")
    parents = spark.range(40).selectExpr("id AS code")
    few, many = orphans(children, "k", parents, "code"), orphans(children, "k", parents, "code", max_rows=0)
    assert rows(few) == rows(many) and {r.k for r in many.collect()} == {-2, -3, -4, -5}
    # Of the children only keys are shuffled, and the rows that a bitmap of missing keys leaves.
    plan = many._jdf.queryExecution().executedPlan().toString()
    marked = plan.index("bit_or")
    assert "load" not in "".join(x for x in plan[marked:].splitlines() if "Exchange hashpartitioning" in x)


def test_references(spark, goods):
    parents = spark.createDataFrame([("S1",), ("S1",), (None,)], "code string")
    result = check_references(goods, {"sku": (parents, "CODE")}, ["id"])
    assert rows(result["issues"]) == [
        (3, "sku", "S 2", "REFERENCE_NOT_FOUND"),
        (4, "sku", "", "REFERENCE_NOT_FOUND"),
    ]
    assert check_references(goods.where("id < 3"), {"sku": (parents, "code")})["status"] == "PASS"


FIELD = {"field_rules": {"string_rules": STRINGS}}


def test_orchestration(spark, goods):
    failed = run_validation(goods, FIELD, ["id"])
    assert failed["final_status"] == "VALIDATION_FAILED"
    assert failed["business"]["status"] == "SKIPPED" and failed["business"]["reason"]
    assert failed["meta"]["validators_run"] == ["field_validation"]
    assert issues_of(failed, "field").count() == 6 and issues_of(failed, "business") is None
    with pytest.raises(ValidationFailed):
        close_gate(failed, "prod")
    close_gate(failed, "test")

    fds = {"business_rules": {"functional_dependencies": {"id": "sku"}}}
    passed = run_validation(goods.where("id = 1"), {**FIELD, **fds})
    assert passed["final_status"] == "VALIDATION_PASSED"
    close_gate(passed, "prod")

    broken = run_validation(goods, {"field_rules": {"string_rules": {"sku": {"rules": [{"type": "?"}]}}}, **fds})
    assert broken["final_status"] == "VALIDATION_SYSTEM_ERROR"
    assert broken["field"]["error"]["type"] == "ValueError"
    assert broken["business"]["status"] == "SUCCESS"
    assert issues_of(broken, "field") is None
    with pytest.raises(ValidationFailed):
        close_gate(broken, "dev")

    assert run_validation(goods, {})["final_status"] == "VALIDATION_SKIPPED"
    parents = spark.createDataFrame([("S1",)], "code string")
    with_parents = run_validation(goods, {}, parents={"sku": (parents, "code")})
    assert with_parents["final_status"] == "VALIDATION_FAILED"


# --- aggregates ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def gold(spark):
    data = [
        (1, "A", "x", "Open", "P1", "U1", datetime(2024, 1, 5), ""),
        (2, "A", "x", "Closed", "P1", None, datetime(2024, 1, 9), "cook"),
        (3, "A", None, None, None, "U1", datetime(2024, 2, 1), None),
        (4, "B", "y", "Open", "P2", "U2", datetime(2024, 2, 2), "cook"),
        (5, None, "y", "Open", "P2", "U2", None, "nurse"),
    ]
    return spark.createDataFrame(
        data,
        "ticket_id int, OC string, subcategory string, ticket_status string, priority string, "
        "urgency string, created_date timestamp, job_title string",
    )


def test_counts_and_order(gold):
    assert [tuple(r) for r in count_by(gold, "OC").collect()] == [(None, 1), ("A", 3), ("B", 1)]
    assert count_by(gold, "OC", order="count").first()["OC"] == "A"
    assert [r["subcategory"] for r in top_k(gold, "subcategory", 1).collect()] == ["x"]
    assert top_k(gold, "subcategory", 9, skip_null=False).count() == 3


def test_crosstab_has_zeros_and_no_null_column(gold):
    table = crosstab(gold, "OC", "ticket_status")
    assert table.columns == ["OC", "Closed", "Open"]
    assert rows(table) == [("A", 1, 1), ("B", 0, 1)]
    fixed = crosstab(gold, "OC", "ticket_status", ["Open", "Lost"])
    assert rows(fixed) == [("A", 1, 0), ("B", 1, 0)]


def test_summary_counts_distinct_values_without_repeating_rows(spark, tmp_path):
    data = [(1.0, "a", 3), (-0.0, "a", None), (0.0, None, 5), (None, "", 4), (float("nan"), "b", None), (float("nan"), "b", 9)]
    df = spark.createDataFrame(data, "x double, `y.z` string, d int")
    assert [tuple(r) for r in dataset_summary(df, ["x", "y.z"], "d").collect()] == [(6, 3, 3, 3, 9)]
    assert [tuple(r) for r in dataset_summary(df.limit(0), ["x"], "d").collect()] == [(0, 0, None, None)]
    assert [tuple(r) for r in dataset_summary(df, [], "d").collect()] == [(6, 3, 9)]
    df.write.parquet(str(tmp_path / "t"))
    stored = dataset_summary(spark.read.parquet(str(tmp_path / "t")), ["x", "y.z", "d"], "d")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("FileScan") == 1


def test_count_panels_agree_with_single_counts_and_scan_once(spark, gold, tmp_path):
    wanted = {"all": (), "by_oc": ("OC",), "again": ("oc",), "cells": ("ticket_status", "OC")}
    counts = count_panels(gold, wanted)
    assert counts.columns == ["panel", "OC", "ticket_status", "count"]
    assert rows(panel_counts(counts, wanted, "by_oc")) == rows(count_by(gold, "OC"))
    assert rows(panel_counts(counts, wanted, "again")) == rows(count_by(gold, "OC"))
    assert rows(panel_counts(counts, wanted, "cells")) == rows(count_by(gold, ["ticket_status", "OC"]))
    assert rows(panel_counts(counts, wanted, "all")) == [(gold.count(),)]
    assert rows(count_panels(gold.limit(0), wanted)) == rows(count_panels(gold.limit(0), {"all": ()})) == []
    assert rows(count_panels(gold, {"all": ()})) == [("all", gold.count())]
    with pytest.raises(ValueError, match="nowhere"):
        count_panels(gold, {"p": ("nowhere",)})
    gold.withColumn("country_program", F.lit("x")).write.parquet(str(tmp_path / "gold"))
    plan = panels.counts_at_once(spark.read.parquet(str(tmp_path / "gold")))
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_shares(gold):
    assert {r["OC"]: round(r["share"], 6) for r in shares(gold, "OC").collect()} == {"A": 60.0, "B": 20.0, None: 20.0}
    within = shares(gold, "ticket_status", "OC")
    assert round(sum(r["share"] for r in within.collect()), 6) == 300.0


def test_trend(gold):
    trend = [(r["month"], r["count"]) for r in monthly_trend(gold, "created_date").collect()]
    assert trend == [(None, 1), (datetime(2024, 1, 1), 2), (datetime(2024, 2, 1), 2)]


def test_completeness(gold):
    found = completeness(gold, ["subcategory", "job_title", "Priority"])
    assert rows(found) == [("job_title", 80.0, "good"), ("priority", 80.0, "good"), ("subcategory", 80.0, "good")]
    assert completeness(gold.where("false"), ["OC"]).first()["completeness"] is None


def test_inventory(gold):
    fields = [("ticket_id", "id"), ("job_title", "role")]
    found = field_inventory(gold, fields, "OC", ["A", "Z"])
    assert rows(found) == [("job_title", "role", 33.3, 0.0), ("ticket_id", "id", 100.0, 0.0)]
    assert field_inventory(gold.where("false"), fields, "OC", ["A"]).count() == 2


def test_states_and_ratio(gold):
    assert tuple(field_states(gold, "job_title").first()) == (3, 1, 1)
    assert tuple(counted_ratio(gold, F.col("OC") == "A").first()) == (3, 5, 60.0)
    assert counted_ratio(gold.where("false"), F.lit(True)).first()["ratio"] is None


def test_panels(gold):
    gold = gold.withColumns({"country_program": F.lit(None).cast("string"), "category": F.lit("c")})
    assert panels.overview(gold).first()["country_program_cnt"] == 0
    side = panels.comparison(gold, ["A", "B"])
    assert rows(side["priority"]) == [("P1", 2, 0), ("P2", 0, 1)]
    own = panels.deep_dive(gold, "A", ["P1", "P2"])
    assert rows(own["urgency_by_priority"]) == [("U1", 1, 0)]
    assert own["with_country"].first()["ratio"] == 0.0
    assert own["completeness"].count() == 7
    assert panels.quality_summary(gold).count() == 3
    titles = panels.job_titles(gold, "A")
    assert rows(titles["values"]) == [("cook", 1, 100.0)]


# --- KPIs ------------------------------------------------------------------------------


def test_kpis_with_zero_and_null(spark):
    data = [
        ("soap", 100.0, 30.0, 10.0, 2, 5, 5),
        ("soap", 100.0, 20.0, None, 1, 9, 5),
        ("oil", 0.0, 5.0, 1.0, 1, None, 5),
    ]
    tx = spark.createDataFrame(
        data,
        "Product_type string, Revenue_generated double, Manufacturing_costs double, "
        "Shipping_costs double, Stock_levels int, Shipping_times int, Lead_time int",
    )
    assert tuple(kpis.company_profit(tx).first()) == (200.0, 46.0, 154.0, 0.77)
    products = kpis.product_profit(tx)
    assert rows(products) == [("oil", 0.0, 6.0, -6.0, None), ("soap", 200.0, 40.0, 160.0, 0.8)]
    assert rows(kpis.inventory_efficiency(tx)) == [("oil", 5.0, 0.0, None), ("soap", 80.0, 200.0, 0.4)]
    assert tuple(kpis.shipping_cost_impact(tx).first()) == (200.0, 11.0, 0.055)
    assert kpis.product_shipping_cost(tx).first()["product_type"] == "soap"
    assert kpis.on_time_delivery(tx).first()[0] == pytest.approx(1 / 3)
    assert [r[0] for r in kpis.product_on_time_delivery(tx).collect()] == ["oil", "soap"]
    assert kpis.profit_counter(kpis.company_profit(tx)).first()["profit"] == 154.0
    assert [r[0] for r in kpis.profit_by_product(products).collect()] == ["soap", "oil"]
    shown = kpis.dashboard_datasets({n: build(tx) for n, build in kpis.KPI_TABLES.items()})
    assert set(shown) == set(kpis.DASHBOARD)
    assert shown["product_performance"].columns == ["product_type", "profit"]


def test_profile_states_merge_in_any_grouping(spark):
    df = spark.range(1_000).selectExpr("id", "IF(id % 7 = 0, null, id * 0.5D + 1e6) AS v", "CAST(id % 30 AS string) AS t", "CAST(null AS int) AS n")
    whole = profile_state(df, ["v", "t", "n"], "all")
    parts = [profile_state(df.where(f"id % 3 = {k}"), ["V", "t", "n"], str(k)) for k in range(3)] + [profile_state(df.where("false"), ["v", "t", "n"], "none")]
    pair = merge_states(parts[0].unionByName(parts[1]))
    merged = profile_of(pair.unionByName(parts[2]).unionByName(parts[3]))
    one, two = ({r["column"]: r for r in f.collect()} for f in (profile_of(whole), merged))
    for name in ("v", "t", "n"):
        assert (one[name].rows, one[name].nulls, one[name].low, one[name].high) == (two[name].rows, two[name].nulls, two[name].low, two[name].high)
        assert one[name].distinct_count == two[name].distinct_count
    assert one["v"].stddev == pytest.approx(df.agg(F.stddev("v")).first()[0]) == pytest.approx(two["v"].stddev)
    assert one["t"].distinct_count == 30 and one["n"].avg is None and two["n"].distinct_count == 0
