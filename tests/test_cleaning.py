import warnings
from datetime import datetime

import pytest
from support import rows
from pyspark.sql import functions as F

from refinery.functions.columns import UnknownColumnWarning, find, known
from refinery.functions.expressions import (
    blank_to_null,
    coverage_band,
    first_extract,
    format_iso,
    map_patterns,
    map_values,
    parse_iso,
    percent,
    to_boolean,
)
from refinery.operators.clean import (
    cast_columns,
    columns_to_boolean,
    require,
    split_metadata,
    standardise_text,
    structural_clean,
    within_ranges,
)
from refinery.operators.dedup import drop_exact_copies, latest_per_key, latest_version


def value(spark, expression, **literals):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in literals.items()])
    return df.select(expression.alias("x")).first()["x"]


def test_find_prefers_the_exact_spelling(spark):
    df = spark.createDataFrame([(1,)], "Price int")
    assert find(df, "price") == "Price" and find(df, "cost") is None
    with pytest.warns(UnknownColumnWarning, match="cost"):
        assert known(df, ["PRICE", "cost"], used_by="test") == ["Price"]
    with pytest.raises(ValueError, match="cost"):
        known(df, ["cost"], used_by="test", strict=True)


def test_scalar_expressions(spark):
    c = F.col("c")
    assert value(spark, map_values(c, {"a": "x"}), c="b") is None
    assert value(spark, blank_to_null(c), c="  ") is None
    assert value(spark, blank_to_null(c), c=" k ") == " k "
    assert value(spark, to_boolean(c, {" Yes": True, "0": False}), c=" YES ") is True
    assert value(spark, to_boolean(c, {"yes": True, 0: False}), c=0) is False
    assert value(spark, to_boolean(c, {"yes": True}), c="maybe") is None
    patterns = [(c, r"(?i)desk-([a-z]+)-"), (c, r"^([a-z]+)-")]
    assert value(spark, first_extract(patterns), c="MyDESK-Land-x") == "Land"
    assert value(spark, first_extract(patterns), c="north-x") == "north"
    assert value(spark, first_extract(patterns), c="none") is None
    assert value(spark, percent(F.lit(1), F.lit(0))) is None
    bands = [value(spark, coverage_band(c), c=x) for x in (80.0, 79.9, 50.0, 0.0)]
    assert bands == ["good", "medium", "medium", "poor"]


def test_first_matching_pattern_wins(spark):
    rules = [{"pattern": "ab", "x": "1"}, {"pattern": "b", "x": "2", "y": "3"}]
    match = map_patterns(F.col("c"), rules, ["x", "y"])
    assert value(spark, match, c="zABz").asDict() == {"x": "1", "y": None}
    assert value(spark, match, c="b").asDict() == {"x": "2", "y": "3"}
    assert value(spark, match, c="q") is None


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-05-06T07:08:09Z", "2024-05-06T07:08:09.000000Z"),
        ("2024-05-06T07:08:09.123456Z", "2024-05-06T07:08:09.123456Z"),
        ("2024-05-06T07:08:09.5+0000", "2024-05-06T07:08:09.500000Z"),
        ("2024-05-06T09:08:09+02:00", "2024-05-06T07:08:09.000000Z"),
        ("2024-05-06", "2024-05-06T00:00:00.000000Z"),
        ("yesterday", None),
        ("", None),
    ],
)
def test_iso_timestamps(spark, text, expected):
    assert value(spark, format_iso(parse_iso(F.col("c"))), c=text) == expected


def test_iso_seconds(spark):
    text = format_iso(parse_iso(F.col("c")), seconds_only=True)
    assert value(spark, text, c="2024-05-06T07:08:09.9Z") == "2024-05-06T07:08:09Z"


def test_bad_text_becomes_null_not_an_error(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), (None,)], "price string")
    assert rows(cast_columns(df, {"PRICE": "float"})) == [(1.5,), (None,), (None,)]


def test_trim_lower_upper_in_this_order(spark):
    df = spark.createDataFrame([(" aB ",)], "c string")
    assert standardise_text(df, trim=["c"], lower=["c"]).first()["c"] == "ab"
    assert standardise_text(df, lower=["c"], upper=["C"], trim=["c"]).first()["c"] == "AB"


def test_required_and_ranges(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (None, 7.0), (3, -1.0)], "k int, price double")
    assert rows(require(df, ["K", "price"])) == [(1, 5.0), (3, -1.0)]
    assert require(df, []).count() == 4
    assert rows(within_ranges(df, {"price": [0, None]}).select("price")) == [(5.0,), (7.0,)]
    assert within_ranges(df, {"price": [None, None]}).count() == 4


def test_booleans_without_a_map_stay(spark):
    df = spark.createDataFrame([("y",)], "flag string")
    assert columns_to_boolean(df, {"flag": {}}).first()["flag"] == "y"
    assert columns_to_boolean(df, {"flag": {"Y": True}}).first()["flag"] is True


def test_split_without_metadata(spark):
    df = spark.createDataFrame([(1, 2)], "a int, _m int")
    data, metadata = split_metadata(df, ["_M"])
    assert data.columns == ["a"] and metadata.columns == ["_m"]
    assert split_metadata(df, [])[1] is None


def test_copies_are_compared_null_safe_and_without_collisions(spark):
    data = [(None, "x", 3), (None, "x", 1), ("NULL", "x", 2), ("a||b", "c", 4), ("a", "b||c", 5)]
    df = spark.createDataFrame(data, "a string, b string, _seen int")
    assert rows(drop_exact_copies(df, ["_seen"])) == [
        ("NULL", "x", 2),
        ("a", "b||c", 5),
        ("a||b", "c", 4),
        (None, "x", 1),
    ]


def test_copies_with_several_excluded_columns_keep_one_whole_row(spark):
    data = [(1, "b", 1), (1, "a", 2), (2, "z", 9)]
    df = spark.createDataFrame(data, "k int, _file string, _seen int")
    assert rows(drop_exact_copies(df, ["_file", "_seen"])) == [(1, "a", 2), (2, "z", 9)]
    assert drop_exact_copies(drop_exact_copies(df)).count() == 3


def test_latest_breaks_ties_the_same_way_for_any_partitioning(spark):
    data = [("a", 1, "x"), ("a", 1, "y"), ("a", None, "z"), ("b", None, "q"), (None, 2, "n")]
    df = spark.createDataFrame(data, "k string, t int, v string")
    expected = [("a", 1, "y"), ("b", None, "q"), (None, 2, "n")]
    for n in (1, 3, 7):
        assert rows(latest_per_key(df.repartition(n), ["k"], "t")) == expected
    once = latest_per_key(df, ["k"], "t")
    assert rows(latest_per_key(once, ["k"], "t")) == rows(once)


def test_latest_version_of_text_times(spark):
    data = [("a", "2024-01-02", 1), ("a", "2024-01-10", 2), ("a", "soon", 3)]
    df = spark.createDataFrame(data, "k string, t string, v int")
    assert latest_version(df, ["K"], "T").first()["v"] == 2
    assert latest_version(df, [], "t").count() == 3
    assert latest_version(df, ["k"], None).count() == 3


def test_chain_drops_copies_and_old_versions(spark):
    at = datetime(2024, 1, 1)
    data = [
        ("s1", " Soap ", "5", at, 1, "f2"),
        ("s1", " Soap ", "5", at, 1, "f1"),
        ("s1", "old", "5", datetime(2023, 1, 1), 1, "f0"),
        ("s2", "x", "-1", at, 0, "f1"),
        ("s3", "x", "free", at, 0, "f1"),
        (None, "x", "1", at, 0, "f1"),
    ]
    df = spark.createDataFrame(
        data, "SKU string, kind string, Price string, t timestamp, ok int, _file string"
    )
    config = {
        "schema": {"price": "float"},
        "trim_columns": ["kind"],
        "upper_columns": ["KIND"],
        "required_columns": ["sku", "price"],
        "dedup_exclude_columns": ["_file"],
        "key_columns": ["SKU"],
        "timestamp_column": "t",
        "range_rules": {"price": [0, None]},
        "timestamp_columns": ["t"],
        "boolean_map": {"ok": {1: True}},
        "metadata_columns": ["_file"],
    }
    data, metadata = structural_clean(df, config)
    assert rows(data) == [("s1", "SOAP", 5.0, at, True)]
    assert rows(metadata) == [("f1",)]
    # Without keys only the copies go.
    no_keys, _ = structural_clean(df, {**config, "key_columns": []})
    assert no_keys.count() == 2
    # A timestamp that is not compared ranks what is left after the copies went.
    lineage, _ = structural_clean(df, {**config, "dedup_exclude_columns": ["_file", "t"]})
    assert rows(lineage.select("kind")) == [("SOAP",)]


def test_empty_config_only_drops_copies(spark):
    df = spark.createDataFrame([(1,), (1,)], "a int")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        data, metadata = structural_clean(df, None)
    assert data.count() == 1 and metadata is None
