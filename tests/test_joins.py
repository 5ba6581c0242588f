"""Lookup joins and upserts: both ways of a join give the same rows, whatever the skew."""

import random
from pathlib import Path

import pytest
from support import rows
from pyspark.sql import functions as F

from refinery.operators.enrich import lookup
from refinery.operators.skew import fits_broadcast, lookup_join, spread_join
from refinery.operators.upsert import merge_rows, replace_few
from refinery.sinks.tables import BUCKET, keyed_rows, upsert_table, with_bucket


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a fifth on null, full copies among them."""
    rng = random.Random(7)
    keys = [1] * 200 + [None] * 120 + [rng.randrange(2, 60) for _ in range(280)]
    data = [(k, rng.randrange(3)) for k in keys]
    return spark.createDataFrame(data, "k int, payload int").repartition(4)


@pytest.fixture(scope="module")
def keys(spark):
    return spark.range(0, 40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_both_ways_agree(skewed, keys, how, null_safe):
    right = keys.unionByName(keys.limit(1).select(F.lit(None).cast("int").alias("k"), F.lit(9).cast("long").alias("w")))
    spread = spread_join(skewed, right, "k", how, null_safe=null_safe, hot_rows=50, copies=5)
    small = lookup_join(skewed, right, "k", how, null_safe=null_safe)
    assert spread.columns == small.columns
    assert rows(spread) == rows(small)


def test_hot_keys_are_split(spark, skewed, keys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = spread_join(skewed, keys, "k", "left", hot_rows=50, copies=16)
        tasks = joined.withColumn("task", F.spark_partition_id())
        per_task = tasks.where("k = 1").groupBy("task").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in per_task) == 200
    assert len(per_task) > 2


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_any_number_of_hot_keys_is_split(spark, kind):
    """1,001 keys of 12 rows each, one of 400, and right keys of another type."""
    left = spark.range(1_001 * 12 + 400).selectExpr("IF(id < 12012, id % 1001, 5L) AS k", "id AS row")
    right = spark.range(1_500).selectExpr(f"CAST(id AS {kind}) AS k", "id * 2 AS w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = spread_join(left, right, "k", "left", hot_rows=10, copies=4)
        split = joined.withColumn("task", F.spark_partition_id()).groupBy("k").agg(F.count_distinct("task").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r.n > 1 for r in split) > 950 and max(r.n for r in split if r.k == 5) > 4
    assert joined.where("w = k * 2").count() == left.count()


def test_measured_size(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=100_000)
    assert fits_broadcast(df.where("false"), max_rows=0)


def test_name_clash_is_refused(spark):
    left = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="already exist"):
        lookup_join(left, left, "k")


def test_lookup_never_multiplies_facts(spark):
    facts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, f string")
    versions = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (None, "lost", 1)], "id int, name string, seen int"
    )
    expected = [(1, "a", "new"), (1, "b", "new"), (2, "c", None), (None, "d", None)]
    for options in ({}, {"max_rows": 0, "hot_rows": 2}):
        assert rows(lookup(facts, versions, "k", "id", "seen", **options)) == expected
    empty = versions.where("false")
    assert lookup(facts, empty, "k", "id", "seen").count() == 4


TARGET = [(1, "a", 5), (2, "b", 5), (3, "c", 5)]
UPDATES = [(2, "B", 6), (2, "B-old", 4), (3, "C", 3), (4, "D", 1)]


def test_upsert_once_and_twice(spark):
    target = spark.createDataFrame(TARGET, "id int, v string, ver int")
    updates = spark.createDataFrame(UPDATES, "id int, v string, ver int")
    once = merge_rows(target, updates, ["id"], "ver")
    expected = [(1, "a", 5), (2, "B", 6), (3, "c", 5), (4, "D", 1)]
    assert rows(once) == expected
    assert rows(merge_rows(once, updates, ["id"], "ver")) == expected
    unguarded = merge_rows(target, updates, ["id"])
    assert (3, "C", 3) in rows(unguarded) and unguarded.count() == 4


def test_upsert_with_new_columns(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    updates = spark.createDataFrame([(2, 7)], "id int, n int")
    assert rows(merge_rows(target, updates, ["id"])) == [(1, "a", None), (2, None, 7)]


@pytest.mark.parametrize("parts", [[], ["v"]])
def test_upsert_through_a_table(spark, new_table, parts):
    name = new_table("upsert")
    target = spark.createDataFrame(TARGET, "id int, v string, ver int")
    updates = spark.createDataFrame(UPDATES, "id int, v string, ver int")
    upsert_table(target, name, ["id"], "ver", partition_by=parts)
    for _ in range(2):
        upsert_table(updates, name, ["id"], "ver")
    assert rows(keyed_rows(spark, name).select("id", "v", "ver")) == [
        (1, "a", 5),
        (2, "B", 6),
        (3, "c", 5),
        (4, "D", 1),
    ]
    # A change computed from the table itself.
    own = keyed_rows(spark, name).where("id = 1").withColumn("ver", F.lit(8))
    upsert_table(own, name, ["id"], "ver")
    assert rows(keyed_rows(spark, name).where("id = 1").select("ver")) == [(8,)]
    assert keyed_rows(spark, name).count() == 4
    assert spark.sql("SHOW TABLES IN refinery_stage LIKE 'updates*'").count() == 0


def test_replaced_files_can_be_dropped(spark, new_table):
    name = new_table("dropped")
    upsert_table(spark.range(50).withColumn("v", F.lit(0)), name, ["id"])
    before = set(spark.table(name).inputFiles())
    change = spark.range(40, 60).withColumn("v", F.lit(1))
    upsert_table(change, name, ["id"], drop_previous=True)
    assert rows(spark.table(name).groupBy("v").count()) == [(0, 40), (1, 20)]
    assert not any(Path(f.removeprefix("file:")).exists() for f in before)


def test_untouched_partitions_keep_their_files(spark, new_table):
    name, keys = new_table("bucketed"), ["id", BUCKET]
    start = with_bucket(spark.range(200).select("id", F.lit("old").alias("v")), ["id"], 8)
    upsert_table(start, name, keys, partition_by=[BUCKET])
    before = set(spark.table(name).inputFiles())
    upsert_table(start.where("id = 5").withColumn("v", F.lit("new")), name, keys)
    after = set(spark.table(name).inputFiles())
    assert len(before & after) == 7 and len(after - before) == 1
    assert rows(spark.table(name).groupBy("v").count()) == [("new", 1), ("old", 199)]


@pytest.mark.parametrize("few", [True, False])
def test_rows_move_between_partitions(spark, new_table, monkeypatch, few):
    if not few:
        monkeypatch.setattr("refinery.sinks.tables.fits_broadcast", lambda df: False)
    name = new_table("moved")
    schema = "id int, v string, ver int, p string, q int"
    upsert_table(spark.createDataFrame([(1, "a", 1, "x", 1), (2, "b", 1, "x", 2), (3, "c", 5, None, 1)], schema), name, ["id"], "ver", partition_by=["p", "q"])
    moved = spark.createDataFrame([(1, "A", 2, "y", 1), (3, "old", 4, "y", 1), (4, "d", 1, None, 9), (None, "n", 1, "x", 2)], schema)
    for _ in range(2):
        upsert_table(moved, name, ["id"], "ver")
        assert rows(spark.table(name).select("id", "v", "p", "q")) == [(1, "A", "y", 1), (2, "b", "x", 2), (3, "c", None, 1), (4, "d", None, 9), (None, "n", "x", 2)]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 4  # x/1 is empty and gone
    upsert_table(spark.createDataFrame([(3, "moves", 6, "y", 1)], schema), name, ["id"], "ver")
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 3  # so is null/1
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_wider_and_other_types(spark, new_table, parts):
    name = new_table("types")
    upsert_table(spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "id int, v int, p string"), name, ["id"], partition_by=parts)
    upsert_table(spark.createDataFrame([(2, 2**40, "a")], "id bigint, v bigint, p string"), name, ["id"])
    assert rows(spark.table(name).select("id", "v", "p")) == [(1, 1, "a"), (2, 2**40, "a")]
    upsert_table(spark.createDataFrame([(3, 7, "b")], "id int, V smallint, p string"), name, ["id"])
    assert dict(spark.table(name).dtypes)["v"] == "bigint"
    upsert_table(spark.createDataFrame([(3, "text", "b")], "id int, v string, p string"), name, ["id"])
    assert rows(spark.table(name).select("v")) == [("1",), ("1099511627776",), ("text",)]


def test_few_updates_leave_the_target_unshuffled(spark, new_table):
    name = new_table("few")
    upsert_table(spark.range(100).withColumn("v", F.lit(0)), name, ["id"])
    merged = replace_few(spark.table(name), spark.range(5).withColumn("v", F.lit(1)), ["id"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("FileScan") == 1
    assert merged.where("v = 1").count() == 5 and merged.count() == 100
