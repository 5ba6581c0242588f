import time
from datetime import UTC, datetime, timedelta

import pytest
from support import rows
from pyspark.sql import functions as F

from refinery.operators.incremental import (
    STATE_DDL,
    advance_mark,
    current_marks,
    high_water_mark,
    highest,
    last_mark,
    newer_than,
)
from refinery.operators.rules import Run, failed_records, summarise
from refinery.plans.quality import QualityGateClosed, require_passed, run_quality
from refinery.sinks import quality
from refinery.sinks.staging import one_process, clear_stage, shared_folder, stage, staging
from refinery.sinks.tables import (
    CONFLICTS,
    append,
    append_evolving,
    delete_folder,
    ensure_schemas,
    ensure_table,
    publish_table,
    publish_table_view,
    publish_view,
    replace_table,
    table_exists,
)

RULES = [
    {"rule_id": "v", "column": "v", "rule_type": "not_null", "severity": "error", "description": "d"},
    {"rule_id": "u", "column": "k", "rule_type": "unique", "severity": "error", "description": "d"},
    {
        "rule_id": "w",
        "column": "k",
        "rule_type": "range",
        "severity": "warning",
        "description": "d",
        "params": {"max": 2},
    },
]


# --- staging ---------------------------------------------------------------------------


def test_staged_rows_lie_in_the_shared_folder_and_go_away(spark):
    with staging(spark) as keep:
        staged = keep(spark.range(5), "numbers")
        (file,) = {f.rsplit("/", 2)[0] for f in staged.inputFiles()}
        assert shared_folder(spark) in file and staged.count() == 5
    assert spark.sql("SHOW TABLES IN refinery_stage LIKE 'numbers*'").count() == 0


def test_staged_rows_go_away_on_failure(spark):
    with pytest.raises(RuntimeError), staging(spark) as keep:
        keep(spark.range(5), "failing")
        raise RuntimeError
    assert spark.sql("SHOW TABLES IN refinery_stage LIKE 'failing*'").count() == 0


def test_the_session_names_the_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    name = stage(spark.range(1), "lasting").inputFiles()[0]
    assert shared_folder(spark) in name
    assert clear_stage(spark) >= 1
    assert spark.sql("SHOW TABLES IN refinery_stage LIKE 'lasting*'").count() == 0


# --- tables ----------------------------------------------------------------------------


def test_schemas_and_tables_are_created_once(spark, new_table):
    for _ in range(2):
        names = ensure_schemas(spark, "dev", "shop", ("bronze", "gold"))
    assert names == ["shop_dev_bronze", "shop_dev_gold"]
    name = new_table()
    assert not table_exists(spark, name)
    for _ in range(2):
        ensure_table(spark, name, "a INT COMMENT 'first'", "about", {"team": "data"})
    described = spark.sql(f"DESCRIBE TABLE {name}").collect()
    assert (described[0]["col_name"], described[0]["comment"]) == ("a", "first")


def test_append_bounds_the_files(spark, new_table):
    name = new_table()
    append(spark.range(100).coalesce(1), name, rows_per_file=30)
    append(spark.range(1).coalesce(1), name)
    assert spark.table(name).count() == 101 and len(spark.table(name).inputFiles()) == 5


def test_evolving_append_keeps_everything(spark, new_table):
    name = new_table()
    append_evolving(spark.createDataFrame([(1, "a")], "id int, v string"), name)
    append_evolving(spark.createDataFrame([(2, 9, 0.5)], "id int, V int, extra double"), name)
    append_evolving(spark.createDataFrame([(3,)], "id int"), name)
    assert spark.table(name).columns == ["id", "v", "extra", CONFLICTS]
    assert rows(spark.table(name)) == [
        (1, "a", None, None),
        (2, None, 0.5, '{"V":9}'),
        (3, None, None, None),
    ]


def test_nested_fields_grow(spark, new_table):
    name = new_table()
    append_evolving(spark.sql("SELECT 1 AS id, named_struct('a', 1, 'in', named_struct('x', 'u')) AS s, map('k', named_struct('p', 1)) AS m, array(1) AS l"), name)
    files = set(spark.table(name).inputFiles())
    append_evolving(
        spark.sql(
            "SELECT 2 AS id, named_struct('A', 'text', 'in', named_struct('y', 2.5D), 'new', true) AS s, "
            "map('k', named_struct('q', 7)) AS m, array('bad', null) AS l, named_struct('n', 1) AS other"
        ),
        name,
    )
    append_evolving(spark.sql("SELECT 3 AS id, CAST(null AS struct<a: tinyint>) AS s, map('k', CAST(null AS struct<p: int>)) AS m"), name)
    assert files < set(spark.table(name).inputFiles())  # only the definition has changed
    got = {r.id: r for r in spark.table(name).selectExpr("id", "to_json(s) s", "to_json(m) m", "l", "to_json(other) o", CONFLICTS).collect()}
    assert (got[1].s, got[1].m, got[1].l, got[1].o, got[1][CONFLICTS]) == ('{"a":1,"in":{"x":"u"}}', '{"k":{"p":1}}', [1], None, None)
    assert (got[2].s, got[2].m) == ('{"in":{"y":2.5},"new":true}', '{"k":{"q":7}}')
    assert (got[2].l, got[2].o, got[2][CONFLICTS]) == ([None, None], '{"n":1}', '{"s":{"A":"text"},"l":["bad",null]}')
    assert (got[3].s, got[3].l, got[3][CONFLICTS]) == (None, None, None)


def test_nested_fields_grow_in_a_table_of_another_writer(spark, new_table):
    name = new_table()
    spark.sql("SELECT 1 AS id, named_struct('a', 1) AS s").write.format("parquet").saveAsTable(name)
    for n in (2, 3):
        append_evolving(spark.sql(f"SELECT {n} AS id, named_struct('b{n}', 'it''s') AS s"), name)
    assert rows(spark.table(name).selectExpr("id", "s.a", "s.b2", "s.b3")) == [(1, 1, None, None), (2, None, "it's", None), (3, None, None, "it's")]


def test_comments_are_escaped(spark, new_table):
    name = new_table()
    ensure_table(spark, name, "a int", "it's a \\ table", {"owner's": "a'b"})
    assert table_exists(spark, name)


def test_replace_while_reading_the_same_table(spark, new_table):
    name = new_table()
    first = replace_table(spark.range(3).toDF("n"), name)
    second = replace_table(spark.table(name).where("n > 0"), name)
    assert rows(spark.table(name)) == [(1,), (2,)]
    assert spark.read.parquet(first).count() == 3
    assert delete_folder(spark, first) and spark.read.parquet(second).count() == 2
    replace_table(spark.table(name).withColumn("m", F.lit("x")), name)
    assert rows(spark.table(name)) == [(1, "x"), (2, "x")]
    replace_table(spark.table(name), name, partition_by=["m"])
    assert rows(spark.table(name)) == [(1, "x"), (2, "x")]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 1


def test_published_tables_and_views(spark, new_table):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    name, view = new_table(), new_table("view")
    assert publish_table(df, name, "about").count() == 1
    assert publish_table_view(spark, name, ["C", "a"], view).columns == ["c", "a"]
    assert publish_view(df, ["b"], "session_view").columns == ["b"]
    with pytest.raises(ValueError, match="nowhere"):
        publish_view(df, ["nowhere"], "session_view")


# --- marks -----------------------------------------------------------------------------


def test_marks(spark, new_table):
    state = new_table("state")
    ensure_table(spark, state, STATE_DDL)
    t1, t2 = datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 2, 1, tzinfo=UTC)
    assert last_mark(spark.table(state), "p", "e") is None
    assert not advance_mark(state, "p", "e", None, spark.table(state))
    assert advance_mark(state, "p", "e", t2, spark.table(state))
    advance_mark(state, "p", "other", t1, spark.table(state))
    advance_mark(state, "q", "e", t1, spark.table(state))
    assert last_mark(spark.table(state), "p", "e") == t2
    # The newest row counts, even if it goes back in time (a deliberate reload).
    advance_mark(state, "p", "e", t1, spark.table(state))
    assert last_mark(spark.table(state), "p", "e") == t1
    assert last_mark(spark.table(state), "p", "e", full_load=True) is None
    assert current_marks(spark.table(state)).count() == 3


def test_newer_rows(spark):
    times = [datetime(2024, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp").withColumn(
        "day", F.to_date("t")
    )
    assert newer_than(df, "t", None).count() == 3
    assert newer_than(df, "t", times[1]).count() == 1
    assert newer_than(df, "t", times[1], overlap=timedelta(seconds=1)).count() == 2
    assert newer_than(df, "t", times[0], upto=times[1], date_partition="day").count() == 1
    assert high_water_mark(df, "t").first()["last_run"] == times[2]
    assert high_water_mark(df.where("false"), "t").first()["last_run"] is None
    assert highest(df.where("false"), "t") is None
    assert newer_than(df, "t", highest(df.where("day < '2024-01-03'"), "t")).count() == 1


def test_marks_survive_the_end_of_summer_time(spark, new_table, monkeypatch):
    """02:30 happens twice on that day in Berlin; the mark stays on the right one."""
    state = new_table("state")
    ensure_table(spark, state, STATE_DDL)
    monkeypatch.setenv("TZ", "Europe/Berlin")
    time.tzset()
    try:
        for hour in (0, 1):
            mark = datetime(2024, 10, 27, hour, 30, tzinfo=UTC)
            advance_mark(state, "p", "e", mark, spark.table(state))
            assert last_mark(spark.table(state), "p", "e") == mark
            assert highest(spark.table(state), "last_run") == mark
    finally:
        monkeypatch.undo()
        time.tzset()


# --- quality tables --------------------------------------------------------------------


@pytest.fixture(scope="module")
def frame(spark):
    data = [(1, "a"), (2, None), (3, "b"), (3, "c")]
    return spark.createDataFrame(data, "k int, v string")


def test_quality_run(spark, frame, new_table):
    report, quarantine = new_table("report"), new_table("quarantine")
    run = Run("pipe", "src")
    verdict = run_quality(spark, RULES, run, report, quarantine, frame)
    assert verdict == {
        "run_id": run.run_id,
        "pipeline_name": "pipe",
        "source_table": "src",
        "total_rules": 3,
        "error_failures": 2,
        "warning_failures": 1,
        "has_errors": True,
        "has_warnings": True,
        "passed": False,
    }
    with pytest.raises(QualityGateClosed, match=run.run_id):
        require_passed(verdict)
    assert spark.table(report).count() == 3
    held = spark.table(quarantine)
    assert rows(held.select("rule_id", "k", "v")) == [("u", 3, "b"), ("u", 3, "c"), ("v", 2, None)]
    failed = spark.table(report).where("severity = 'error'").agg(F.sum("failed_records")).first()[0]
    assert held.count() == failed

    # A second source with other columns goes to the same tables.
    other = spark.createDataFrame([(None, 1.5)], "v string, extra double")
    run_quality(spark, RULES[:1], Run("pipe2", "src2"), report, quarantine, other)
    assert spark.table(quarantine).where("extra = 1.5 AND k IS NULL").count() == 1
    assert spark.table(report).select("run_id").distinct().count() == 2

    # Resolution of one run and rule; nothing is deleted.
    log = new_table("resolutions")
    quality.resolve(spark, log, run.run_id, "u", "first note")
    quality.resolve(spark, log, run.run_id, "u", "merged")
    state = quality.with_resolutions(spark.table(quarantine), spark.table(log))
    assert state.columns == spark.table(quarantine).columns
    assert rows(state.select("rule_id", "resolved", "resolved_note")) == [
        ("u", True, "merged"),
        ("u", True, "merged"),
        ("v", False, None),
        ("v", False, None),
    ]


def test_clean_run_leaves_the_quarantine_empty(spark, frame, new_table):
    report, quarantine = new_table("report"), new_table("quarantine")
    verdict = run_quality(spark, RULES, Run(), report, quarantine, frame.where("k = 1"))
    assert verdict["passed"] and require_passed(verdict)
    assert spark.table(quarantine).count() == 0 and spark.table(report).count() == 3
    assert len(spark.table(quarantine).columns) == 15


def test_rules_over_a_table(spark, frame, new_table):
    name = new_table("source")
    frame.write.saveAsTable(name)
    run = Run(source_table=name)
    assert not run_quality(spark, RULES, run, new_table("r"), new_table("q"))["passed"]


def test_report_lines(frame):
    lines = quality.report_lines(summarise(frame, RULES, Run()))
    assert lines[0] == "FAIL u [error] 2 of 4 passed, 2 failed, 0 unknown"
    assert lines[-2:] == ["error rules with failures: 2", "warning rules with failures: 1"]


def test_quarantine_counts(frame, new_table):
    counted = quality.write_quarantine(failed_records(frame, RULES, Run()), new_table("q"))
    assert rows(counted) == [("u", "error", 2), ("v", "error", 1)]
    nothing = failed_records(frame.where("k = 1"), RULES, Run())
    assert quality.write_quarantine(nothing, new_table("q")) is None


def test_folder_where_the_session_names_none(spark):
    class Unnamed:
        sparkContext = spark.sparkContext

        class conf:
            @staticmethod
            def get(_key, default):
                return default

    own = shared_folder(Unnamed)
    assert own and own == shared_folder(Unnamed) != shared_folder(spark)


def test_temporary_folders_are_for_one_process_only():
    assert one_process("local") and one_process("local[*]") and one_process("local[8]")
    assert not any(map(one_process, ("local-cluster[3,2,1024]", "yarn", "spark://host:7077", "k8s://https://host")))
