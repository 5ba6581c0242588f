"""The pipeline stage by stage against brute force, and the queries against their SQL."""

import itertools

import pytest
from test_operators import brute_fingerprint, brute_lines, brute_windows, roots

import corpus_pipeline
from compare import difference, open_oracle
from refinery.llm import common, queries

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = common.read_table(spark, FOLDER, "documents")
    columns, held = docs.columns, {r.doc_id: r for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, FOLDER), name)
        rows = {r.doc_id: r for r in docs.collect()}
        kept[name] = (held, rows)
        assert docs.columns == columns or name == "encoding"
        held = rows
    texts = lambda rows: {i: r.text or "" for i, r in rows.items()}

    labels = {r.doc_id: r.quality for r in common.read_table(spark, FOLDER, "labels").collect()}
    before, after = kept["quality"]
    assert sum(i in after for i in before if labels.get(i) == 1) >= 0.95 * sum(labels.get(i) == 1 for i in before)

    before, after = kept["lines"]
    removed = brute_lines(texts(before))
    for i, r in before.items():
        left = "\n".join(x for n, x in enumerate((r.text or "").split("\n")) if n not in removed.get(i, ()))
        assert (after[i].text, after[i].n_chars) == (left, len(left)) if i in after else (removed[i] and not left.split())

    before, after = kept["copies"]
    prints = {i: brute_fingerprint(t) for i, t in texts(before).items()}
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    assert set(after) == {i for i, r in roots(prints, near).items() if i == r}

    before, after = kept["benchmark"]
    items = {r.item_id: r.text for r in common.read_table(spark, FOLDER, "benchmark").collect()}
    assert set(before) - set(after) == {d for d, _ in brute_windows(texts(before), items)}
    assert set(kept["encoding"][1]) == set(after)


def test_odd_documents(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (None, None, "x"), (2, "", "x"), (3, None, "x"), (4, "word " * 3000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, FOLDER))
        assert docs.columns == ["doc_id", "text", "n_lines"]
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER) if "text" in empty.columns else empty
        assert empty.count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_agrees_with_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), open_oracle(FOLDER), queries.ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", ["op3_preference_pairs", "op5_surrogates", "op6_benchmark_windows"])
def test_native_plans(spark, name):
    plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Arrow", "Pandas", "ExistingRDD", "CartesianProduct", "NestedLoopJoin"):
        assert node not in plan
