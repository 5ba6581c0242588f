"""What op7 remembers and hands on stays bounded."""

import numpy as np
import pyarrow as pa

from refinery.llm import common, token_counts, vocabulary


def _data():
    with open(common.tokenizer_path("byte_bpe_50k.json"), "rb") as file:
        return file.read()


def test_pairs_that_fit_are_remembered_within_bounds(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 120)
    counter, rng = token_counts.Counter(vocabulary.load(_data())), np.random.default_rng(3)
    for _ in range(300):
        counter.prefix_counts("x " + "".join(rng.choice(list("abcdefghijklmnop"), 12)))
        assert len(counter.fits) <= 61 and len(counter.of_unit) <= 41


def test_batches_of_counts_are_handed_on_in_parts(spark, monkeypatch):
    counted = token_counts.token_counts(spark.createDataFrame([(1, "a")], "doc_id long, text string"), prefixes=True)
    taken = []
    monkeypatch.setattr(type(counted), "mapInArrow", lambda self, run, schema: taken.append(run))
    token_counts.fitting_prefix(counted, 3)
    n = 2 * common.ROWS + 5
    tables = [np.arange(i % 9 + 1, dtype="<i4").tobytes() for i in range(n)]
    whole = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([0] * n), pa.array([i % 9 for i in range(n)]), pa.array(tables)], counted.columns)
    parts = list(taken[0](iter([whole])))
    assert [p.num_rows for p in parts] == [common.ROWS, common.ROWS, 5]
    assert [v for p in parts for v in p.column(4).to_pylist()] == [min(3, i % 9) for i in range(n)]
    assert [v for p in parts for v in p.column(3).to_pylist()] == tables
