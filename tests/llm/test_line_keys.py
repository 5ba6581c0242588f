"""Lists of the line operator: short for lines that only share frequent words, whole for near copies."""

import numpy as np
from test_operators import brute_lines

from refinery.llm import line_dedup


def _removed(spark, monkeypatch, rows):
    """The removed lines, and the number of rows of lists too long to be paired."""
    long, store = [], line_dedup.stored

    def seen(df, label="rows"):
        out = store(df, label)
        if label == "line-pairs":
            long.append(out.where("doc2 is null").count())
        return out

    monkeypatch.setattr(line_dedup, "stored", seen)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r.doc_id: set(r.removed) for r in line_dedup.repeated_lines(frame).collect()}, sum(long)


def test_frequent_words_make_no_long_lists(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(120)])
    lines = [" ".join(rng.choice(words, 20, replace=False)) for _ in range(1_500)]
    lines += [x.rsplit(" ", 1)[0] + " w7" for x in lines[:60]]
    rows = list(enumerate(lines))
    got, long = _removed(spark, monkeypatch, rows)
    assert got == brute_lines(dict(rows)) and len(got) >= 60
    assert long == 0


def test_long_list_of_near_copies(spark, monkeypatch):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(w if rng.random() > 0.08 else words[rng.integers(400)] for w in words[: 24 + i % 9])) for i in range(700)]
    got, long = _removed(spark, monkeypatch, rows)
    assert got == brute_lines(dict(rows)) and 400 < len(got) < 700
    assert long > line_dedup.SHORT
