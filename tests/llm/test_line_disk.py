"""What the line operator leaves on disks while it runs."""

import time

import numpy as np
from test_operators import brute_lines

from refinery.llm import common, line_dedup


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_stored_rows_leave_no_shuffle(spark):
    before = _shuffle_files(spark)
    source = spark.range(1000).repartition(4, "id")
    assert source.count() == 1000 and _shuffle_files(spark) - before  # the listing sees shuffles that are there
    before = _shuffle_files(spark)
    common.stored(source.groupBy((source.id % 7).alias("k")).count())
    for _ in range(100):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before


def test_long_lists_are_met_share_by_share(spark, monkeypatch):
    """Each share of the tokens is met by itself; together they find all lines."""
    labels, store = [], line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, label="rows": labels.append(label) or store(df, label))
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(w if rng.random() > 0.07 else words[rng.integers(200)] for w in words[:15])) for i in range(160)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: set(r.removed) for r in line_dedup.repeated_lines(frame).collect()}
    assert got == brute_lines(dict(rows)) and got
    assert labels.count("line-met") == line_dedup.PASSES > 1
