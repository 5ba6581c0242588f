"""From raw documents to token ids: quality, repeated lines, copies, benchmark leaks, encoding.

Every stage takes all that its predecessor kept. A document is its id: rows that repeat an
id share its fate, rows with a null id are never dropped. Extra columns are passed on until
the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm import bpe, decontaminate, line_dedup, quality, simhash
from refinery.llm.common import column_named, read_table, unused_name
from refinery.llm.queries import held_out, run_stages


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` but those whose id is in the only column of ``dropped``."""
    name = unused_name(docs, "dropped_id")
    ids = dropped.select(F.col(dropped.columns[0]).alias(name)).distinct()
    return docs.join(ids, column_named(docs, "doc_id") == F.col(name), "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    judged = quality.classify(docs, read_table(spark, sf_dir, "labels"), held_out)
    return _without(docs, judged.where("predicted = 0").select("doc_id"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that match an earlier one; those of which no word is left go."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    counts = {"n_lines", "n_removed"} & {c.lower() for c in others}
    hidden = {c: unused_name(docs, f"{c}_of_input") for c in others if c.lower() in counts}
    source = docs.withColumnsRenamed(hidden)
    done = line_dedup.dedup_lines(source, others=tuple(hidden.get(c, c) for c in others))
    left = done.where("n_removed = 0 or text rlike '[^ \\\\t-\\\\r]'").drop("n_lines", "n_removed")
    left = left.withColumnsRenamed({v: k for k, v in hidden.items()})
    if "n_chars" in others:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*[f"`{c}`" for c in docs.columns])


def copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose fingerprints are linked the one with the smallest id.

    The words, shingle length and radius are those of the operator's own query.
    """
    groups = simhash.simhash_groups(docs)
    return _without(docs, groups.where("doc_id <> component_id").select("doc_id"))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that is like an item of the benchmark."""
    found = decontaminate.contaminated_windows(docs, read_table(spark, sf_dir, "benchmark"))
    return _without(docs, found.select("doc"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) of what is left."""
    return bpe.encode(docs)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("copies", copy_stage),
    ("benchmark", benchmark_stage),
    ("encoding", encoding_stage),
]

#: No SQL has the tokenizer or the fingerprints; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_stages(spark, STAGES, read_table(spark, sf_dir, "documents"), sf_dir)
