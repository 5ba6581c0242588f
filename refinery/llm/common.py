"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.sinks.staging import shared_folder
from refinery.sinks.tables import _setting, delete_folder

#: Rows that a Python worker works on at once; bounds its memory.
ROWS = 256
#: Words that a Python worker remembers results of at most.
REMEMBERED = 800_000

_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def text_column(docs: DataFrame, text: str) -> Column:
    """The texts as strings; null is the empty text."""
    return F.coalesce(column_named(docs, text).cast("string"), F.lit("")).alias("text")


def earliest(known: dict) -> dict:
    """The half of ``known`` that was entered first, where the frequent words are."""
    return dict(islice(known.items(), len(known) // 2))


#: What this worker keeps from task to task for the operator that ran last.
_kept: dict = {}


def kept(key: tuple, build):
    """What ``build`` has made for ``key`` in this worker. A worker serves one stage after
    another; only one key is kept, or the memories of several operators would add up."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = build()
    return _kept[key]


def forget() -> None:
    """Free what an operator before has kept; for operators that keep nothing."""
    _kept.clear()


def stored(df: DataFrame, label: str = "rows") -> DataFrame:
    """``df`` written to a new Parquet folder below the shared folder, and read again.

    The files outlive lost executors and cut the lineage. They stay with the other
    checkpoints until that folder is cleaned. What the write has shuffled is removed with its
    end; the driver's garbage collection would leave it on the executors' disks for long.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"
    with _setting(spark, _SHUFFLES_GO, "true"):
        df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    rows.stored_in = path
    return rows


def discard(*frames: DataFrame) -> None:
    """Delete what ``stored`` has written for ``frames``, once nothing reads it any more."""
    for df in frames:
        delete_folder(df.sparkSession, df.stored_in)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The number of partitions that the session deals shuffles to."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; ``name`` may be a path of its own."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def column_named(df: DataFrame, name: str) -> Column:
    """A top-level column of ``df`` by its exact name, dots included."""
    return df[f"`{name}`"]


def unused_name(df: DataFrame, wanted: str, also: Iterable[str] = ()) -> str:
    """``wanted``, or with underscores before it, so that no column of ``df`` has the name."""
    taken = {c.lower() for c in [*df.columns, *also]}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def possibly_in(df: DataFrame, wanted: DataFrame, columns: list[str], bits: int = 1 << 23) -> DataFrame:
    """Rows of ``df`` whose ``columns`` may have values that occur in ``wanted``; never too few.

    What is broadcast is a bitmap of hashes, ``bits`` / 32 rows whatever the input, so a large
    ``df`` need not be shuffled for a join that keeps little of it.
    """
    place = F.pmod(F.xxhash64(*columns), F.lit(bits)).cast("int")
    word, bit = F.shiftright(place, 5), place.bitwiseAND(F.lit(31))
    name, held = unused_name(df, "bitmap_word"), unused_name(df, "bitmap_held")
    bitmap = wanted.groupBy(word.alias(name)).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias(held)
    )
    found = df.join(F.broadcast(bitmap), word == F.col(name))
    return found.where(F.call_function("shiftright", F.col(held), bit).bitwiseAND(F.lit(1)) == 1).drop(name, held)


def components(links: DataFrame, label: str = "components", rounds: int = 60) -> DataFrame:
    """Smallest id that each linked id reaches.

    ``links`` has two columns of ids, one row per undirected link, ids not null. Returns
    ``(node, root)`` with a row for every id that occurs in a link between different ids.

    Alternates between hanging all larger neighbours of a node on its smallest neighbour,
    and hanging all smaller ones on it; the number of links never grows and the rounds are
    logarithmic in practice. Each round is stored, so that a lost executor costs one round.
    """
    spark = links.sparkSession
    one, two = links.columns
    u, v = F.col(one), F.col(two)
    edges = stored(
        links.where(u != v).select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).distinct(), label
    )
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select("b", "a"))
        smallest = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        # Larger neighbours move to the smallest of the neighbourhood.
        large = (
            both.join(smallest, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        large = stored(large.distinct(), label)
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        # Smaller neighbours move to the smallest, and so does the node itself.
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))).alias("e")
        )
        edges = stored(small.select("e.a", "e.b").where("a <> b").distinct(), label)
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
    raise RuntimeError(f"components are not found in {rounds} rounds")
