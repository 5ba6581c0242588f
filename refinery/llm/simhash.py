"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints that differ in at most ``radius`` bits are cut into ``radius // 2 + 1`` segments,
so that one segment differs in one bit at most. Every segment is indexed whole and with each
of its bits wiped out in turn; two segments share such a key exactly if they differ in one
bit at most. Pairs with a key in common are verified over all bits.

Only different fingerprints are compared, copies go along with theirs. In a bucket, first
every fingerprint is verified against the smallest one; those near to it hang together
already, so only the others are compared with the whole bucket. No link is lost for the
components, and a ball of near copies does not give all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import ROWS, column_named, components, partitions, possibly_in, stored, text_column

_BITS = 64
#: Shingles whose bits are counted at once.
_BLOCK = 8_192


def _fingerprint(words: list[bytes], size: int, seed: int) -> int:
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - size + 1)
    if n == 1:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
        starts = [0, *(e + 1 for e in ends[:-1])]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[size - 1 :])]
    counts = np.zeros(_BITS, np.int64)
    for at in range(0, n, _BLOCK):
        block = np.array(hashes[at : at + _BLOCK], np.uint64)
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = 3, seed: int = 42) -> DataFrame:
    """Returns the id column and ``bits`` (long): the 64-bit SimHash of every row's text.

    A-Z are lower-cased; words are what ASCII white space separates; shingles of ``size``
    words, repeats included, are hashed by XXH64 with ``seed``. A shorter text is one
    shingle, one without words (empty, null) has fingerprint zero. Texts are read whole.
    """
    source = docs.select(column_named(docs, id_column).alias(id_column), text_column(docs, text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                bits = [_fingerprint(t.as_py().encode().lower().split(), size, seed) for t in part.column(1)]
                signed = pa.array(np.array(bits, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), signed], [id_column, "bits"])

    return source.mapInArrow(run, f"`{id_column}` {source.schema[0].dataType.simpleString()}, bits long")


def _variants(bits: Column, radius: int) -> Column:
    """Keys of a fingerprint: (segment and wiped position, what is left)."""
    parts = radius // 2 + 1
    bounds = [round(i * _BITS / parts) for i in range(parts + 1)]
    keys = []
    for low, high in zip(bounds, bounds[1:]):
        mask = (1 << high) - (1 << low)
        for wiped in [None, *range(low, high)]:
            left = mask if wiped is None else mask & ~(1 << wiped)
            signed = left - (1 << 64) if left >> 63 else left
            place = low * 128 + (0 if wiped is None else wiped + 1)
            keys.append(F.struct(F.lit(place).alias("place"), bits.bitwiseAND(F.lit(signed).cast("long")).alias("left")))
    return F.array(*keys)


def _keyed(prints: DataFrame, radius: int) -> DataFrame:
    """Every fingerprint with each of its keys.

    The fingerprints are few bytes; dealt out anew, their many keys are made by all tasks. By
    ``bits`` itself Spark would drop the step after a ``distinct`` and join small partitions.
    """
    dealt = prints.repartition(partitions(prints.sparkSession), F.xxhash64("bits"))
    return dealt.select("bits", F.explode(_variants(F.col("bits"), radius)).alias("key")).select("bits", "key.*")


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def fingerprint_links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Links ``(a, b)`` between different fingerprints, enough for their components.

    ``prints`` has one column ``bits`` without repeats. Every link is a pair that differs in at
    most ``radius`` bits, and any such pair is connected by links.
    """
    keyed = _keyed(prints, radius)
    # Buckets of one are dropped before anything is joined; the counts are combined early.
    hubs = stored(
        keyed.groupBy("place", "left").agg(F.min("bits").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "simhash-buckets",
    )
    shared = possibly_in(keyed, hubs, ["place", "left"])
    member = stored(shared.join(hubs, ["place", "left"]).where("bits <> hub"), "simhash-members")
    near_hub = _distance(F.col("bits"), F.col("hub")) <= radius
    first = member.where(near_hub).select(F.col("bits").alias("a"), F.col("hub").alias("b"))
    far = member.where(~near_hub).select("place", "left", F.col("bits").alias("a"))
    rest = (
        far.join(member.select("place", "left", F.col("bits").alias("b")), ["place", "left"])
        .where((F.col("a") != F.col("b")) & (_distance(F.col("a"), F.col("b")) <= radius))
        .select("a", "b")
    )
    return first.union(rest).distinct()


def simhash_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = 3, radius: int = 3, seed: int = 42
) -> DataFrame:
    """Returns the id column, ``fingerprint`` (16 hex digits) and ``component_id`` of every row:
    the smallest id among the rows reached by links of at most ``radius`` differing bits.

    Rows with equal fingerprints are linked, those without words too. Repeated rows are
    repeated; a null id never is the smallest of a component with other ids, and the
    component of null ids alone is null. An empty table stays empty, other columns are
    ignored.
    """
    prints = stored(fingerprints(docs, id_column, text, size, seed), "simhash")
    lowest = prints.groupBy("bits").agg(F.min(id_column).alias("low"))
    found = stored(components(fingerprint_links(prints.select("bits").distinct(), radius), "simhash-links"), "simhash-roots")
    # The smallest id of each component of fingerprints.
    in_group = lowest.join(found.withColumnRenamed("node", "bits"), "bits")
    least = in_group.groupBy("root").agg(F.min("low").alias("least"))
    linked = in_group.join(least, "root").select("bits", "least")
    # One row per fingerprint; large classes of copies are joined by skew-proof joins.
    ids = lowest.join(linked, "bits", "left").select("bits", F.coalesce("least", "low").alias("component_id"))
    return prints.join(ids, "bits").select(
        id_column, F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )
