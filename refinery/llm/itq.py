"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

A rotation of the principal components is learned that brings the vectors close to the
corners of a cube; the signs are balanced binary codes. Codes are cut into segments; vectors
meet where a segment agrees but for one bit, pairs whose whole codes are too far apart are
dropped, the rest is ranked again by the cosine of the original vectors.

Equal vectors are one class, which is compared once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import column_named, components, stored

#: Vectors that the rotation is learned from, at most.
SAMPLE = 20_000
_ROUNDS = 40
_SEGMENTS = 5


def learn_rotation(sample: np.ndarray, bits: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection of unit vectors: principal components, rotated so that the signs
    lose least. At most ``bits`` columns."""
    mean = sample.mean(0)
    centred = sample - mean
    values, vectors = np.linalg.eigh(centred.T @ centred)
    principal = vectors[:, np.argsort(values)[::-1][: min(bits, sample.shape[1])]]
    projected = centred @ principal
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((principal.shape[1],) * 2))[0]
    for _ in range(_ROUNDS):
        signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ projected)
        rotation = right.T @ left.T
    return mean, principal @ rotation


def _padded(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as unit vectors, shorter ones with zeros after them."""
    lengths = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), width))
    flat = np.asarray(column.flatten(), np.float64)
    out[np.repeat(np.arange(len(column)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    scale = np.abs(out).max(1, keepdims=True)
    out /= np.where(scale > 0, scale, 1)  # else squares of very small or large numbers fail
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-300)


def _cosines(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Cosines of rows of equal lengths, in double precision."""
    x, y = (np.asarray(c.flatten(), np.float64) for c in (a, b))
    starts = np.asarray(a.offsets)[:-1] - a.offsets[0].as_py()
    add = lambda v: np.add.reduceat(v, starts) if len(v) else np.zeros(0)
    with np.errstate(over="ignore", invalid="ignore"):
        cosine = add(x * y) / (np.sqrt(add(x * x)) * np.sqrt(add(y * y)))
    if np.isfinite(cosine).all():
        return cosine
    for i in np.flatnonzero(~np.isfinite(cosine)):  # squares out of range
        u, v = (np.asarray(c[i].as_py(), np.float64) for c in (a, b))
        u, v = u / np.abs(u).max(), v / np.abs(v).max()
        cosine[i] = u @ v / (np.sqrt(u @ u) * np.sqrt(v @ v))
    return cosine


def _codes(vectors: DataFrame, bits: int, sample: int) -> DataFrame:
    """Adds ``code`` (long), the binary code of every class of vectors."""
    width = vectors.agg(F.max("dim")).first()[0]
    if width is None:
        return vectors.withColumn("code", F.lit(0).cast("long"))
    picked = vectors.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("embedding").toArrow()
    column = picked.column(0).combine_chunks()
    mean, projection = learn_rotation(_padded(column, width), bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signs = (_padded(batch.column("embedding"), width) - mean) @ projection >= 0
            packed = np.zeros((len(signs), 64), np.uint8)
            packed[:, : signs.shape[1]] = signs
            code = np.packbits(packed, axis=1, bitorder="little").view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], [*names, "code"])

    names = vectors.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema)
    return vectors.mapInArrow(run, f"{schema}, code long")


def near_pairs(classes: DataFrame, bits: int, radius: int) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of classes (rep, label, dim, code) of one label and length whose
    codes share a segment but for one bit and differ in ``radius`` bits at most. Each once."""
    bounds = [round(i * bits / _SEGMENTS) for i in range(_SEGMENTS + 1)]
    segments = [(low, high, (1 << high) - (1 << low)) for low, high in zip(bounds, bounds[1:]) if high > low]
    signed = lambda v: F.lit(v - (1 << 64) if v >> 63 else v).cast("long")
    key = ["label", "dim", "segment", "part"]
    struct = lambda i, part: F.struct(F.lit(i).alias("segment"), part.alias("part"))
    code = F.col("code")
    whole = F.array(*[struct(i, code.bitwiseAND(signed(m))) for i, (_, _, m) in enumerate(segments)])
    flipped = F.array(
        *[
            struct(i, code.bitwiseAND(signed(m)).bitwiseXOR(signed(0 if k is None else 1 << k)))
            for i, (low, high, m) in enumerate(segments)
            for k in [None, *range(low, high)]
        ]
    )
    table = lambda keys, name: classes.select("label", "dim", F.col("rep").alias(name), F.col("code").alias(f"{name}_code"), F.explode(keys).alias("k")).select("label", "dim", name, f"{name}_code", "k.*")
    differ = F.col("a_code").bitwiseXOR(F.col("b_code"))
    # Only the first segment that brings a pair together counts.
    earlier = F.lit(False)
    for i, (_, _, m) in enumerate(segments):
        earlier = earlier | ((F.lit(i) < F.col("segment")) & (F.bit_count(differ.bitwiseAND(signed(m))) <= 1))
    met = table(flipped, "a").join(table(whole, "b"), key)
    return met.where((F.col("a") < F.col("b")) & (F.bit_count(differ) <= radius) & ~earlier).select("a", "b")


def embedding_groups(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str | None = "label",
    threshold: float = 0.98,
    bits: int = 64,
    radius: int = 18,
    sample: int = SAMPLE,
) -> DataFrame:
    """Returns the id column, ``n_links`` (long), ``component_id`` and ``kept`` of every row.

    Rows are linked if their labels are equal and not null and the cosine of their vectors, in
    double precision, is ``threshold`` or more. ``n_links`` counts the other rows linked
    directly, ``component_id`` is the smallest id reachable, ``kept`` says whether it is the
    row's own. Vectors that are null, empty, zero or hold a null or a number that is not finite
    link with nothing, nor do vectors of different lengths or rows with a null id, whose
    component is null and which are kept. Rows that repeat an id with the same vector and label
    count as rows of their own in ``n_links``. Without ``label`` all rows are compared.

    The rotation is learned from up to ``sample`` different vectors, picked by a hash of their
    ids; all vectors are indexed. Pairs whose codes differ too much are missed: at a cosine of
    0.98 a bit differs with probability 0.064, and fewer than 1 of 1,000 pairs is lost.
    """
    own = column_named(vectors, label).cast("string") if label else F.lit("")
    rows = vectors.select(
        column_named(vectors, id_column).cast("long").alias("id"),
        own.alias("label"),
        column_named(vectors, vector).cast("array<double>").alias("embedding"),
    )
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    rows = rows.select("id", F.when(usable, F.col("label")).alias("label"), F.when(usable, F.col("embedding")).alias("embedding"), usable.alias("usable"))
    good = rows.where("usable")
    classes = good.groupBy("label", "embedding").agg(F.min("id").alias("rep_id"), F.count("*").alias("copies"))
    classes = classes.select(F.struct("rep_id", F.xxhash64("label", "embedding").alias("h")).alias("rep"), "rep_id", "label", F.size("embedding").alias("dim"), "copies", "embedding")
    # An id that has several vectors is several classes: the hash tells them apart.
    # Shifted to be positive, ids sort as text as they do as numbers.
    shift = F.expr("9223372036854775808BD")
    name = F.concat_ws("/", F.lpad((F.col("rep_id") + shift).cast("decimal(20,0)").cast("string"), 20, "0"), F.hex("rep.h"))
    classes = stored(classes.withColumn("rep", name), "vectors")
    coded = stored(_codes(classes.select("rep", "label", "dim", "embedding"), bits, sample).drop("embedding"), "codes")
    pairs = stored(near_pairs(coded, bits, radius), "vector-pairs")
    side = classes.select("rep", "embedding")
    both = pairs.join(side.withColumnsRenamed({"rep": "a", "embedding": "x"}), "a").join(side.withColumnsRenamed({"rep": "b", "embedding": "y"}), "b")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4_096):
                part = batch.slice(at, 4_096)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(_cosines(part.column(2), part.column(3)))], ["a", "b", "cosine"])

    ranked = both.select("a", "b", "x", "y").mapInArrow(rank, "a string, b string, cosine double")
    links = stored(ranked.where(F.col("cosine") >= threshold).select("a", "b"), "vector-links")
    ends = links.select(F.col("a").alias("rep"), F.col("b").alias("other")).union(links.select("b", "a"))
    sizes = classes.select(F.col("rep").alias("other"), F.col("copies").alias("n"))
    linked = ends.join(sizes, "other").groupBy("rep").agg(F.sum("n").alias("others"))
    roots = components(links, "vector-roots").withColumnsRenamed({"node": "rep"})
    per_class = (
        classes.select("rep", "rep_id", "label", "embedding", "copies")
        .join(linked, "rep", "left")
        .join(roots, "rep", "left")
        .select(
            "label", "embedding",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"),
            F.coalesce((F.substring_index("root", "/", 1).cast("decimal(20,0)") - shift).cast("long"), F.col("rep_id")).alias("component_id"),
        )
    )
    found = good.join(per_class, ["label", "embedding"]).select("id", "n_links", "component_id")
    alone = rows.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return found.union(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
