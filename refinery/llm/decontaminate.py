"""Benchmark decontamination by SimHash over windows as long as the items.

A window of a document has as many words as a benchmark item. Windows that share no shingle
with an item cannot be similar to it and are never fingerprinted. The others get a SimHash;
fingerprints of windows and of items meet through multi-index blocks: they are cut into
``radius + 1`` blocks, so that any two within the radius share a block. Candidates are
verified by the weighted Jaccard similarity of their shingles (repeats count).

Everything is a DataFrame expression or a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import column_named, possibly_in, stored, text_column

SHINGLE = 5
#: Shingles of all items up to which they are broadcast; 16 bytes each.
BROADCAST_ROWS = 2_000_000
_LANES = 16  # bit counters per fingerprint column; each counts four bits


def _word_hashes(text: str) -> Column:
    """Hashes of the words: A-Z lower-cased, split at ASCII white space."""
    lower = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lower, r"[ \t-\r]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingles(words: str, size: int) -> Column:
    """Hashes of ``size`` words in a row; none where there are fewer words."""
    w, n = F.col(words), F.size(words)
    several = F.transform(
        F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)])
    )
    return F.when(n >= size, several).otherwise(F.array().cast("array<bigint>"))


def _fingerprint_sums(shingle: str, weight: str) -> list[Column]:
    """Sums from which the bits are read: each has four counters of 16 bits."""
    mask = 0x0001000100010001
    bits = lambda k: F.call_function("shiftrightunsigned", F.col(shingle), F.lit(k)).bitwiseAND(F.lit(mask))
    return [F.sum(bits(k) * F.col(weight)).alias(f"s{k}") for k in range(_LANES)]


def _fingerprint(count: str) -> Column:
    """The SimHash from the sums: a bit is set if more than half of the shingles have it."""
    out = F.lit(0).cast("long")
    for k in range(_LANES):
        for lane in range(4):
            ones = F.call_function("shiftrightunsigned", F.col(f"s{k}"), F.lit(16 * lane)).bitwiseAND(F.lit(0xFFFF))
            bit = F.when(ones * 2 > F.col(count), F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(k + 16 * lane)))
            out = out.bitwiseOR(F.coalesce(bit, F.lit(0).cast("long")))
    return out


def _blocks(bits: Column, radius: int) -> Column:
    """(number, content) of the blocks of a fingerprint."""
    bounds = [round(i * 64 / (radius + 1)) for i in range(radius + 2)]
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("block"),
                F.call_function("shiftrightunsigned", bits, F.lit(low)).bitwiseAND(F.lit((1 << (high - low)) - 1)).alias("part"),
            )
            for i, (low, high) in enumerate(zip(bounds, bounds[1:]))
        ]
    )


def _item_shingles(words: str, size: int) -> Column:
    """Shingles of an item; one that is shorter than a shingle is one of its own length."""
    whole = F.lit(None).cast("array<bigint>")
    for k in range(1, size):
        whole = F.when(F.size(words) == k, _shingles(words, k)).otherwise(whole)
    return F.when(F.size(words) >= size, _shingles(words, size)).otherwise(whole)


def _prints(grams: DataFrame, keys: list[str]) -> DataFrame:
    """Fingerprints of groups of shingles: ``keys``, ``gram`` and its ``weight`` in the group."""
    sums = grams.groupBy(*keys).agg(F.sum("weight").alias("total"), *_fingerprint_sums("gram", "weight"))
    return sums.select(*keys, _fingerprint("total").alias("bits"))


def contaminated_windows(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    similarity: float = 0.8,
    radius: int = 18,
    size: int = SHINGLE,
) -> DataFrame:
    """Returns ``doc``, ``item``, ``start`` (word of the document that the window begins with),
    ``n_words`` and ``similarity`` of every window that is like an item.

    A window is like an item if their fingerprints differ in ``radius`` bits at most and the
    weighted Jaccard similarity of their shingles of ``size`` words is ``similarity`` or more;
    a document shorter than the item is one window. Of windows at the similarity itself, 999
    in 1,000 are within the default radius, of more similar ones more.

    Texts are compared whole; A-Z are lower-cased, words end at ASCII white space. An item
    shorter than a shingle is one shingle of its length. Items without words, null texts and
    null ids match nothing; items with equal texts match alike. Rows with the same id are taken
    for one document and give the windows of each text. Items have less than 65,536 words.
    Empty tables give no rows; other columns are ignored.
    """
    bench = stored(
        items.select(column_named(items, item_column).alias("item"), text_column(items, item_text))
        .where("item is not null")
        .distinct()
        .withColumn("w", _word_hashes("text"))
        .where(F.size("w") > 0)
        .select("item", F.size("w").alias("n_words"), F.least(F.size("w"), F.lit(size)).alias("span"), _item_shingles("w", size).alias("grams"))
        .withColumn("n_grams", F.size("grams")),
        "items",
    )
    item_grams = stored(
        bench.select("item", "n_words", "span", "n_grams", F.explode("grams").alias("gram"))
        .groupBy("item", "n_words", "span", "n_grams", "gram")
        .agg(F.count("*").alias("weight")),
        "item-grams",
    )
    texts = docs.select(column_named(docs, id_column).alias("doc"), text_column(docs, text)).where("doc is not null")
    spans = sorted(r[0] for r in bench.select("span").distinct().collect())  # ``size`` rows at most
    small = item_grams.count() <= BROADCAST_ROWS
    held = (lambda df: F.broadcast(df)) if small else (lambda df: df)

    def shingled(source: DataFrame) -> DataFrame:
        """Per text and length of shingles: their hashes in order."""
        hashed = source.select("doc", _word_hashes("text").alias("w"))
        each = [F.struct(F.lit(k).alias("span"), _shingles("w", k).alias("grams")) for k in spans]
        if len(each) == 1:
            return hashed.select("doc", each[0].alias("s")).select("doc", "s.*")
        rows = F.explode_outer(F.array(*each) if each else F.array().cast("array<struct<span:int,grams:array<bigint>>>"))
        return hashed.select("doc", rows.alias("s")).select("doc", "s.*")

    # Explode with "outer": else Spark derives a filter that computes the shingles once more.
    grams = shingled(texts).select("doc", "span", F.size("grams").alias("n_doc"), F.posexplode_outer("grams").alias("at", "gram"))
    hits = stored(grams.join(held(item_grams.select("gram", "span").distinct()), ["gram", "span"], "left_semi"), "benchmark-hits")

    # Where a window of the item's length has shingles enough in common with it.
    least = F.ceil(2 * similarity / (1 + similarity) * F.col("n_grams") - 1e-9).cast("int")
    short = F.col("n_doc") < F.col("n_grams")  # then the window is the document
    need = F.when(short, F.ceil(similarity / (1 + similarity) * (F.col("n_grams") + F.col("n_doc")) - 1e-9).cast("int")).otherwise(least)
    shared = (
        hits.join(held(item_grams.drop("weight")), ["gram", "span"])
        .groupBy("doc", "n_doc", "item", "n_words", "span", "n_grams")
        .agg(F.array_sort(F.collect_set("at")).alias("ats"))
        .withColumn("need", need)
        .where(F.size("ats") >= F.col("need"))
    )
    # The i-th common shingle is the first one of the window, which reaches the last one needed.
    at = lambda i: F.get("ats", i)
    low = lambda i: F.greatest(
        F.lit(0), F.coalesce(at(i - 1) + 1, F.lit(0)), at(i + F.col("need") - 1) - F.col("n_grams") + 1
    )
    ranges = F.transform(
        F.sequence(F.lit(0), F.size("ats") - F.col("need")),
        lambda i: F.struct(low(i).alias("low"), F.least(at(i), F.greatest(F.lit(0), F.col("n_doc") - F.col("n_grams"))).alias("high")),
    )
    starts = (
        shared.select("doc", "n_words", "span", "n_grams", F.explode_outer(ranges).alias("r"))
        .where("r.low <= r.high")
        .select("doc", "n_words", "span", "n_grams", F.explode(F.sequence("r.low", "r.high")).alias("start"))
    )
    windows = stored(starts.distinct(), "windows")

    # All shingles of those windows, from the documents that have some.
    here = shingled(possibly_in(texts, windows, ["doc"])).distinct()
    parts = (
        here.join(windows, ["doc", "span"])
        .select("doc", "start", "n_words", F.expr("slice(grams, start + 1, n_grams)").alias("own"))
        .withColumn("text_key", F.xxhash64("own"))
        .select("doc", "start", "n_words", "text_key", F.explode_outer("own").alias("gram"))
        .groupBy("doc", "start", "n_words", "text_key", "gram")
        .agg(F.count("*").alias("weight"))
    )
    key = ["doc", "start", "n_words", "text_key"]
    parts = stored(parts, "window-grams")

    # Windows and items of one length meet where a block of their fingerprints agrees.
    def blocks(prints: DataFrame, name: str) -> DataFrame:
        found = prints.withColumn("b", F.explode(_blocks(F.col("bits"), radius)))
        return found.select(*[c for c in prints.columns if c != "bits"], F.col("bits").alias(name), "b.*")

    of_windows = blocks(_prints(parts, key), "bits")
    of_items = blocks(_prints(item_grams, ["item", "n_words"]), "item_bits")
    apart = F.bit_count(F.col("bits").bitwiseXOR(F.col("item_bits")))
    candidates = stored(
        of_windows.join(held(of_items), ["n_words", "block", "part"]).where(apart <= radius).select(*key, "item").distinct(),
        "contamination-candidates",
    )
    theirs = item_grams.select("item", "gram", "n_grams", F.col("weight").alias("item_weight"))
    totals = parts.groupBy(*key).agg(F.sum("weight").alias("total"))
    common = (
        candidates.join(parts, key)
        .join(held(theirs), ["item", "gram"])
        .groupBy(*key, "item", "n_grams")
        .agg(F.sum(F.least("weight", "item_weight")).alias("common"))
        .join(totals, key)
        .withColumn("similarity", F.col("common") / (F.col("n_grams") + F.col("total") - F.col("common")))
    )
    return common.where(F.col("similarity") >= similarity).select("doc", "item", "start", "n_words", "similarity").distinct()


def contaminated(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """One row per document and item that a window of it is like: ``doc``, ``item``,
    ``n_windows``, the best ``similarity`` and ``start`` of the first window that has it."""
    found = contaminated_windows(docs, items, **settings)
    return found.groupBy("doc", "item").agg(
        F.count("*").alias("n_windows"),
        F.max("similarity").alias("similarity"),
        F.max_by("start", F.struct("similarity", -F.col("start"))).alias("start"),
    )
