"""Tokens of two tokenizers over the same bytes, and how often their ids meet in a corpus.

Equal texts are shuffled to one row and handled once; what is counted over documents is weighted
by the number of copies, and what is measured goes back to the ids of all of them.

A text is cut before every space that has a non-space on both sides. Neither tokenizer has a
piece that reaches across such a place, so both are encoded alike everywhere between two of
them, and both end there: tokens, groups and links of a text are those of its units joined. A
worker therefore tokenises and aligns a unit once. Where a unit does not give back its bytes
the whole text goes through both libraries.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import takewhile

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from refinery.llm.common import ROWS, column_named, discard, stored, text_column, tokenizer_path
from refinery.llm.spread import spread_lookup
from refinery.llm.vocabulary import byte_of_char, units

#: Units that a worker remembers at most; then it forgets the later half, where rare ones are.
UNITS = 500_000
#: Characters of the longest unit that is remembered.
_LONG = 64
#: Characters of texts that are put together at once, about.
_AT_ONCE = 1 << 21
#: Rows of the pairs that are broadcast, the most frequent ones; 24 bytes each.
FREQUENT_PAIRS = 1 << 19
_SPACE = "▁"


class Sides:
    """Both tokenizers, with the bytes of their tokens."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        self.a = Tokenizer.from_str(byte_level.decode())
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        of_char = byte_of_char()
        described = json.loads(byte_level)
        vocab = {i: bytes(of_char[c] for c in p) for p, i in described["model"]["vocab"].items() if all(c in of_char for c in p)}
        self.a_bytes = [vocab.get(i, b"") for i in range(max(vocab) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.size_b = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.b_bytes = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace(_SPACE, " ").encode() for i, n in enumerate(names)]
        across = any(n[k] == _SPACE and n[k - 1] != _SPACE for n in names for k in range(1, len(n)))
        if across or (described.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or described.get("normalizer"):
            raise ValueError("a piece of these tokenizers may reach across the space between two words")
        self.a_length, self.b_length = [len(p) for p in self.a_bytes], [len(p) for p in self.b_bytes]
        self.name = [str(i) for i in range(max(len(self.a_bytes), self.size_b))]

    def encode(self, spaced: list[str]) -> list[tuple[list[int], list[int], bool]]:
        """For texts that begin with a space: ids of both sides, and whether both give its bytes."""
        left = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        right = self.b.encode([s[1:] for s in spaced], num_threads=1)
        of_a, of_b, joined = self.a_bytes.__getitem__, self.b_bytes.__getitem__, b"".join
        return [(a, b, joined(map(of_a, a)) == t.encode() == joined(map(of_b, b))) for t, a, b in zip(spaced, left, right)]

    def align(self, a: list[int], b: list[int]) -> tuple[bytes, int, list[int]]:
        """Groups as text, their number, and the pair ``a * size_b + b`` of every link."""
        size, name = self.size_b, self.name
        if len(b) == 1 or len(a) == 1:  # one group, in which all meet
            text = ",".join([name[x] for x in a]) + "|" + ",".join([name[y] for y in b])
            return text.encode(), 1, [x * size + y for x in a for y in b]
        a_length, b_length = self.a_length, self.b_length
        text, links = [], []
        own, other, ahead = [name[a[0]]], [name[b[0]]], a_length[a[0]] - b_length[b[0]]
        i = j = 0
        last = len(a) - 1
        while True:
            # One more link for the two tokens at hand, then whichever ends first gives way.
            links.append(a[i] * size + b[j])
            if ahead == 0:
                text.append(",".join(own) + "|" + ",".join(other))
                if i == last:
                    return ";".join(text).encode(), len(text), links
                i, j = i + 1, j + 1
                own, other, ahead = [name[a[i]]], [name[b[j]]], a_length[a[i]] - b_length[b[j]]
            elif ahead > 0:
                j += 1
                other.append(name[b[j]])
                ahead -= b_length[b[j]]
            else:
                i += 1
                own.append(name[a[i]])
                ahead += a_length[a[i]]


class Aligner:
    """Remembers units of one worker as rows of arrays, and joins them to texts."""

    def __init__(self, sides: Sides):
        self.sides = sides
        self.row: dict[str, int] = {}
        self.counts = np.zeros((0, 4), np.int64)  # n_a, n_b, n_groups, whether the bytes are kept
        self.ends = np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.groups: list[bytes] = []

    def _forget(self) -> None:
        """Keep the units that were learned first, where the frequent ones are."""
        kept = len(self.groups) // 2
        self.row = dict(takewhile(lambda item: item[1] < kept, self.row.items()))
        self.counts, self.ends = self.counts[:kept].copy(), self.ends[:kept].copy()
        self.pairs = self.pairs[: self.ends[-1] if kept else 0].copy()
        del self.groups[kept:]

    def _learn(self, wanted: list[str]) -> None:
        counts, pairs, ends, total = [], [], [], len(self.pairs)
        for at in range(0, len(wanted), 4_096):
            part = wanted[at : at + 4_096]
            for unit, (a, b, same) in zip(part, self.sides.encode(part)):
                text, n, links = self.sides.align(a, b) if same else (b"", 0, [])
                self.row[unit] = len(self.groups)
                self.groups.append(text)
                counts.append((len(a), len(b), n, same))
                pairs += links
                total += len(links)
                ends.append(total)
        self.counts = np.concatenate([self.counts, np.array(counts, np.int64).reshape(-1, 4)])
        self.ends = np.concatenate([self.ends, np.array(ends, np.int64)])
        self.pairs = np.concatenate([self.pairs, np.array(pairs, np.int64)])

    def texts(self, texts: list[str]) -> list[tuple]:
        """Per text: n_a, n_b, n_groups, n_links, digest of the groups, its pairs, their links."""
        if len(self.groups) > UNITS or len(self.pairs) > 16 * UNITS:
            self._forget()
        split = [units(" " + t) if t else [] for t in texts]
        known = self.row
        new = dict.fromkeys(u for us in split for u in us if u not in known)
        long = {u for u in new if len(u) > _LONG}
        if new:
            self._learn(list(new))
        found = [np.array([known[u] for u in us], np.int64) for us in split]
        out = [self._joined(t, rows) for t, rows in zip(texts, found)]
        for u in long:  # their names take the most; their rows go when rows are forgotten
            del known[u]
        return out

    def _joined(self, text: str, rows: np.ndarray) -> tuple:
        nothing = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32))
        if not len(rows):
            return nothing
        counts = self.counts[rows]
        if not counts[:, 3].all():
            return self._whole(text) or nothing
        n_a, n_b, n_groups = counts[:, :3].sum(0).tolist()
        groups = self.groups
        digest = hashlib.sha256(b";".join([groups[r] for r in rows.tolist()])).hexdigest()
        distinct, times = np.unique(rows, return_counts=True)
        ends = self.ends[distinct]
        starts = np.where(distinct > 0, self.ends[distinct - 1], 0)
        sizes = ends - starts
        places = np.arange(sizes.sum()) + np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        pairs, links = _counted(self.pairs[places], np.repeat(times, sizes))
        return n_a, n_b, n_groups, int(links.sum()), digest, pairs, links

    def _whole(self, text: str) -> tuple | None:
        [(a, b, same)] = self.sides.encode([" " + text])
        if not same:
            return None
        groups, n, links = self.sides.align(a, b)
        pairs, times = _counted(np.array(links, np.int64), np.ones(len(links), np.int64))
        return len(a), len(b), n, len(links), hashlib.sha256(groups).hexdigest(), pairs, times


def _counted(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order, with the sum of their times."""
    order = np.argsort(pairs)
    pairs, times = pairs[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    return pairs[first], np.add.reduceat(times, first)


@lru_cache(maxsize=2)
def _aligner(byte_level: bytes, pieces: bytes) -> Aligner:
    return Aligner(Sides(byte_level, pieces))


def aligned_texts(texts: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Adds to every row of ``(text, digest, copies)``, in place of the text, its measures, its
    distinct ``pairs`` and the ``links`` of each."""
    context = texts.sparkSession.sparkContext
    data = []
    for name in (byte_level, pieces):
        with open(tokenizer_path(name), "rb") as file:
            data.append(context.broadcast(file.read()))
    names = ["digest", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(data[0].value, data[1].value)

        def handed_on(part: pa.RecordBatch, measured: list[tuple]) -> pa.RecordBatch:
            numbers = [pa.array([m[k] for m in measured], pa.int64()) for k in range(4)]
            ends = pa.array(np.concatenate([[0], np.cumsum([len(m[5]) for m in measured])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([m[k] for m in measured]), pa.int64())) for k in (5, 6)]
            return pa.RecordBatch.from_arrays([part.column(1), part.column(2), *numbers, pa.array([m[4] for m in measured], pa.string()), *lists], names)

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                values = part.column(0).to_pylist()
                first = held = 0
                for n, text in enumerate(values, 1):
                    held += len(text)
                    if n == len(values) or held >= _AT_ONCE:
                        yield handed_on(part.slice(first, n - first), aligner.texts(values[first:n]))
                        first, held = n, 0

    numbers = ", ".join(f"{n} long" for n in names[2:6])
    kind = texts.schema["digest"].dataType.simpleString()
    return texts.select("text", "digest", "copies").mapInArrow(
        run, f"digest {kind}, copies long, {numbers}, groups_sha256 string, pairs array<long>, links array<long>"
    )


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``(pair, n_docs, best)``: documents that hold the pair linked, and whether no other pair
    of its A id is held by more. The best of every A id is a row per entry of a vocabulary."""
    counted = stored(
        aligned.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("n_docs")), "alignment-pairs"
    )
    a_id = F.floor(F.col("pair") / size_b)
    top = counted.groupBy(a_id.alias("a_id")).agg(F.max("n_docs").alias("most"))
    return counted.join(F.broadcast(top), a_id == F.col("a_id")).select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def _frequent_from(pairs: DataFrame, limit: int) -> int:
    """The smallest power of a fourth of two from which on at most ``limit`` pairs are as frequent."""
    step = F.floor(4 * F.log2("n_docs"))
    sizes = pairs.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()  # 250 rows at most
    total, reached = 0, None
    for row in sizes:
        total += row["count"]
        if total > limit:
            break
        reached = row["step"]
    return 1 << 62 if reached is None else reached


def align_tokenizers(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    byte_level: str = "byte_bpe_50k.json",
    pieces: str = "piece_bpe_32k.model",
    frequent_pairs: int = FREQUENT_PAIRS,
) -> tuple[DataFrame, DataFrame]:
    """Per row of ``docs`` how the tokens of its text align, and the pairs of the corpus.

    A are the tokens of space + text by ``byte_level``, B those of text by ``pieces``, which adds
    the space; strings of special tokens are plain text. Places where tokens of both end cut them
    into groups; a link is an A and a B token that share a byte.

    The first frame has the id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose
    pair no other pair of its A id exceeds), ``count_sum`` (the documents that hold the pair of
    each link, added up; all long) and ``groups_sha256`` (of ``a1,a2|b1;a3|b2``). The second has
    ``a_id``, ``b_id``, ``n_docs`` and ``best``.

    A text that is null, empty or not given back byte by byte by both sides has no tokens: zeros
    and an empty digest. Repeated rows count each; ids may be null; an empty table stays empty;
    other columns are ignored. Texts are read whole.

    The most frequent pairs, ``frequent_pairs`` at most, are met by broadcast where the links
    lie; the links of the others, of which each is rare, are shuffled to their pairs.
    """
    size_b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(pieces)).get_piece_size()
    source = docs.select(column_named(docs, id_column).alias("__id"), text_column(docs, text))
    # Equal texts meet by the whole text; ids find them again by a digest that is checked.
    distinct = source.groupBy("text").agg(F.count(F.lit(1)).alias("copies")).withColumn("digest", F.sha2("text", 256))
    aligned = stored(aligned_texts(distinct, byte_level, pieces), "alignment-texts")
    if not aligned.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise RuntimeError("two different texts have one digest")

    pairs = stored(pair_counts(aligned, size_b), "alignment-counts")
    least = _frequent_from(pairs, frequent_pairs)
    step = F.floor(4 * F.log2("n_docs"))
    frequent, rare = pairs.where(step >= least), pairs.where(step < least)
    each = aligned.select("digest", F.explode(F.arrays_zip("pairs", "links")).alias("l")).select("digest", F.col("l.pairs").alias("pair"), F.col("l.links").alias("links"))
    sums = [F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("n_docs")).alias("count_sum")]
    met = each.join(F.broadcast(frequent), "pair").groupBy("digest").agg(*sums)
    if not rare.isEmpty():
        others = each.join(F.broadcast(frequent.select("pair")), "pair", "left_anti").join(rare, "pair").groupBy("digest").agg(*sums)
        met = met.unionByName(others).groupBy("digest").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    measures = aligned.select("digest", "copies", *numbers, "groups_sha256").join(met, "digest", "left")
    measures = stored(measures.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}), "alignment-measures")

    hot = measures.where("copies > 10000").select("digest")
    keyed = source.select("__id", F.sha2("text", 256).alias("digest"))
    found = spread_lookup(keyed, measures.drop("copies"), ["digest"], hot)
    result = found.select(F.col("__id").alias(id_column), *numbers, "n_best", "count_sum", "groups_sha256")
    discard(aligned)
    return result, pairs.select(
        F.floor(F.col("pair") / size_b).alias("a_id"), (F.col("pair") % size_b).alias("b_id"), "n_docs", "best"
    )
