"""Line deduplication by an exact set-similarity join.

A line is the set of its words. Two lines match if their Jaccard similarity reaches the
threshold; of two matching lines the later one, by document id and line number, is removed,
whether or not the earlier one stays itself.

Lines with equal sets are one class, found by grouping, and only the first line of a class is
compared. Between classes: the words are dealt to parts by a hash, one part more than matching
lines of those sizes can differ in words, so that matching lines are equal in a part at least
(partition filter). A line posts a key for every part, but for the weakest ones that more parts
than that allow it to leave out. A part is weak if many lines have it by chance: it is empty, or
holds a few frequent words. The smaller lines with a weak part deal their words to parts a second
time, and a weak part is posted together with the weak parts of the second deal only. So a list
of lines with one key stays short, unless these are alike. Of the pairs in a list those whose
sizes (length filter) or parity bitmaps rule a match out are dropped; the rest is verified on the
words.

Only the existence of an earlier match matters: each line is first verified against the earliest
line that it may match, and only lines without a match so far against the others. Long lists are
not paired before that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import REMEMBERED, column_named, discard, forget, partitions, possibly_in, stored, text_column, unused_name

#: Lists of lines with one key up to this length are paired in the task that reads them.
SHORT = 256
#: Shares of the keys that are met one after another, so that the shuffles of one share at a time
#: lie on the disks.
PASSES = 4
#: Sizes from this on are not dealt a second time; few lines have them.
_REFINED = 64
#: A part is weak if it is expected this often (a power of two) among as many sets as there are words.
_WEAK = 6
#: Postings that a task packs at once, and the buckets of a partition.
_PACKED = 1 << 20
_BUCKETS = 4
_ALL = (1 << 56) - 1
#: Bytes of text whose words are numbered at once, a single text apart.
_BLOCK = 1 << 18
#: Bytes from which on a word is hashed by itself.
_LONG_WORD = 64
_LINE_FIELDS = "doc long, line int, n int, sig long, sig2 long, k1 long, k2 long, new boolean, keys array<int>"
#: Base of the polynomial that stands for a word, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """The first powers of the base and of its inverse; as many as the longest block asks for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, _BLOCK + 1)
            self.up, self.down = (np.append(np.ones(1, np.uint64), np.cumprod(np.full(n - 1, x, np.uint64))) for x in (_BASE, _INVERSE))


def _blocks(texts: pa.StringArray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``_BLOCK`` bytes."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + _BLOCK, "right")) - 1)
        yield at, min(to, len(texts))
        at = min(to, len(texts))


def _words(texts: pa.StringArray, powers: _Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every word of the texts: a 64-bit number that stands for it, its line among all lines;
    and for every line: its text, and its number in it.

    The number is a polynomial over the bytes, A-Z in lower case, so differences of running
    sums give it for all words at once; that of a long word is its XXH64.
    """
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    feeds = np.flatnonzero(raw == 10)
    of_feed = np.searchsorted(ends[1:], feeds, "right")
    counts = np.bincount(of_feed, minlength=len(texts)) + 1
    text = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), text, number
    apart = (raw == 32) | ((raw >= 9) & (raw <= 13))
    first = ~apart
    first[1:] &= apart[:-1]
    inside = ends[:-1][(ends[:-1] < len(raw)) & (np.diff(ends) > 0)]  # a text begins
    first[inside] = ~apart[inside]
    last = ~apart
    last[:-1] &= apart[1:]
    last[inside[1:] - 1] = ~apart[inside[1:] - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    lower = raw + (((raw >= 65) & (raw <= 90)).astype(np.uint8) << 5)
    powers.reach(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * powers.up[: len(raw)], out=sums[1:])
    word = _mixed((sums[end] - sums[begin]) * powers.down[begin], 0xC2B2)
    # Modulo 2**64 some long words (from about 1,000 bytes on) have one polynomial for any base.
    for i in np.flatnonzero(end - begin > _LONG_WORD).tolist():
        word[i] = xxhash.xxh64_intdigest(lower[begin[i] : end[i]].tobytes())
    # Lines before a word: those that line feeds have ended, and one for every text before it.
    line = np.searchsorted(feeds, begin) + np.searchsorted(ends[1:], begin, "right")
    return word, line, text, number


def frequent_tokens(source: DataFrame, size: int, error: float) -> tuple[np.ndarray, np.ndarray, int]:
    """The most frequent words, as sorted numbers, with the binary logarithm of their counts;
    and that of the number of all words.

    Lossy counting over all texts: a count is too low by the share ``error`` at most. Only the
    ``size`` best words reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        powers, total, waiting, held = _Powers(), 0, [], 0
        known, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def merged() -> None:
            nonlocal known, counts, waiting, held
            new, n = np.unique(np.concatenate(waiting or [known[:0]]), return_counts=True)
            both, at = np.unique(np.concatenate((known, new)), return_inverse=True)
            sums = np.bincount(at, np.concatenate((counts, n)), len(both)).astype(np.int64)
            keep = sums > (max(1, error * total) if len(both) > 2 * REMEMBERED else 0)
            known, counts, waiting, held = both[keep], sums[keep], [], 0

        for batch in batches:
            texts = batch.column(0)
            for at, to in _blocks(texts):
                word = _words(texts.slice(at, to - at), powers)[0]
                total, held = total + len(word), held + len(word)
                waiting.append(word)
                if held > 4 * REMEMBERED:
                    merged()
        merged()
        often = counts > error * total
        known, counts = known[often].view(np.int64), counts[often]
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([total])], ["word", "n"])
        for at in range(0, len(known), 20_000):
            part = slice(at, at + 20_000)
            yield pa.RecordBatch.from_arrays([pa.array(known[part]), pa.array(counts[part])], ["word", "n"])

    counted = source.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    best = counted.orderBy(F.desc(F.col("word").isNull()), F.desc("n"), "word").limit(size + 1).toArrow()
    logs = np.frexp(best.column("n").to_numpy().astype(np.float64))[1].astype(np.int64)
    word = best.column("word").slice(1).to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(word)
    return word[order], logs[1:][order], int(logs[0]) if len(logs) else 0


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of numbers."""
    x = (x ^ np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


@cache
def _bands(threshold: float) -> tuple[np.ndarray, ...]:
    """Bands of sizes: where they begin; the parts of a band; and twice, for sizes of the band and
    for larger ones, what is left to a line: of it, the share of unlike words of a size is taken.

    The parts of a band serve the pairs whose smaller line it has. Lines of n and m words that
    match differ in ``share * (n + m)`` words at most; of D parts, two lines may leave out what
    adds up to ``D - 1 - share * (n + m)``.
    """
    share = (1 - threshold) / (1 + threshold)
    begin = [max(1, math.ceil(threshold / (1 - threshold) - 1e-9))]
    while begin[-1] < 1 << 31:
        begin.append(max(begin[-1] + 1, begin[-1] * 3 // 2))
    parts, own, larger = [], [], []
    for low, high in zip(begin, begin[1:]):
        widest = math.floor((high - 1) / threshold + 1e-9)
        if high <= 32:  # exactly, with nothing to leave out
            both = np.arange(2 * low, high + widest)
            parts.append(1 + int((both - 2 * np.ceil(threshold / (1 + threshold) * both - 1e-9)).max()))
            own.append(0.0)
            larger.append(0.0)
        else:
            differ = math.ceil(share * (high - 1 + widest) + 1e-9)
            parts.append(1 + differ)
            larger.append(max(differ / 2, share * widest))
            own.append(differ - larger[-1])
    return np.array(begin[:-1]), np.array(parts), np.array(own), np.array(larger)


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``count`` numbers from each ``first`` on, one after another."""
    return np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)


def _parts(plain, weight, starts, n, band, threshold: float, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The posted parts of lines in the parts of ``band``: line, number that stands for the part,
    and its strength. ``starts`` and ``n`` place a line's words in ``plain`` and ``weight``."""
    begin, parts, own, larger = _bands(threshold)
    many = parts[band]
    above = n >= np.append(begin, 1 << 62)[band + 1]
    out = np.floor(np.where(above, larger[band], own[band]) - (1 - threshold) / (1 + threshold) * n - 1e-9).astype(np.int64)
    at, first = _ranges(starts, n), np.cumsum(many) - many
    words = plain[at]
    part = ((_mixed(words, salt) >> np.uint64(32)) * np.repeat(many, n).astype(np.uint64) >> np.uint64(32)).view(np.int64)
    part += np.repeat(first, n)
    sums = np.zeros(int(many.sum()), np.uint64)
    np.add.at(sums, part, _mixed(words, 0x51ED))
    strength = np.bincount(part, weight[at], len(sums)).astype(np.int64)
    line = np.repeat(np.arange(len(many)), many)
    place = np.arange(len(sums)) - np.repeat(first, many)
    sums ^= _mixed((np.repeat(band, many) << 32 | place).astype(np.uint64), salt)
    order = np.lexsort((-strength, line))
    taken = order[place < np.repeat(many - np.maximum(out, 0), many)]
    return line[taken], _mixed(sums[taken], 0x3C6E), strength[taken]


def _line_keys(plain, weight, starts, n, threshold: float, weak: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines and their keys; two lines that match have a key in common."""
    begin = _bands(threshold)[0]
    band = np.searchsorted(begin, n, "right") - 1
    low = np.maximum(np.searchsorted(begin, np.ceil(threshold * n - 1e-9), "right") - 1, 0)
    lines, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    down = 0
    while len(who := np.flatnonzero(band - down >= low)):
        at = band[who] - down
        line, key, strength = _parts(plain, weight, starts[who], n[who], at, threshold, 0x6A09)
        again = (strength < weak) & (begin[at[line]] < _REFINED)
        lines.append(who[line[~again]])
        keys.append(key[~again])
        if again.any():
            line, key = line[again], key[again]
            some, many = np.unique(line, return_counts=True)
            line2, key2, strength = _parts(plain, weight, starts[who[some]], n[who[some]], at[some], threshold, 0xBB67)
            both = strength < weak
            lines.append(who[some[line2[~both]]])
            keys.append(key2[~both])
            # ``line`` ascends, so the weak parts of one line are beside each other.
            line2, key2 = line2[both], key2[both]
            count = many[line2]
            one = _ranges((np.cumsum(many) - many)[line2], count)
            lines.append(who[some[np.repeat(line2, count)]])
            keys.append(_mixed(np.repeat(key2, count) + _mixed(key[one], 0xA54F), 0x510E))
        down += 1
    return np.concatenate(lines), np.concatenate(keys)


def line_sets(source: DataFrame, classes: tuple[np.ndarray, np.ndarray, int], threshold: float) -> DataFrame:
    """Every line with words: size, parity bitmap of 128 bits, 128-bit digest of its set of words, whether its
    task has met no earlier line with that set, and if so the keys of its parts."""
    shared = source.sparkSession.sparkContext.broadcast(classes)
    smallest = threshold / (1 - threshold) - 1e-9 if threshold < 1 else math.inf

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        often, level, top = shared.value
        rare = int(level.min()) if len(level) else 1
        powers = _Powers()
        met: dict[tuple[int, int], tuple[int, int]] = {}  # the earliest line of a set so far

        def block(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch | None:
            words, of_line, of_text, number = _words(texts, powers)
            if not len(words):
                return None
            unique, code = np.unique(words, return_inverse=True)
            weights = np.full(len(unique), top - rare)
            if len(often):
                at = np.minimum(np.searchsorted(often, unique), len(often) - 1)
                known = often[at] == unique
                weights[known] = top - level[at[known]]
            key = of_line << 32 | code
            key.sort()
            key = key[np.concatenate(([True], key[1:] != key[:-1]))]
            line, code = key >> 32, key & 0xFFFFFFFF
            plain, weight = unique[code] & np.uint64(_ALL), weights[code]
            starts = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
            n = np.diff(np.append(starts, len(line)))
            own = line[starts]
            docs = np.asarray(ids)[of_text[own]]
            number = number[own]
            bit, half = np.uint64(1) << (plain & np.uint64(63)), plain >> np.uint64(6) & np.uint64(1)
            sig, sig2 = (np.bitwise_xor.reduceat(np.where(half == k, bit, 0), starts).view(np.int64) for k in (0, 1))
            k1, k2 = (np.add.reduceat(_mixed(plain, salt), starts).view(np.int64) for salt in (0x9E37, 0x85EB))
            new = np.zeros(len(n), bool)
            for i, (k, place) in enumerate(zip(zip(k1.tolist(), k2.tolist()), zip(docs.tolist(), number.tolist()))):
                if met.get(k, place) >= place:
                    met[k] = place
                    new[i] = True
            if len(met) > REMEMBERED:
                met.clear()
            who = np.flatnonzero(new & (n >= smallest))
            line, keys = _line_keys(plain, weight, starts[who], n[who], threshold, top - _WEAK) if len(who) else (who, plain[:0])
            order = np.argsort(line, kind="stable")
            offsets = np.concatenate(([0], np.cumsum(np.bincount(who[line], minlength=len(n))))).astype(np.int32)
            short = (keys[order] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            columns = [
                pa.array(docs, pa.int64()), pa.array(number, pa.int32()), pa.array(n, pa.int32()), pa.array(sig), pa.array(sig2), pa.array(k1),
                pa.array(k2), pa.array(new), pa.ListArray.from_arrays(pa.array(offsets), pa.array(short)),
            ]
            return pa.RecordBatch.from_arrays(columns, ["doc", "line", "n", "sig", "sig2", "k1", "k2", "new", "keys"])

        for batch in batches:
            for at, to in _blocks(batch.column(1)):
                part = batch.slice(at, to - at)
                found = block(part.column(0), part.column(1))
                if found is not None:
                    yield found

    return source.mapInArrow(run, _LINE_FIELDS)


def _may_match(nx, ny, unlike, threshold: float):
    """Length and bitmap filter; arrays of numbers, ``unlike`` of the bits that differ."""
    need = np.ceil(threshold / (1 + threshold) * (nx + ny) - 1e-9)
    return (np.minimum(nx, ny) >= threshold * np.maximum(nx, ny) - 1e-9) & (unlike <= nx + ny - 2 * need)


def _may_match_sql(x: str, y: str, threshold: float) -> Column:
    """The same filters of joined rows."""
    f = lambda s, c: F.col(f"{s}.{c}")
    need = F.ceil(threshold / (1 + threshold) * (f(x, "n") + f(y, "n")) - 1e-9)
    return (F.least(f(x, "n"), f(y, "n")) >= threshold * F.greatest(f(x, "n"), f(y, "n")) - 1e-9) & (
        F.bit_count(f(x, "sig").bitwiseXOR(f(y, "sig"))) + F.bit_count(f(x, "sig2").bitwiseXOR(f(y, "sig2")))
        <= f(x, "n") + f(y, "n") - 2 * need
    )


def _earlier(y: str, x: str) -> Column:
    return (F.col(f"{y}.doc") < F.col(f"{x}.doc")) | ((F.col(f"{y}.doc") == F.col(f"{x}.doc")) & (F.col(f"{y}.line") < F.col(f"{x}.line")))


#: ``place`` holds the line and its size.
_POSTING = ["key", "doc", "place", "sig", "sig2"]


def _postings(firsts: DataFrame, share: int, buckets: int) -> DataFrame:
    """The postings of one share of the keys, a row for many with one bucket of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        waiting, held = [], 0

        def packed() -> pa.RecordBatch:
            rows = [np.concatenate(c) for c in zip(*waiting)]
            bucket = (rows[0].view(np.uint32) // PASSES % buckets).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            ends = np.append(starts, len(bucket))
            columns = [pa.array(bucket[starts])]
            for c in rows:
                offsets = (ends * c.itemsize).astype(np.int32)
                columns.append(pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(c[order])]))
            return pa.RecordBatch.from_arrays(columns, ["bucket", *_POSTING])

        for batch in batches:
            rows = [np.asarray(c) for c in batch.columns[1:]]
            counts = np.diff(np.asarray(batch.column(0).offsets))
            keys = np.asarray(batch.column(0).flatten())
            mine = keys.view(np.uint32) % PASSES == share
            row = np.repeat(np.arange(len(counts)), counts)[mine]
            if len(row):
                waiting.append((keys[mine], *(c[row] for c in rows)))
                held += len(row)
            if held > _PACKED:
                yield packed()
                waiting, held = [], 0
        if held:
            yield packed()

    place = F.shiftleft(F.col("line").cast("long"), 32).bitwiseOR(F.col("n").cast("long")).alias("place")
    rows = firsts.where(F.size("keys") > 0).select("keys", "doc", place, "sig", "sig2")
    return rows.mapInArrow(run, "bucket int, key binary, doc binary, place binary, sig binary, sig2 binary")


def _short_lists(postings: DataFrame, threshold: float) -> DataFrame:
    """Pairs of lines from lists of up to SHORT lines, the later line first; longer lists row by
    row, without partner, and every line of them once more with the earliest line if they may
    match. ``postings`` come ordered by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()

        def emit(rows: list[np.ndarray], doc2: np.ndarray | None = None, place2: np.ndarray | None = None) -> pa.RecordBatch:
            partner = [pa.nulls(len(rows[0]), pa.int64()) if c is None else pa.array(c) for c in (doc2, place2)]
            return pa.RecordBatch.from_arrays([*(pa.array(c) for c in rows), *partner], [*_POSTING, "doc2", "place2"])

        def work(packed: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            rows = [np.concatenate(c) for c in zip(*packed)]
            order = np.argsort(rows[0], kind="stable")
            key = rows[0][order]
            same = key[1:] == key[:-1]
            order = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
            rows = [c[order] for c in rows]  # of lists with several lines
            order = np.lexsort((rows[2], rows[1], rows[0]))
            rows = [c[order] for c in rows]
            key, doc, place, sig, sig2 = rows
            if not len(key):
                return
            line, n = place >> 32, place & 0xFFFFFFFF
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sizes = np.diff(np.append(starts, len(key)))
            size, start = np.repeat(sizes, sizes), np.repeat(starts, sizes)
            rank = np.arange(len(key)) - start

            def pairs(x: np.ndarray, y: np.ndarray) -> Iterator[pa.RecordBatch]:
                unlike = np.bitwise_count((sig[x] ^ sig[y]).view(np.uint64)).astype(np.int64) + np.bitwise_count((sig2[x] ^ sig2[y]).view(np.uint64))
                fit = _may_match(n[x], n[y], unlike, threshold) & ((doc[x] != doc[y]) | (line[x] != line[y]))
                if fit.any():
                    yield emit([c[x[fit]] for c in rows], doc[y[fit]], place[y[fit]])

            long = np.flatnonzero(size > SHORT)
            if len(long):
                yield emit([c[long] for c in rows])
                yield from pairs(long, start[long])
            x = np.flatnonzero((size <= SHORT) & (rank > 0))
            back = 1
            while len(x):
                yield from pairs(x, x - back)
                back += 1
                x = x[rank[x] >= back]

        open_bucket, held = None, []
        for batch in batches:
            for bucket, *cells in zip(*(c.to_pylist() if i == 0 else c for i, c in enumerate(batch.columns))):
                if bucket != open_bucket and held:
                    yield from work(held)
                    held = []
                open_bucket = bucket
                held.append([np.frombuffer(c.as_buffer(), kind) for c, kind in zip(cells, (np.int32, *[np.int64] * 4))])
        if held:
            yield from work(held)

    return postings.mapInArrow(run, "key int, doc long, place long, sig long, sig2 long, doc2 long, place2 long")


def _texts_of(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the lines ``wanted`` (doc, line), and of a few others."""
    lines = possibly_in(source, wanted, ["doc"]).select("doc", F.posexplode_outer(F.split("text", "\n")).alias("line", "raw"))
    return possibly_in(lines, wanted, ["doc", "line"])


def _similar(pairs: DataFrame, threshold: float) -> DataFrame:
    """Lines (doc, line) of pairs whose texts ``raw`` and ``raw2`` match as sets of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary())):
                a, b = set(x.as_py().lower().split()), set(y.as_py().lower().split())
                same = len(a & b)
                kept.append(same / (len(a) + len(b) - same) >= threshold if a and b else False)
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    return pairs.select("doc", "line", "raw", "raw2").mapInArrow(run, "doc long, line int").distinct()


def _verified(pairs: DataFrame, source: DataFrame, threshold: float) -> DataFrame:
    """Of the stored pairs (doc, line, doc2, line2) the lines (doc, line) that match their partner."""
    wanted = pairs.select("doc", "line").union(pairs.select("doc2", "line2")).distinct()
    texts = stored(_texts_of(source, wanted), "line-texts")
    other = texts.select(F.col("doc").alias("doc2"), F.col("line").alias("line2"), F.col("raw").alias("raw2"))
    both = pairs.join(texts, ["doc", "line"]).join(other, ["doc2", "line2"])
    matched = stored(_similar(both, threshold), "line-matched")
    discard(texts, pairs)
    return matched


def repeated_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    threshold: float = 0.8,
    lexicon_size: int = 1 << 17,
    error: float = 5e-7,
) -> DataFrame:
    """The removed lines of every document that has some: the id and ``removed`` (array of int,
    line numbers from 0, ascending)."""
    source = docs.select(column_named(docs, id_column).cast("long").alias("doc"), text_column(docs, text)).where("doc is not null")
    classes = frequent_tokens(source, lexicon_size, error)
    lines = stored(line_sets(source, classes, threshold), "lines")
    member = F.struct("doc", "line", "n", "sig", "sig2", "keys")
    firsts = lines.where("new").groupBy("k1", "k2").agg(F.min(member).alias("first"), F.count("*").alias("copies"))
    firsts = stored(firsts.select("k1", "k2", "copies", "first.*"), "line-classes")
    # All lines of a class but its first one match that.
    several = firsts.where("copies > 1").select("k1", "k2", F.col("doc").alias("first_doc"), F.col("line").alias("first_line"))
    later = lines.where("new").select("k1", "k2", "doc", "line").join(several, ["k1", "k2"]).where("doc <> first_doc or line <> first_line")
    copies = stored(lines.where("not new").select("doc", "line").union(later.select("doc", "line")), "line-copies")
    discard(lines)
    n_parts = partitions(docs.sparkSession)
    found = []
    for share in range(PASSES):
        dealt = _postings(firsts, share, _BUCKETS * n_parts).repartition(n_parts, "bucket").sortWithinPartitions("bucket")
        found.append(stored(_short_lists(dealt, threshold), "line-pairs"))
    discard(firsts)
    line_of, size_of = (lambda c: F.shiftright(c, 32).cast("int")), (lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))
    paired = reduce(DataFrame.union, found).where("doc2 is not null")
    paired = paired.select("doc", line_of("place").alias("line"), "doc2", line_of("place2").alias("line2"))
    first = paired.groupBy("doc", "line").agg(F.min(F.struct("doc2", "line2")).alias("y")).select("doc", "line", "y.*")
    matched = _verified(stored(first, "line-first"), source, threshold)
    pair = [F.col("x.doc"), F.col("x.line"), F.col("y.doc").alias("doc2"), F.col("y.line").alias("line2")]
    met = []
    for share in found:
        long = share.where("doc2 is null").select("key", "doc", line_of("place").alias("line"), size_of("place").alias("n"), "sig", "sig2")
        open_lines = long.join(matched, ["doc", "line"], "left_anti")
        meet = (F.col("x.key") == F.col("y.key")) & _earlier("y", "x") & _may_match_sql("x", "y", threshold)
        met.append(stored(open_lines.alias("x").join(long.alias("y"), meet).select(*pair).distinct(), "line-met"))
    others = paired.join(matched, ["doc", "line"], "left_anti")
    rest = stored(reduce(DataFrame.union, met, others).distinct(), "line-rest")
    discard(*found, *met)
    more = _verified(rest, source, threshold)
    removed = copies.union(matched).union(more)
    return removed.groupBy(F.col("doc").alias(id_column)).agg(F.array_sort(F.collect_set("line")).alias("removed"))


def dedup_lines(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = 0.8, others: tuple[str, ...] = (), **settings
) -> DataFrame:
    """``docs`` with the later ones of matching lines taken out of ``text``.

    Returns the id column, the text, the columns ``others``, ``n_lines`` and ``n_removed``
    (long) of every row. Lines end with a line feed; words are lower-cased in A-Z and end at
    ASCII white space. Lines without words never match and stay. Null texts stay null (no
    line), empty ones empty. Rows with a null id are returned as they are, uncompared. Rows
    with the same id are one document: a line number removed in one of them is removed in
    all. An empty table stays empty; ``others`` may have any names but those of the result.
    """
    removed = repeated_lines(docs, id_column, text, threshold, **settings)
    doc, gone = unused_name(docs, "removed_doc"), unused_name(docs, "removed_lines")
    removed = removed.select(F.col(id_column).alias(doc), F.col("removed").alias(gone))
    source = docs.select(
        column_named(docs, id_column).alias(id_column), column_named(docs, text).cast("string").alias(text), *[column_named(docs, c).alias(c) for c in others]
    )
    own, out = F.col(f"`{text}`"), F.col(gone)
    joined = source.join(removed, F.col(f"`{id_column}`").cast("long") == F.col(doc), "left")
    lines = F.split(own, "\n")
    kept = F.filter(lines, lambda _, i: ~F.array_contains(out, i))
    return joined.select(
        id_column,
        F.when(out.isNull(), own).otherwise(F.array_join(kept, "\n")).alias(text),
        *[f"`{c}`" for c in others],
        F.when(own.isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size(out), F.lit(0)).cast("long").alias("n_removed"),
    )
