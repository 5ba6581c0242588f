"""Exact token counts of every prefix of a text, by dynamic programming.

For BPE, a sequence of pieces is what the merges give if each piece encodes to itself and
every two neighbours are *compatible*: encoded together they stay as they are. So the last
piece of a prefix is the one whose predecessor, the last piece of the shorter prefix, is
compatible with it, and the count of the prefix is one more than that of the shorter one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm import vocabulary
from refinery.llm.common import REMEMBERED, ROWS, column_named, earliest, kept, text_column, tokenizer_path

#: White space of the split pattern, to which the separators do not belong.
_SPACES = re.compile(r"[^\S\x1c-\x1f]+")
#: Characters of the longest unit whose prefix counts are remembered, each in one byte.
_LONG = 40
#: Bytes of a word after which words that begin alike go on from there.
_HEAD = 6
#: Marks that may follow a word as a piece of their own; an apostrophe may belong to it.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Characters of texts whose prefix counts are handed on at once, about.
_AT_ONCE = 1 << 21


class Counter:
    """Counts tokens inside one worker; remembers counts of words and pairs of pieces."""

    def __init__(self, vocab: vocabulary.Vocabulary):
        self.vocab = vocab
        self.fits: dict[tuple[int, int], bool] = {}
        self.after_space: dict[str, int | None] = {}
        self.of_unit: dict[str, bytes] = {}
        self.heads: dict[bytes, tuple[list[int], list[int]]] = {}

    def _compatible(self, a: int, b: int) -> bool:
        pieces = self.vocab.pieces
        found = self.vocab.merge(pieces[a] + pieces[b]) == [a, b]
        if len(self.fits) > REMEMBERED // 2:
            self.fits = earliest(self.fits)
        self.fits[a, b] = found
        return found

    def prefixes(self, word: bytes) -> list[int]:
        """Token counts of ``word[:i]`` for every i from 0 on; a word of the split pattern."""
        ids, fits, longest = self.vocab.ids.get, self.fits.get, self.vocab.longest
        head = word[:_HEAD] if len(word) > _HEAD else None
        counts, last = self.heads.get(head) or ([0], [-1])
        if len(last) > 1:
            counts, last, head = counts[:], last[:], None
        for end in range(len(last), len(word) + 1):
            for start in range(end - 1, max(0, end - longest) - 1, -1):  # pieces are mostly short
                piece = ids(word[start:end])
                if piece is None:
                    continue
                before = last[start]
                if before >= 0:
                    fit = fits((before, piece))
                    if not (self._compatible(before, piece) if fit is None else fit):
                        continue
                counts.append(counts[start] + 1)
                last.append(piece)
                break
        if head is not None:
            if len(self.heads) > REMEMBERED // 8:
                self.heads.clear()
            self.heads[head] = counts[: _HEAD + 1], last[: _HEAD + 1]
        return counts

    def unit(self, unit: str) -> int:
        word = unit[1:]
        if unit[:1] == " " and word.isascii() and word.isalpha():  # one piece
            return self.prefixes(unit.encode())[-1]
        return sum(self.prefixes(p)[-1] for p in self.vocab.split(unit))

    def _ordinary(self, text: str) -> int:
        if len(self.after_space) > REMEMBERED:
            self.after_space = earliest(self.after_space)
        known = self.after_space
        first, *rest = text.split(" ")
        try:
            counts = [known[p] for p in rest]
        except KeyError:
            for p in rest:
                if p not in known:
                    known[p] = self.unit(" " + p) if vocabulary.safe_piece(p) else None
            counts = [known[p] for p in rest]
        if None not in counts and (not rest or (first and not first[-1].isspace())):
            return self.unit(first) + sum(counts)
        return sum(map(self.unit, vocabulary.units(text)))

    def count(self, text: str) -> int:
        """Tokens of the whole text."""
        return sum(self._ordinary(s) if i is None else 1 for s, i in self.vocab.sections(text))

    def _unit_prefixes(self, unit: str) -> list[int]:
        """Counts of every prefix of a unit, in characters, the empty one left out."""
        out, base = [], 0  # base: tokens before the white space that ends what is complete
        space, spaces = "", 0  # complete white space that a cut may join to what follows; its tokens
        for piece in (p.decode() for p in self.vocab.split(unit)):
            if _SPACES.fullmatch(piece):  # at the end of a cut, white space is one piece
                out += [base + n for n in self._at_characters(space + piece)[len(space) :]]
                space += piece
                spaces += self.prefixes(piece.encode())[-1]
                continue
            if piece[0] == "'" and piece[1:].isalpha():  # a cut ending of a word is no ending
                for n in range(1, len(piece) + 1):
                    out.append(base + spaces + sum(self.prefixes(p)[-1] for p in self.vocab.split(piece[:n])))
            else:  # a run of one kind, cut or not
                own = [base + spaces + n for n in self._at_characters(piece)]
                if space and piece[0] == " ":
                    own[0] = base + self._at_characters(space + piece[0])[-1]
                out += own
            base = out[-1]
            space, spaces = "", 0
        return out

    def _at_characters(self, word: str) -> list[int]:
        """Token counts of ``word[:i]`` for every i from 1 on, if each is one piece."""
        counts = self.prefixes(word.encode())
        if word.isascii():
            return counts[1:]
        return [counts[n] for n in accumulate(len(c.encode()) for c in word)]

    def _remembered_prefixes(self, unit: str) -> bytes:
        """Counts of every prefix of a unit that is not long; a byte holds each."""
        word = unit.rstrip(_MARKS)
        if len(word) > 1 and word[0] == " " and word[1:].isalpha() and vocabulary.plain(word):
            if len(word) == len(unit):  # one piece, cut or not
                row = bytes(self._at_characters(unit))
            else:  # the marks are a piece of their own, cut or not
                own = self.of_unit.get(word) or self._remembered_prefixes(word)
                row = own + bytes([own[-1] + n for n in self.prefixes(unit[len(word) :].encode())[1:]])
        else:
            row = bytes(self._unit_prefixes(unit))
        if len(self.of_unit) > REMEMBERED // 3:
            self.of_unit = earliest(self.of_unit)
        self.of_unit[unit] = row
        return row

    def _rows(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the prefixes of each unit, one after another, and how many each has."""
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        of = self.of_unit.get
        if sizes.max() <= _LONG:
            rows = b"".join([of(u) or self._remembered_prefixes(u) for u in parts])
            return np.frombuffer(rows, np.uint8), sizes
        rows = [
            np.array(self._unit_prefixes(u), np.int32) if len(u) > _LONG
            else np.frombuffer(of(u) or self._remembered_prefixes(u), np.uint8)
            for u in parts
        ]
        return np.concatenate(rows), sizes

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of ``text[:i]`` for every i from 0 to its length."""
        total, out = 0, [np.zeros(1, np.int32)]
        tail, before = "", 0  # what may join with what follows, from the last safe space on; tokens before it
        for section, i in self.vocab.sections(text):
            if i is not None:
                # A cut inside the string of an added token leaves ordinary text.
                inside = [before + self.count(tail + section[:n]) for n in range(1, len(section))]
                total += 1
                out.append(np.array([*inside, total], np.int32))
                tail, before = "", total
            else:
                parts = vocabulary.units(section)
                counts, sizes = self._rows(parts)
                ends = np.cumsum(counts[np.cumsum(sizes) - 1], dtype=np.int64)
                out.append(counts + np.repeat((np.concatenate([[0], ends[:-1]]) + total).astype(np.int32), sizes))
                tail, before = parts[-1], total + (int(ends[-2]) if len(parts) > 1 else 0)
                total += int(ends[-1])
        return np.concatenate(out).astype("<i4")


def _counter(data: bytes) -> Counter:
    return kept(("token_counts", hash(data)), lambda: Counter(vocabulary.load(data)))


def token_counts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    prefixes: bool = False,
) -> DataFrame:
    """Returns the id column, ``n_bytes`` and ``n_tokens`` (long) of every row's whole text;
    with ``prefixes`` also ``prefix_tokens`` (binary): the counts of ``text[:i]`` for every
    i from 0 to the number of characters, as little-endian signed 32-bit integers.

    A null text is empty. Repeated rows are repeated, ids may be null, an empty table stays
    empty, other columns are ignored.
    """
    with open(tokenizer_path(tokenizer), "rb") as file:
        data = docs.sparkSession.sparkContext.broadcast(file.read())
    source = docs.select(column_named(docs, id_column).alias(id_column), text_column(docs, text).alias("__text"))
    names = [id_column, "n_bytes", "n_tokens"] + ["prefix_tokens"] * prefixes

    def handed_on(ids: pa.Array, texts: list[str], columns: list[pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ids, pa.array([len(t.encode()) for t in texts], pa.int64()), *columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(data.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = part.column(1).to_pylist()
                if not prefixes:
                    yield handed_on(part.column(0), texts, [pa.array([counter.count(t) for t in texts], pa.int64())])
                    continue
                first, stored = 0, []
                for n, t in enumerate(texts, 1):
                    stored.append(counter.prefix_counts(t))
                    if n == len(texts) or sum(map(len, stored)) > _AT_ONCE:
                        totals = pa.array([int(s[-1]) for s in stored], pa.int64())
                        tables = pa.array([s.tobytes() for s in stored], pa.binary())
                        yield handed_on(part.column(0).slice(first, n - first), texts[first:n], [totals, tables])
                        first, stored = n, []

    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_column}` {kind}, n_bytes long, n_tokens long" + ", prefix_tokens binary" * prefixes)


def fitting_prefix(counted: DataFrame, budget: int) -> DataFrame:
    """Adds ``n_chars_kept`` (long): the characters of the longest prefix with at most
    ``budget`` tokens, read from the stored counts; nothing is encoded again."""
    names = counted.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("prefix_tokens")
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):  # else a whole batch of counts is held twice
                part = batch.slice(first, ROWS)
                ends = [int(np.flatnonzero(np.frombuffer(v.as_buffer(), "<i4") <= budget)[-1]) for v in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ends, pa.int64())], [*names, "n_chars_kept"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema)
    return counted.mapInArrow(run, f"{schema}, n_chars_kept long")
