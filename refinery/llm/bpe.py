"""Byte-level BPE encoding and decoding with a lexicon of frequent words.

The words of all documents are counted, the most frequent ones are compiled with their ids
into a minimal acyclic transducer (``transducer.py``), which every Python worker maps into
memory. Words that the lexicon does not have are merged exactly. The lexicon decides about
speed only, never about ids.
"""

from __future__ import annotations

import sys
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm import vocabulary
from refinery.llm.common import REMEMBERED, ROWS, column_named, earliest, kept, text_column, tokenizer_path
from refinery.llm.transducer import Lexicon, compile_lexicon


#: Characters of a word that the lexicon may have; longer ones are always merged.
LONGEST = 48


def frequent_words(docs: DataFrame, text: str, data, size: int, error: float) -> list[bytes]:
    """The ``size`` most frequent pieces of the split pattern over all documents.

    Lossy counting: a task drops the units that make up no more than ``error`` of what it has
    counted, so a count is too low by that share at most. Only the ``size`` best rows reach
    the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = Counter(), 0
        for batch in batches:
            for value in batch.column(0):
                pieces = value.as_py().split(" ")
                counts.update(pieces)
                total += len(pieces)
            if len(counts) > 5 * REMEMBERED:
                least = error * total
                counts = Counter({p: n for p, n in counts.items() if n > max(1, least)})
        least = error * total
        vocab, pieces = vocabulary.load(data.value), Counter()
        for unit, n in counts.items():
            if n > least and len(unit) <= LONGEST and vocabulary.safe_piece(unit):
                for piece in vocab.split(" " + unit):
                    pieces[piece] += n
        names = list(pieces)
        for at in range(0, len(names), 20_000):
            part = names[at : at + 20_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.binary()), pa.array([pieces[p] for p in part], pa.int64())], ["piece", "n"]
            )

    counted = docs.select(text_column(docs, text)).mapInArrow(count, "piece binary, n long")
    best = counted.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(size)
    return [bytes(r[0]) for r in best.select("piece").collect()]


def build_lexicon(words: list[bytes], vocab: vocabulary.Vocabulary) -> bytes:
    """The transducer of ``words``."""
    return compile_lexicon((w, vocab.merge(w)) for w in words)


class Encoder:
    """Encodes texts inside one worker; remembers what it has encoded."""

    def __init__(self, vocab: vocabulary.Vocabulary, lexicon: bytes):
        self.vocab, self.lexicon = vocab, Lexicon(lexicon)
        self.after_space: dict[str, bytes | None] = {}

    def _ids(self, unit: str) -> bytes:
        out: list[int] = []
        word = unit[1:]
        # One word of plain letters after a space is one piece.
        pieces = [unit.encode()] if unit[:1] == " " and word.isascii() and word.isalpha() else self.vocab.split(unit)
        for piece in pieces:
            found = self.lexicon.get(piece)
            out += self.vocab.merge(piece) if found is None else found
        return array("I", out).tobytes()

    def _ordinary(self, text: str) -> bytes:
        if len(self.after_space) > REMEMBERED:
            self.after_space = earliest(self.after_space)
        known = self.after_space
        first, *rest = text.split(" ")
        try:
            parts = [known[p] for p in rest]
        except KeyError:
            for p in rest:
                if p not in known:
                    known[p] = self._ids(" " + p) if vocabulary.safe_piece(p) else None
            parts = [known[p] for p in rest]
        if None not in parts and (not rest or (first and not first[-1].isspace())):
            return self._ids(first) + b"".join(parts)
        return b"".join(map(self._ids, vocabulary.units(text)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        sections = self.vocab.sections(text)
        return b"".join(self._ordinary(s) if i is None else np.array([i], "<u4").tobytes() for s, i in sections)


def _encoder(data: bytes, lexicon: bytes) -> Encoder:
    return kept(("bpe", hash(data), hash(lexicon)), lambda: Encoder(vocabulary.load(data), lexicon))


def encode(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    lexicon_size: int = 65_536,
    error: float = 1e-6,
) -> DataFrame:
    """Returns the id column, ``n_tokens`` (long) and ``ids`` (binary, little-endian unsigned
    32-bit integers) of every row.

    ``tokenizer`` is a file of a byte-level BPE; texts are encoded whole, strings of added
    tokens become those tokens. A null text is empty and has no ids. Rows are not looked at
    together: repeated rows are repeated, ids may be null or tie, an empty table stays empty.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    with open(tokenizer_path(tokenizer), "rb") as file:
        content = file.read()
    data = spark.sparkContext.broadcast(content)
    words = frequent_words(docs, text, data, lexicon_size, error)
    lexicon = spark.sparkContext.broadcast(build_lexicon(words, vocabulary.load(content)))
    source = docs.select(column_named(docs, id_column).alias(id_column), text_column(docs, text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(data.value, lexicon.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = [encoder.encode(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                    [id_column, "n_tokens", "ids"],
                )

    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_column}` {kind}, n_tokens long, ids binary")


@lru_cache(maxsize=2)
def _pieces(data: bytes) -> list[bytes]:
    return vocabulary.load(data).pieces


def decode(encoded: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """Adds ``decoded`` (string) to the columns of ``encode``'s result.

    Bytes that are no UTF-8, possible in ids from elsewhere, become replacement characters.
    Null ids decode to null.
    """
    with open(tokenizer_path(tokenizer), "rb") as file:
        data = encoded.sparkSession.sparkContext.broadcast(file.read())
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(data.value)
        at_ids = names.index("ids")
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = []
                for value in part.column(at_ids):
                    raw = value.as_py()
                    if raw is None:
                        texts.append(None)
                        continue
                    ids = np.frombuffer(raw, "<u4").tolist()
                    texts.append(b"".join(map(pieces.__getitem__, ids)).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{schema}, decoded string")


assert sys.byteorder == "little", "flat tables are little-endian"
