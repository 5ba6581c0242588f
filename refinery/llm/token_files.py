"""Token ids of documents in files of grammar-compressed blocks, in the order of their ids.

The files are Parquet, one row per block, so that Spark writes them with its committer to
whatever store it can reach. A row holds

| column | content |
| --- | --- |
| part, ordinal | number of the writing task (ascending with the ids), and of the block in it |
| before | ids in earlier blocks of the part |
| first_rule | symbols from here on are nonterminals |
| doc_ids, n_tokens, ends | per document: id, token ids, end among the symbols |
| symbols, rules, lengths | little-endian: symbols, pairs (left, right), ids per nonterminal |
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from refinery.llm import repair
from refinery.llm.common import REMEMBERED, ROWS, column_named, earliest, partitions, text_column, tokenizer_path
from refinery.llm.vocabulary import byte_of_char

BLOCK = 262_144

_SCHEMA = (
    "part int, ordinal int, before long, first_rule long, doc_ids array<{kind}>, n_tokens array<long>, "
    "ends array<long>, symbols binary, rules binary, lengths binary"
)
_NAMES = ["part", "ordinal", "before", "first_rule", "doc_ids", "n_tokens", "ends", "symbols", "rules", "lengths"]
#: Marks that may follow a word; an apostrophe may belong to it.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class _Pieces(dict):
    """Ids of pieces, encoded when they are first asked for."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.encode(piece)
        return ids


class PieceEncoder:
    """Encodes what white space separates, and remembers it.

    White space only separates in this vocabulary, so the pieces of a text are encoded alike
    in any text. Texts with strings of added tokens or with characters on whose class the
    libraries may differ are encoded whole by the library.
    """

    def __init__(self, data: bytes):
        self.library = Tokenizer.from_str(data.decode())
        self.library.no_truncation()
        self.library.no_padding()
        self.size = self.library.get_vocab_size()
        self.added = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        self.known = _Pieces(self._piece)
        self.apart: dict[str, bool] = {}
        normal = self.library.normalizer.normalize_str("A \t b C") if self.library.normalizer else ""
        self._merge = self._word_merges(json.loads(data))
        self.by_piece = normal == "a b c" and not self.library.encode("a ", add_special_tokens=False).ids[1:]

    @staticmethod
    def _word_merges(described: dict):
        """Merges inside one word of letters, where ids follow the order of the merges.

        The mark of a word's end becomes the byte 255, which no text has; its pairs come
        before all merges, so it is joined to the last byte first, as the vocabulary has it.
        """
        model, suffix = described["model"], described["model"].get("end_of_word_suffix")
        merged = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        order = [model["vocab"].get(a + b, -1) for a, b in merged]
        if not suffix or order != sorted(order) or (order and order[0] < 512):
            return None
        of_char, ranks = byte_of_char(), {}
        for piece, i in model["vocab"].items():
            body, end = (piece[: -len(suffix)], b"\xff") if piece.endswith(suffix) else (piece, b"")
            if body and all(c in of_char for c in body):
                ranks[bytes(of_char[c] for c in body) + end] = i
        if len([r for r in ranks if len(r) == 1]) != 256:
            return None
        return tiktoken.Encoding("words", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _is_apart(self, marks: str) -> bool:
        """Whether the library cuts between a word and the ``marks`` after it."""
        if marks not in self.apart:
            cut = self.library.pre_tokenizer.pre_tokenize_str("a" + marks) if self.library.pre_tokenizer else []
            self.apart[marks] = bool(cut) and cut[0][1] == (0, 1)
        return self.apart[marks]

    def _piece(self, piece: str) -> bytes:
        word = piece.rstrip(_MARKS)
        if len(word) < len(piece) and word.isalpha() and self._is_apart(piece[len(word) :]):
            return self.known[word] + self.known[piece[len(word) :]]
        if self._merge and word == piece and word.isalpha() and max(word) <= "\xff":
            small = word.lower()
            if small != word:
                return self.known[small]
            if word.islower():
                return array("I", self._merge(word.encode() + b"\xff")).tobytes()
        return self._whole(piece)

    def _by_piece(self, text: str) -> bool:
        if not self.by_piece or any(a in text for a in self.added) or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return False
        # The first byte of all characters before U+0240 is 0xC8 at most.
        return text.isascii() or np.frombuffer(text.encode(), np.uint8).max() <= 0xC8

    def encode_all(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if len(self.known) > REMEMBERED:
                kept, self.known = earliest(self.known), _Pieces(self._piece)
                self.known.update(kept)
            out.append(b"".join(map(self.known.__getitem__, text.split())) if self._by_piece(text) else self._whole(text))
        return out


@lru_cache(maxsize=2)
def _encoder(data: bytes) -> PieceEncoder:
    return PieceEncoder(data)


def write_token_files(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 2,
    block: int = BLOCK,
) -> None:
    """Writes every row's ids, ``end_id`` after each, to ``path`` in ascending order of ids.

    Null texts are empty and hold the end id alone; null ids come first; rows with equal ids
    are ordered by their texts. A document is never split, so a block has ``block`` ids or
    the document that passes them. An empty table gives files without rows.
    """
    spark = docs.sparkSession
    with open(tokenizer_path(tokenizer), "rb") as file:
        data = spark.sparkContext.broadcast(file.read())
    source = docs.select(column_named(docs, id_column).alias("id"), text_column(docs, text))
    kind = source.schema["id"].dataType.simpleString()
    arranged = source.repartitionByRange(partitions(spark), "id").sortWithinPartitions("id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(data.value)
        first_rule = max(encoder.size, end_id + 1)
        part, ordinal, before = TaskContext.get().partitionId(), 0, 0
        ids, held, n_held = [], [], 0
        id_type = None

        def flush() -> pa.RecordBatch:
            stream = np.frombuffer(b"".join(held), "<u4")
            n = np.array([len(h) // 4 for h in held], np.int64)
            symbols, ends, rules = repair.compress(stream, np.cumsum(n), first_rule)
            lengths = repair.expansion_lengths(rules, first_rule)
            row = [
                pa.array([part], pa.int32()), pa.array([ordinal], pa.int32()), pa.array([before], pa.int64()),
                pa.array([first_rule], pa.int64()), pa.array([ids], pa.list_(id_type)),
                pa.array([n], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())),
                *(pa.array([x.astype("<u4").tobytes()], pa.binary()) for x in (symbols, rules, lengths)),
            ]
            return pa.RecordBatch.from_arrays(row, _NAMES)

        for batch in batches:
            id_type = batch.column(0).type
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                for doc, coded in zip(rows.column(0).to_pylist(), encoder.encode_all(rows.column(1).to_pylist())):
                    ids.append(doc)
                    held.append(coded + end)
                    n_held += len(coded) // 4 + 1
                    if n_held >= block:
                        yield flush()
                        ordinal, before = ordinal + 1, before + n_held
                        ids, held, n_held = [], [], 0
        if ids:
            yield flush()

    arranged.mapInArrow(run, _SCHEMA.format(kind=kind)).write.parquet(path)


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(row[k], "<u4") for k in ("symbols", "rules", "lengths"))


def read_token_files(spark: SparkSession, path: str, id_column: str = "doc_id", ids: bool = True) -> DataFrame:
    """Reads files of ``write_token_files``: the id, ``start`` (ids of all documents before
    it), ``n_tokens`` and ``ids_crc32``, and with ``ids`` the ids as little-endian unsigned
    32-bit integers."""
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["part", "at", "id", "n_tokens", "ids_crc32"] + ["ids"] * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                row = {n: one.column(n)[0].as_py() for n in ("part", "before", "first_rule", "symbols", "rules", "lengths")}
                n = np.array(one.column("n_tokens")[0].as_py(), np.int64)
                symbols, rules, _ = _arrays(row)
                stream = repair.decompress(symbols, rules.reshape(-1, 2), row["first_rule"])
                ends = np.cumsum(n)
                if len(stream) != (ends[-1] if len(ends) else 0):
                    raise ValueError("a block does not hold the ids it names")
                raw = stream.astype("<u4").tobytes()
                each = [raw[4 * (e - k) : 4 * e] for e, k in zip(ends.tolist(), n.tolist())]
                columns = [
                    pa.array([row["part"]] * len(n), pa.int32()), pa.array(row["before"] + ends - n, pa.int64()),
                    one.column("doc_ids")[0].values, pa.array(n, pa.int64()), pa.array([zlib.crc32(x) for x in each], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(each, pa.binary())] * ids, names)

    rows = blocks.mapInArrow(run, f"part int, at long, id {kind}, n_tokens long, ids_crc32 long" + ", ids binary" * ids)
    # One row per writing task, so the running sum over them stays small.
    totals = blocks.groupBy("part").agg(
        F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")
    )
    earlier = totals.select(
        F.col("part"),
        F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"),
    )
    kept = rows.join(earlier, "part").withColumn("start", F.col("at") + F.col("earlier"))
    return kept.select(F.col("id").alias(id_column), "start", "n_tokens", "ids_crc32", *["ids"] * ids)


def read_document(blocks: DataFrame, doc_id: int, start: int = 0, stop: int | None = None) -> np.ndarray | None:
    """Ids ``start:stop`` of one document, by random access: one block is read, and of it only
    the symbols of the document are expanded. None where there is no such document."""
    row = blocks.where(F.array_contains("doc_ids", doc_id)).limit(1).collect()
    if not row:
        return None
    row = row[0].asDict()
    k = row["doc_ids"].index(doc_id)
    symbols, rules, lengths = _arrays(row)
    own = symbols[row["ends"][k - 1] if k else 0 : row["ends"][k]]
    n = row["n_tokens"][k]
    return repair.decode_range(own, rules.reshape(-1, 2), lengths.astype(np.int64), row["first_rule"], start, n if stop is None else min(stop, n))
