"""Byte-level BPE vocabularies read from a tokenizer file, and the splitting of texts.

A text is cut at *safe* spaces, those with a non-space on both sides: the split pattern
never matches across one, so what lies between two of them is encoded alike everywhere, and
its result can be remembered. The vocabulary travels to the executors as the bytes of its
file (a fixed size); no executor needs the path.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import regex
import tiktoken
from tokenizers import Tokenizer

# The split pattern of byte-level BPE, and the printable stand-ins of bytes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Above this code point the library's own splitter decides, as Unicode versions may differ.
_PLAIN = 0x250


def byte_of_char() -> dict[str, int]:
    """The byte that each stand-in character means: printable bytes mean themselves."""
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + n): b for n, b in enumerate(others)}


def plain(text: str) -> bool:
    """Whether all Unicode versions agree on the classes of the characters of ``text``."""
    return text.isascii() or max(text) < chr(_PLAIN)


class Vocabulary:
    """Pieces, ids and merges of one byte-level BPE file."""

    def __init__(self, data: bytes):
        described = json.loads(data)
        if (described.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or described.get("normalizer"):
            raise ValueError("only byte-level BPE without a normalizer is read here")
        of_char = byte_of_char()
        self.ids = {bytes(of_char[c] for c in p): i for p, i in described["model"]["vocab"].items() if all(c in of_char for c in p)}
        added = {t["content"]: t["id"] for t in described["added_tokens"]}
        for content in added:
            self.ids.pop(content.encode(), None)
        self.added = added
        self.added_pattern = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.pieces = [b""] * (max([*self.ids.values(), *added.values()]) + 1)
        for piece, i in [*self.ids.items(), *((t.encode(), i) for t, i in added.items())]:
            self.pieces[i] = piece
        self.longest = max(map(len, self.ids))
        merged = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in described["model"]["merges"]]
        order = [described["model"]["vocab"][a + b] for a, b in merged]
        if order != sorted(order):
            raise ValueError("ids do not follow the order of the merges")
        self._splitter = Tokenizer.from_str(data.decode()).pre_tokenizer
        self._of_char = of_char
        self._find = regex.compile(SPLIT).findall
        # Merges by rank inside one piece; the pattern takes the piece whole.
        self._merge = tiktoken.Encoding("pieces", pat_str="(?s:.+)", mergeable_ranks=self.ids, special_tokens={})._core_bpe.encode_single_piece

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece of the split pattern, by applying the merges in their order."""
        known = self.ids.get(piece)
        return [known] if known is not None else self._merge(piece)

    def split(self, text: str) -> list[bytes]:
        """Pieces of the split pattern."""
        if not plain(text):
            return [bytes(self._of_char[c] for c in p) for p, _ in self._splitter.pre_tokenize_str(text)]
        return [p.encode() for p in self._find(text)]

    def sections(self, text: str) -> list[tuple[str, int | None]]:
        """The text cut at added tokens; those with their id, ordinary text with None."""
        if not self.added_pattern or not self.added_pattern.search(text):
            return [(text, None)] if text else []
        return [(s, self.added.get(s)) for s in self.added_pattern.split(text) if s]


def units(text: str) -> list[str]:
    """The text cut before every safe space; joined they are the text."""
    first, *rest = _SAFE_SPACE.split(text)
    return [first, *(" " + r for r in rest)]


def safe_piece(piece: str) -> bool:
    """Whether the spaces on both sides of ``piece`` are safe as far as it decides that."""
    return bool(piece) and not piece[0].isspace() and not piece[-1].isspace()


@lru_cache(maxsize=4)
def _load(data: bytes) -> Vocabulary:
    return Vocabulary(data)


def load(data: bytes) -> Vocabulary:
    """The vocabulary of a file's bytes, read once per process."""
    return _load(data)
