"""A minimal acyclic transducer from words to id sequences, in one flat block of bytes."""

from __future__ import annotations

import mmap
import struct
import tempfile
from array import array
from collections.abc import Iterable

_HEADER = struct.Struct("<4I")


class _State:
    __slots__ = ("arcs", "final", "last")

    def __init__(self):
        self.arcs: dict[int, list] = {}  # label -> [target, output]
        self.final = False
        self.last: tuple = ()  # what is put out at the end of a word


def _common(a: tuple, b: tuple) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """Words with their ids as a transducer; equal suffixes share their states.

    Ids stand as early on a path as all its words agree on them, so that the ends of paths
    put out nothing and can be shared. Words may come in any order; of repeated words the
    first one counts.
    """
    frozen: dict[tuple, int] = {}
    states: list[tuple] = []

    def freeze(state: _State) -> int:
        key = (state.final, state.last, tuple((c, t, o) for c, (t, o) in sorted(state.arcs.items())))
        if key not in frozen:
            frozen[key] = len(states)
            states.append(key)
        return frozen[key]

    path, before = [_State()], b""
    seen = None
    for word, ids in sorted(entries, key=lambda e: e[0]):
        if word == seen or not word:
            continue
        seen, out = word, tuple(ids)
        shared = 0
        while shared < min(len(word), len(before)) and word[shared] == before[shared]:
            shared += 1
        for depth in range(len(before), shared, -1):
            path[depth - 1].arcs[before[depth - 1]][0] = freeze(path[depth])
        del path[shared + 1 :]
        for depth in range(shared):
            arc = path[depth].arcs[word[depth]]
            n = _common(arc[1], out)
            rest, arc[1], out = arc[1][n:], arc[1][:n], out[n:]
            if rest:
                child = path[depth + 1]
                for below in child.arcs.values():
                    below[1] = rest + below[1]
                if child.final:
                    child.last = rest + child.last
        for depth in range(shared, len(word)):
            path[depth].arcs[word[depth]] = [-1, () if depth > shared else out]
            path.append(_State())
        path[-1].final = True
        if shared == len(word):
            path[-1].last = out
        before = word
    for depth in range(len(before), 0, -1):
        path[depth - 1].arcs[before[depth - 1]][0] = freeze(path[depth])
    start = freeze(path[0])

    # A state: first arc, number of arcs, length of the last output (255: not final), its place.
    # An arc: target, length and place of its output. Each is one 64-bit word.
    pool, places = array("I"), {}

    def place(out: tuple) -> int:
        if out not in places:
            places[out] = len(pool)
            pool.extend(out)
        if len(out) > 254 or len(pool) >= 1 << 24:
            raise ValueError("the words' ids are too many for this format")
        return places[out]

    heads, labels, arcs, lasts = array("Q"), bytearray(), array("Q"), array("Q")
    for final, last, own in states:
        heads.append(len(labels) << 9 | len(own))
        lasts.append(place(last) << 8 | (len(last) if final else 255))
        for label, target, out in own:
            labels.append(label)
            arcs.append(target << 32 | place(out) << 8 | len(out))
    return (
        _HEADER.pack(len(states), len(labels), len(pool), start)
        + b"".join(a.tobytes() for a in (heads, lasts, arcs, pool))
        + bytes(labels)
    )


class Lexicon:
    """A compiled transducer, mapped from a nameless file of this process."""

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        n, arcs, pool, self.start = _HEADER.unpack_from(self.map)
        view, at = memoryview(self.map), _HEADER.size
        self.heads = view[at : (at := at + 8 * n)].cast("Q")
        self.lasts = view[at : (at := at + 8 * n)].cast("Q")
        self.arcs = view[at : (at := at + 8 * arcs)].cast("Q")
        self.pool = view[at : (at := at + 4 * pool)].cast("I")
        self.labels = at
        self.letters = [bytes([b]) for b in range(256)]

    def get(self, word: bytes) -> list[int] | None:
        """The ids of ``word``, None where the lexicon does not have it."""
        heads, arcs, pool, find, base, letters = self.heads, self.arcs, self.pool, self.map.find, self.labels, self.letters
        state, out = self.start, []
        for byte in word:
            head = heads[state]
            first = base + (head >> 9)
            at = find(letters[byte], first, first + (head & 511))
            if at < 0:
                return None
            arc = arcs[at - base]
            state = arc >> 32
            if n := arc & 255:
                place = (arc >> 8) & 0xFFFFFF
                out += pool[place : place + n]
        last = self.lasts[state]
        if (n := last & 255) == 255:
            return None
        return out + pool[last >> 8 : (last >> 8) + n].tolist()
