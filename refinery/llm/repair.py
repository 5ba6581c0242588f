"""Re-Pair grammar compression of token ids, block by block.

Frequent pairs of neighbouring ids are replaced by nonterminals, again and again. A block
keeps its rules, how many ids each nonterminal stands for, and where each document begins,
so a document, or a range of its ids, is decoded without the rest of the block.
"""

from __future__ import annotations

import numpy as np

_SHIFT = np.uint64(32)
_SLOTS = 1 << 17
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _frequent(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where keys stand that occur ``least`` times or more, which of them, and those keys.

    Keys are counted in slots by a hash first, so that only those of full slots are sorted.
    """
    slot = ((keys * _MIX) >> np.uint64(47)).astype(np.int32)
    at = np.flatnonzero((np.bincount(slot, minlength=_SLOTS) >= least)[slot])
    held = keys[at]
    ordered = np.sort(held)
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.empty(0, np.int64)
    often = ordered[first[np.diff(first, append=len(ordered)) >= least]]
    if not len(often):
        return at[:0], at[:0], often
    which = np.minimum(np.searchsorted(often, held), len(often) - 1)
    exact = often[which] == held
    return at[exact], which[exact], often


def compress(ids: np.ndarray, ends: np.ndarray, first_rule: int, least: int = 6):
    """``ids`` of several documents, which end before the positions ``ends``, as symbols.

    Each round replaces all pairs that occur ``least`` times or more, from left to right, never
    across documents, until no pair of the block occurs so often. Symbols from ``first_rule`` on
    are nonterminals. Returns the symbols, the ends of the documents among them, and the rules
    as rows (left, right).

    A round leaves no occurrence of a pair that it replaces: those not taken overlap with one
    that is. So the next round only looks at pairs with a nonterminal of the last one.
    """
    symbols, ends = ids.astype(np.uint32), np.asarray(ends, np.int64)
    rules, newest = np.empty((0, 2), np.uint32), 0
    while len(symbols) > 1:
        new = symbols >= newest
        pairs = new[:-1] | new[1:]
        pairs[ends[(ends > 0) & (ends < len(symbols))] - 1] = False
        at = np.flatnonzero(pairs)
        found, rank, chosen = _frequent((symbols[at].astype(np.uint64) << _SHIFT) | symbols[at + 1], least)
        if not len(found):
            break
        at = at[found]
        # In a run of overlapping pairs every second one is taken.
        opens = np.concatenate(([True], np.diff(at) != 1))
        run = np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - run) % 2 == 0
        at, rank = at[taken], rank[taken]
        used = np.bincount(rank, minlength=len(chosen)) > 0
        newest = first_rule + len(rules)
        symbols = symbols.copy()
        symbols[at] = newest + (np.cumsum(used) - 1)[rank]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        ends = ends - np.searchsorted(at, ends - 1)
        symbols = symbols[keep]
        pair = chosen[used]
        rules = np.concatenate((rules, np.stack((pair >> _SHIFT, pair & np.uint64(0xFFFFFFFF)), 1).astype(np.uint32)))
    return symbols, ends, rules


def expansion_lengths(rules: np.ndarray, first_rule: int) -> np.ndarray:
    """How many ids each nonterminal stands for; a rule only uses earlier ones."""
    lengths = np.ones(len(rules), np.int64)
    left, right = rules[:, 0].astype(np.int64) - first_rule, rules[:, 1].astype(np.int64) - first_rule
    while True:
        now = np.where(left < 0, 1, lengths[np.maximum(left, 0)]) + np.where(right < 0, 1, lengths[np.maximum(right, 0)])
        if np.array_equal(now, lengths):
            return lengths
        lengths = now


def symbol_lengths(symbols: np.ndarray, lengths: np.ndarray, first_rule: int) -> np.ndarray:
    out = np.ones(len(symbols), np.int64)
    large = symbols >= first_rule
    out[large] = lengths[symbols[large].astype(np.int64) - first_rule]
    return out


def decompress(symbols: np.ndarray, rules: np.ndarray, first_rule: int) -> np.ndarray:
    """The ids that ``symbols`` stand for, of a whole block or of a part of it."""
    if not len(rules):
        return symbols.astype(np.uint32)
    lengths = expansion_lengths(rules, first_rule)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    # What each rule stands for, by repeated replacement; all rules together are short.
    pool = rules.reshape(-1).astype(np.uint32)
    while (pool >= first_rule).any():
        large = pool >= first_rule
        step = 1 + large.astype(np.int64)
        first = np.cumsum(step) - step
        out = np.empty(int(step.sum()), np.uint32)
        out[first[~large]] = pool[~large]
        used = rules[pool[large].astype(np.int64) - first_rule]
        out[first[large]], out[first[large] + 1] = used[:, 0], used[:, 1]
        pool = out
    # Ids stand before the rules in one pool, then each symbol is a range of it.
    large = symbols >= first_rule
    where = np.zeros(len(symbols), np.int64)
    where[large] = starts[symbols[large].astype(np.int64) - first_rule]
    step = np.ones(len(symbols), np.int64)
    step[large] = lengths[symbols[large].astype(np.int64) - first_rule]
    first = np.cumsum(step) - step
    out = np.empty(int(step.sum()), np.uint32)
    out[first[~large]] = symbols[~large]
    inside = np.repeat(where[large] - np.cumsum(step[large]) + step[large], step[large]) + np.arange(int(step[large].sum()))
    target = np.ones(len(out), bool)
    target[first[~large]] = False
    out[target] = pool[inside]
    return out


def decode_range(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first_rule: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start:stop`` of a run of symbols; only the symbols that hold them are decoded."""
    ends = np.cumsum(symbol_lengths(symbols, lengths, first_rule))
    if stop <= start or not len(ends):
        return np.empty(0, np.uint32)
    low = int(np.searchsorted(ends, start, "right"))
    high = int(np.searchsorted(ends, stop - 1, "right")) + 1
    before = int(ends[low - 1]) if low else 0
    return decompress(symbols[low:high], rules, first_rule)[start - before : stop - before]
