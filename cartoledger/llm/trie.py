"""Elias-Fano n-gram trie in compact memory-mapped levels.

Level 1 holds the contexts, sorted by hash, with the quantised weight each
leaves to the shorter history; level 2 holds their children. The children's
ids inside a context are rising, and become one monotone sequence by adding
the last value of the context before ("context-relative"), so both that
sequence and the pointers into it are Elias-Fano coded. A child is found by
its context's pointers and a successor search.
"""

from __future__ import annotations

import os

import numpy as np

ABSENT = 255
STEP = 0.04  # decades of probability per code


def quantise(values: np.ndarray) -> np.ndarray:
    """8-bit codes of probabilities on a logarithmic scale."""
    with np.errstate(divide="ignore"):
        codes = np.rint(-np.log10(values) / STEP)
    return np.clip(codes, 0, ABSENT - 1).astype(np.uint8)


def dequantise(codes: np.ndarray) -> np.ndarray:
    """Probabilities of codes; zero for ``ABSENT``."""
    return np.where(codes == ABSENT, 0.0, 10.0 ** (-STEP * codes.astype(np.float64)))


class EliasFano:
    """A monotone sequence: ``low`` bits packed per value, the rest in unary in ``high``; both memory-mapped."""

    def __init__(self, folder: str, name: str, values: np.ndarray) -> None:
        self.n = n = len(values)
        values = values.astype(np.uint64)
        top = int(values[-1]) + 1 if n else 1
        self.bits = max(0, (top // max(1, n)).bit_length() - 1)
        low = values & np.uint64((1 << self.bits) - 1)
        packed = ((low[:, None] >> np.arange(self.bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        heads = (values >> np.uint64(self.bits)).astype(np.int64)
        unary = np.zeros(n + (int(heads[-1]) if n else 0) + 1, np.uint8)
        unary[heads + np.arange(n)] = 1
        self.low = _mapped(folder, f"{name}.low", np.packbits(packed.ravel(), bitorder="little"))
        self.high = _mapped(folder, f"{name}.high", np.packbits(unary, bitorder="little"))
        self.size = len(unary)
        # Directory over the unary bits: ones before each byte.
        ones = np.bitwise_count(np.asarray(self.high))
        self.rank = np.concatenate(([0], np.cumsum(ones, dtype=np.int64)))

    def _select(self, at: np.ndarray, ones: bool) -> np.ndarray:
        """Bit position of the ``at``-th one (or zero) of the unary part."""
        before = self.rank if ones else np.arange(len(self.rank)) * 8 - self.rank
        byte = np.searchsorted(before, at, side="right") - 1
        left = at - before[byte]
        bits = np.unpackbits(np.asarray(self.high)[byte][:, None], axis=1, bitorder="little")
        seen = np.cumsum(bits if ones else 1 - bits, axis=1)
        return byte * 8 + np.argmax(seen > left[:, None], axis=1)

    def _low(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        base = at * self.bits
        for b in range(self.bits):
            place = base + b
            out |= ((np.asarray(self.low)[place >> 3] >> (place & 7)) & 1).astype(np.int64) << b
        return out

    def get(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at, np.int64)
        if not len(at):
            return at
        return ((self._select(at, True) - at) << self.bits) | self._low(at)

    def successor(self, wanted: np.ndarray) -> np.ndarray:
        """Index of the first value not below each wanted one (``n`` if there is none)."""
        wanted = np.asarray(wanted, np.int64)
        heads = wanted >> self.bits
        zeros = self.size - self.n
        inside = heads < zeros
        h = np.where(inside, heads, 0)
        # values whose high part is smaller end before the h-th run of ones
        first = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - np.maximum(h - 1, 0), 0)
        last = self._select(h, False) - h
        low = wanted & ((1 << self.bits) - 1)
        a, b = first.copy(), last.copy()
        while (open_ := a < b).any():
            mid = (a + b) >> 1
            less = open_.copy()
            less[open_] = self._low(mid[open_]) < low[open_]
            a = np.where(less, mid + 1, a)
            b = np.where(open_ & ~less, mid, b)
        return np.where(inside, a, self.n)


def _mapped(folder: str, name: str, data: np.ndarray) -> np.ndarray:
    """Write a level's bytes and map them."""
    path = os.path.join(folder, name)
    data.tofile(path)
    return np.memmap(path, data.dtype, "r") if len(data) else data


class Trie:
    """Two levels: contexts and their children.

    ``contexts`` are sorted distinct hashes; ``owner`` and ``child`` the index
    of the context and the id of the child of each pair, sorted by both.
    """

    def __init__(
        self,
        folder: str,
        contexts: np.ndarray,
        rest: np.ndarray,
        owner: np.ndarray,
        child: np.ndarray,
        probability: np.ndarray,
    ) -> None:
        counts = np.bincount(owner, minlength=len(contexts)) if len(contexts) else np.zeros(0, np.int64)
        ends = np.cumsum(counts)
        self.contexts = _mapped(folder, "contexts", contexts)
        self.rest = _mapped(folder, "rest", quantise(rest))
        self.probability = _mapped(folder, "probability", quantise(probability))
        self.pointers = EliasFano(folder, "pointers", np.concatenate(([0], ends)))
        widths = np.zeros(len(contexts), np.int64)
        full = counts > 0
        widths[full] = child[ends[full] - 1] + 1
        before = np.cumsum(widths) - widths
        self.children = EliasFano(folder, "children", child + before[owner])

    def _base(self, context: np.ndarray) -> np.ndarray:
        """What was added to the ids of a context: one more than the value before its first child."""
        start = self.pointers.get(context)
        return np.where(start > 0, self.children.get(np.maximum(start - 1, 0)) + 1, 0)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each context, -1 if absent."""
        if not len(self.contexts):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.contexts, hashes), len(self.contexts) - 1)
        return np.where(np.asarray(self.contexts)[at] == hashes, at, -1)

    def rests(self, context: np.ndarray) -> np.ndarray:
        """Codes of the weight that contexts leave to the shorter history (0, which is one, for absent contexts)."""
        return np.where(context >= 0, np.asarray(self.rest)[np.maximum(context, 0)] if len(self.rest) else 0, 0).astype(
            np.uint8
        )

    def codes(self, context: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Code of each child's probability inside its context, ``ABSENT`` if there is none."""
        out = np.full(len(context), ABSENT, np.uint8)
        known = np.flatnonzero((context >= 0) & (child >= 0))
        if not len(known) or not self.children.n:
            return out
        c = context[known]
        wanted = child[known] + self._base(c)
        at = self.children.successor(wanted)
        stop = self.pointers.get(c + 1)
        start = self.pointers.get(c)
        inside = (at >= start) & (at < stop)
        same = inside.copy()
        same[inside] = self.children.get(at[inside]) == wanted[inside]
        out[known[same]] = np.asarray(self.probability)[at[same]]
        return out
