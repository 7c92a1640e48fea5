"""An n-gram trie whose levels are Elias-Fano sequences in one flat buffer."""

from __future__ import annotations

import mmap
import struct

import numpy as np


class EliasFano:
    """A non-decreasing sequence: low bits packed, high parts as a bitmap with one bit per element.

    The arrays may be views of a buffer or a mapped file. ``at`` reads elements, ``find`` looks for
    values among the elements of a range, both for many at a time.
    """

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        self._starts: np.ndarray | None = None
        self._ones: np.ndarray | None = None
        padded = np.frombuffer(low.tobytes() + bytes(8), np.uint8)
        self._words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(1, n)).bit_length() - 1)
        bits = np.zeros(n * width, np.uint8)
        for k in range(width):
            bits[k::width] = (values >> np.uint64(k)) & np.uint64(1)
        parts = (values >> np.uint64(width)).astype(np.int64)
        high = np.zeros(n + (top >> width) + 2, np.uint8)
        high[parts + np.arange(n)] = 1
        return cls(n, width, np.packbits(bits, bitorder="little"), np.packbits(high, bitorder="little"))

    def _open(self) -> None:
        if self._starts is None:
            bits = np.unpackbits(self.high, bitorder="little")
            zeros = np.flatnonzero(bits == 0)
            # Elements whose high part is below h: the ones before the h-th zero.
            self._starts = np.concatenate(([0], zeros - np.arange(len(zeros))))
            self._ones = np.flatnonzero(bits)

    def _low(self, places: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(places), np.uint64)
        at = places.astype(np.int64) * self.width
        return (self._words[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.width) - 1)

    def at(self, places: np.ndarray) -> np.ndarray:
        self._open()
        high = (self._ones[places] - places).astype(np.uint64)
        return high << np.uint64(self.width) | self._low(places)

    def find(self, values: np.ndarray, first: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> np.ndarray:
        """Place of each value among the elements from ``first`` to before ``end``; -1 where it is none of them.

        The successor search goes to the bucket of the value's high part and reads on while the low
        bits are smaller.
        """
        self._open()
        values = values.astype(np.uint64)
        part = (values >> np.uint64(self.width)).astype(np.int64)
        inside = part < len(self._starts) - 1
        part = np.where(inside, part, 0)
        at = np.maximum(self._starts[part], first)
        stop = np.minimum(self._starts[part + 1], self.n if end is None else end)
        stop = np.where(inside, stop, at)
        wanted = values & np.uint64((1 << self.width) - 1)
        out = np.full(len(values), -1, np.int64)
        open_ = np.flatnonzero(at < stop)
        while len(open_):
            low = self._low(at[open_])
            equal = low == wanted[open_]
            out[open_[equal]] = at[open_[equal]]
            at[open_] += 1
            open_ = open_[(low < wanted[open_]) & (at[open_] < stop[open_])]
        return out

    def to_bytes(self) -> bytes:
        return struct.pack("<QIIQ", self.n, self.width, len(self.low), len(self.high)) + _even(self.low.tobytes()) + _even(self.high.tobytes())

    @classmethod
    def of_buffer(cls, buffer, at: int) -> tuple[EliasFano, int]:
        n, width, low, high = struct.unpack_from("<QIIQ", buffer, at)
        at += 24
        lows = np.frombuffer(buffer, np.uint8, low, at)
        at += -(-low // 8) * 8
        highs = np.frombuffer(buffer, np.uint8, high, at)
        return cls(n, width, lows, highs), at + -(-high // 8) * 8


def _even(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


STEP = 1.09  # ratio of two neighbouring codes


def quantise(counts: np.ndarray) -> np.ndarray:
    """8-bit codes of log probabilities relative to one occurrence; within 4.5 per cent up to 3 * 10^9."""
    return np.minimum(np.rint(np.log(np.maximum(counts, 1)) / np.log(STEP)), 254).astype(np.uint8)


def counts_of(codes: np.ndarray) -> np.ndarray:
    return STEP ** codes.astype(np.float64)


class NgramTrie:
    """Contexts, pointers to their successors, successors, and a quantised probability per n-gram.

    Successors are made one non-decreasing sequence: each is stored plus the last value of the
    context before. A lookup finds the context, takes its range from the pointers, and looks for the
    successor relative to the value the range starts from.
    """

    MAGIC = b"EFTRIE01"

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.successors, self.codes = contexts, pointers, successors, codes

    @classmethod
    def build(cls, contexts: np.ndarray, successors: np.ndarray, counts: np.ndarray) -> NgramTrie:
        """From n-grams sorted by (context, successor), each once."""
        heads = np.flatnonzero(np.r_[True, contexts[1:] != contexts[:-1]]) if len(contexts) else np.zeros(0, np.int64)
        ends = np.r_[heads[1:], len(contexts)] if len(heads) else heads
        lasts = successors[ends - 1].astype(np.uint64) if len(heads) else np.zeros(0, np.uint64)
        base = np.cumsum(lasts) - lasts
        shifted = successors.astype(np.uint64) + np.repeat(base, ends - heads)
        return cls(EliasFano.build(contexts[heads]), EliasFano.build(np.r_[heads, len(contexts)]), EliasFano.build(shifted), quantise(counts))

    def find(self, contexts: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Codes of n-grams plus one; 0 for those the trie has not."""
        out = np.zeros(len(contexts), np.uint8)
        if not self.contexts.n:
            return out
        place = self.contexts.find(contexts)
        known = np.flatnonzero(place >= 0)
        first = self.pointers.at(place[known]).astype(np.int64)
        end = self.pointers.at(place[known] + 1).astype(np.int64)
        base = np.where(first > 0, self.successors.at(np.maximum(first - 1, 0)), np.uint64(0))
        found = self.successors.find(successors[known].astype(np.uint64) + base, first, end)
        out[known[found >= 0]] = self.codes[found[found >= 0]] + 1
        return out

    def to_bytes(self) -> bytes:
        parts = [self.contexts.to_bytes(), self.pointers.to_bytes(), self.successors.to_bytes()]
        return self.MAGIC + b"".join(parts) + struct.pack("<Q", len(self.codes)) + self.codes.tobytes()

    @classmethod
    def of_buffer(cls, buffer) -> NgramTrie:
        if bytes(buffer[:8]) != cls.MAGIC:
            raise ValueError("not a trie")
        contexts, at = EliasFano.of_buffer(buffer, 8)
        pointers, at = EliasFano.of_buffer(buffer, at)
        successors, at = EliasFano.of_buffer(buffer, at)
        (n,) = struct.unpack_from("<Q", buffer, at)
        return cls(contexts, pointers, successors, np.frombuffer(buffer, np.uint8, n, at + 8))

    @classmethod
    def open(cls, path: str) -> NgramTrie:
        """A trie in a file, mapped and not read."""
        with open(path, "rb") as file:
            return cls.of_buffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
