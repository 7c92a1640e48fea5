"""A wavelet matrix over token ids: bit planes with rank and select, in one compressed file per shard."""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"WMTX0001"
BLOCK = 512  # bits between two entries of a plane's rank directory


class WaveletMatrix:
    """A sequence of ids, kept as one bit plane per bit of its alphabet's size.

    ``access``, ``rank``, ``select``, ``count`` and ``locate`` work on the planes; ``decode`` gives
    the whole sequence.
    """

    def __init__(self, n: int, alphabet: np.ndarray, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.alphabet, self.planes, self.zeros = n, alphabet, planes, zeros
        self._ranks: list[np.ndarray | None] = [None] * len(planes)

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        n = len(ids)
        top = int(ids.max()) + 1 if n else 0
        if top <= 1 << 20:
            alphabet = np.flatnonzero(np.bincount(ids, minlength=1)) if n else np.zeros(0, np.int64)
            lookup = np.zeros(max(top, 1), np.uint32)
            lookup[alphabet] = np.arange(len(alphabet))
            codes = lookup[ids]
        else:
            alphabet, codes = np.unique(ids, return_inverse=True)
        levels = max(1, int(len(alphabet) - 1).bit_length()) if len(alphabet) else 1
        codes = codes.astype(np.uint16 if levels <= 16 else np.uint32)
        planes, zeros = [], []
        for level in reversed(range(levels)):
            bit = (codes & codes.dtype.type(1 << level)) != 0
            planes.append(np.packbits(bit, bitorder="little"))
            low = codes[~bit]
            zeros.append(len(low))
            codes = np.concatenate((low, codes[bit]))
        return cls(n, alphabet.astype(np.uint32), planes, zeros)

    def decode(self) -> np.ndarray:
        """All ids, by merging the planes from the last to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        codes = np.zeros(self.n, kind)
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            bit = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            above = np.empty(self.n, kind)
            above[~bit] = codes[:zeros]
            above[bit] = codes[zeros:] | kind(1 << level)
            codes = above
        return self.alphabet[codes] if self.n else np.zeros(0, np.uint32)

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        if self._ranks[level] is None:
            ones = np.bitwise_count(self.planes[level]).astype(np.int64)
            per_block = np.add.reduceat(ones, np.arange(0, len(ones), BLOCK // 8)) if len(ones) else ones
            self._ranks[level] = np.concatenate(([0], np.cumsum(per_block)))
        block = i // BLOCK
        part = self.planes[level][block * (BLOCK // 8) : (i + 7) // 8]
        inside = np.unpackbits(part, count=i - block * BLOCK, bitorder="little").sum() if i % BLOCK else 0
        return int(self._ranks[level][block]) + int(inside)

    def _select(self, level: int, bit: int, j: int) -> int:
        """Where the ``j``-th (from 0) one or zero of a plane is, by halving on ranks."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            ones = self._rank1(level, middle + 1)
            if (ones if bit else middle + 1 - ones) <= j:
                low = middle + 1
            else:
                high = middle
        return low

    def _code(self, symbol: int) -> int | None:
        place = int(np.searchsorted(self.alphabet, symbol))
        return place if place < len(self.alphabet) and self.alphabet[place] == symbol else None

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        code = 0
        for level, zeros in enumerate(self.zeros):
            ones = self._rank1(level, i)
            bit = self.planes[level][i >> 3] >> (i & 7) & 1
            code = code << 1 | int(bit)
            i = zeros + ones if bit else i - ones
        return int(self.alphabet[code])

    def _range(self, code: int, i: int) -> tuple[int, int]:
        start = 0
        for level, zeros in enumerate(self.zeros):
            a, b = self._rank1(level, start), self._rank1(level, i)
            if code >> (len(self.zeros) - 1 - level) & 1:
                start, i = zeros + a, zeros + b
            else:
                start, i = start - a, i - b
        return start, i

    def rank(self, symbol: int, i: int) -> int:
        """How often an id occurs among the first ``i``."""
        code = self._code(symbol)
        if code is None:
            return 0
        start, end = self._range(code, min(i, self.n))
        return end - start

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, j: int) -> int:
        """The position of the ``j``-th occurrence, from 0."""
        code = self._code(symbol)
        if code is None or not 0 <= j < self.count(symbol):
            raise IndexError(j)
        place = self._range(code, self.n)[0] + j
        for level in reversed(range(len(self.zeros))):
            bit = code >> (len(self.zeros) - 1 - level) & 1
            place = self._select(level, bit, place - self.zeros[level] if bit else place)
        return place

    def locate(self, symbol: int) -> list[int]:
        """All positions of an id."""
        return [self.select(symbol, j) for j in range(self.count(symbol))]

    def sections(self) -> list[bytes]:
        head = struct.pack("<QI", self.n, len(self.planes)) + struct.pack(f"<{len(self.zeros)}Q", *self.zeros)
        return [head, self.alphabet.astype("<u4").tobytes(), *[p.tobytes() for p in self.planes]]

    @classmethod
    def of_sections(cls, sections: list[bytes]) -> WaveletMatrix:
        n, levels = struct.unpack_from("<QI", sections[0])
        zeros = list(struct.unpack_from(f"<{levels}Q", sections[0], 12))
        planes = [np.frombuffer(p, np.uint8) for p in sections[2 : 2 + levels]]
        return cls(n, np.frombuffer(sections[1], "<u4"), planes, zeros)


def pack(sections: list[bytes]) -> bytes:
    """A file: magic, number of sections, their packed lengths, then each packed on its own."""
    squeeze = zstandard.ZstdCompressor(level=1)
    packed = [squeeze.compress(s) for s in sections]
    return MAGIC + struct.pack(f"<I{len(packed)}Q", len(packed), *map(len, packed)) + b"".join(packed)


def unpack(data: bytes) -> list[bytes]:
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token shard")
    (n,) = struct.unpack_from("<I", data, len(MAGIC))
    sizes = struct.unpack_from(f"<{n}Q", data, len(MAGIC) + 4)
    at, out, open_ = len(MAGIC) + 4 + 8 * n, [], zstandard.ZstdDecompressor()
    for size in sizes:
        out.append(open_.decompress(data[at : at + size]))
        at += size
    return out


class Shard:
    """Documents of one file: their ids, their lengths in tokens, and the tokens as a wavelet matrix."""

    def __init__(self, doc_ids: list[int | None], lengths: np.ndarray, matrix: WaveletMatrix):
        self.doc_ids, self.lengths, self.matrix = doc_ids, lengths, matrix

    def to_bytes(self) -> bytes:
        ids = np.array([0 if d is None else d for d in self.doc_ids], "<i8")
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        return pack([ids.tobytes(), known.tobytes(), self.lengths.astype("<u8").tobytes(), *self.matrix.sections()])

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        ids, known, lengths, *matrix = unpack(data)
        numbers = np.frombuffer(ids, "<i8").tolist()
        doc_ids = [d if k else None for d, k in zip(numbers, known)]
        return cls(doc_ids, np.frombuffer(lengths, "<u8").astype(np.int64), WaveletMatrix.of_sections(matrix))
