"""Which texts of a group another text of the group holds, for all of them at once.

A text is entered into a filter by the stretches it begins with: those that end where a binary digit of its
length in bytes does (of 13 bytes the first 8, the first 12, all 13). A search goes over the places of a
text, takes the stretch of 8 bytes there, and goes on to 12 and 13 as long as the filter knows what it has:
a text that lies there is always come upon, and a beginning that very many texts share costs one step a
place, not one for each of them. The hash of any stretch is a difference of running sums, so a step is a few
passes over arrays. Texts of 16 bytes and more are looked for only where the filter knows 16 bytes, so few places
are asked about their many lengths. What is come upon is cut out and looked up by its digest; the filter only
saves lookups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edictum.session import stage

BLOCK = 1 << 18  # bytes of text that are searched at a time
GATE = 4  # texts of 2 ** GATE bytes and more are also entered by so many bytes
TASK = 16 << 20  # bytes of text a task has, about
WORDS = 1 << 23  # of 64 bits: the largest filter, which every Python worker holds
ROUND = 8_000_000  # texts a filter is made for; more take another filter and another search each
PART = 1 << 16  # words of a filter that one row carries
ENTRIES = 6  # of a text in the filter, about


def _passes(words: int, block: int):
    """(enter, mark, search): what the workers run for a filter of ``words``. Made in here, so that they need not find this module."""
    number = np.uint64
    one, mask, part_bits = number(1), number(words - 1), number(PART.bit_length() - 1)
    base = 0x9E3779B97F4A7C15
    back = pow(base, -1, 1 << 64)
    by_length, whole_text = number(0xD6E8FEB86659FD93), number(0xA5A3564E27F8B1C5)
    powers = {}

    def power(of: int, n: int) -> np.ndarray:
        """of ** 0 .. of ** (n - 1), modulo 2 ** 64 as all sums here."""
        if len(powers.get(of, ())) < n:
            powers[of] = np.cumprod(np.concatenate([np.ones(1, number), np.full(max(n, block) - 1, of, number)]))
        return powers[of][:n]

    def mixed(h: np.ndarray) -> np.ndarray:
        """The hash for a key, in place."""
        h *= number(0xBF58476D1CE4E5B9)
        h ^= h >> number(32)
        h *= number(0x94D049BB133111EB)
        h ^= h >> number(29)
        return h

    def bit(h: np.ndarray, k: int) -> np.ndarray:
        return h >> number(58 - 6 * k) & number(63)

    def known(table: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Places in ``h`` of what the filter has, or seems to have."""
        seen = table[(h & mask).view(np.int64)]
        seen >>= bit(h, 0)
        seen &= one
        at = np.flatnonzero(seen.view(np.int64))
        for k in (1, 2):
            some = h[at]
            at = at[(table[(some & mask).view(np.int64)] >> bit(some, k) & one).astype(bool)]
        return at

    class Block:
        """Some texts, one after the other, from ``starts`` to ``ends``."""

        def __init__(self, data: np.ndarray, bounds: np.ndarray, seeds: np.ndarray):
            self.data, self.starts, self.ends, self.seeds = data, bounds[:-1], bounds[1:], seeds
            self.lengths = np.diff(bounds)
            self.longest = int(self.lengths.max())
            self.sums = np.zeros(len(data) + 1, number)
            np.cumsum((data.astype(number) + one) * power(base, len(data)), out=self.sums[1:])
            self.back = power(back, len(data))

        def key(self, at: np.ndarray, length, of: np.ndarray, salt=number(0)) -> np.ndarray:
            """Keys of the stretches at some places of the texts ``of``."""
            h = (self.sums[at + length] - self.sums[at]) * self.back[at]
            return mixed(h ^ (self.seeds[of] + np.asarray(length).astype(number) * by_length + salt))

        def keys(self, length: int) -> np.ndarray:
            """Keys of the stretches of one length at all places, also across the end of a text."""
            n = len(self.data) + 1 - length
            h = self.sums[length:] - self.sums[:n]
            h *= self.back[:n]
            h ^= np.repeat(self.seeds + np.full(1, length, number) * by_length, self.lengths)[:n]
            return mixed(h)

        def of(self, at: np.ndarray) -> np.ndarray:
            return np.searchsorted(self.ends, at, "right")

    def blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, Block]]:
        """The texts of a batch (seed, text, ...) in blocks, each with the row it begins at."""
        if not batch.num_rows:
            return
        seeds = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(number)
        texts = batch.column(1).cast(pa.large_binary())
        _, bounds, data = texts.buffers()
        bounds = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + block, "right")) - 1)
            cut = bounds[first : last + 1]
            yield first, Block(data[cut[0] : cut[-1]], cut - cut[0], seeds[first:last])
            first = last

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(part, keys): what is to be entered, by the part of the filter it belongs to."""
        for batch in batches:
            found = []
            for _, texts in blocks(batch):
                every, upto = np.arange(len(texts.lengths)), np.zeros(len(texts.lengths), np.int64)
                for j in reversed(range(texts.longest.bit_length())):
                    some = every[texts.lengths >> j & 1 == 1]
                    upto[some] += 1 << j
                    found.append(texts.key(texts.starts[some], upto[some], some))
                some = every[texts.lengths >= 2 << GATE]
                found.append(texts.key(texts.starts[some], 1 << GATE, some))
                found.append(texts.key(texts.starts, texts.lengths, every, whole_text))
            if not found:
                continue
            keys = np.concatenate(found)
            part = ((keys & mask) >> part_bits).astype(np.int64)
            order = np.argsort(part, kind="stable")
            names, first = np.unique(part[order], return_index=True)
            rows = [k.tobytes() for k in np.split(keys[order], first[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(rows, pa.binary())], ["part", "keys"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(part, words): the parts of the filter, from all keys that belong to them."""
        size = min(words, PART)
        parts = {}
        for batch in batches:
            for part, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = np.frombuffer(keys, number)
                bits = one << bit(h, 0) | one << bit(h, 1) | one << bit(h, 2)
                np.bitwise_or.at(parts.setdefault(part, np.zeros(size, number)), (h & number(size - 1)).astype(np.int64), bits)
        for part, marked in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([marked.tobytes()], pa.binary())], ["part", "words"])

    def stretches(texts: Block, table: np.ndarray, short: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(places, lengths) of the stretches that the filter knows as whole texts; ``short`` are the highest digits below the gate."""

        def beginning(j: int) -> np.ndarray:
            """Places of 2 ** j bytes that the filter knows."""
            if texts.longest < 1 << j:
                return np.zeros(0, np.int64)
            at = known(table, texts.keys(1 << j))
            at = at[texts.data[at] & 0xC0 != 0x80]  # no text begins within a character
            return at[texts.ends[texts.of(at)] - at >= 1 << j]

        gate = beginning(GATE)
        gate_of = texts.of(gate)
        gate_room = texts.ends[gate_of] - gate
        at, length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for j in reversed(range(texts.longest.bit_length())):
            if j > GATE:
                some = np.flatnonzero(gate_room >= 1 << j)
                begun = gate[some[known(table, texts.key(gate[some], 1 << j, gate_of[some]))]]
            else:
                begun = gate if j == GATE else beginning(j) if j in short else at[:0]
            of = texts.of(at)
            more = np.flatnonzero(texts.ends[of] - at >= length + (1 << j))
            further, longer = at[more], length[more] + (1 << j)
            hit = known(table, texts.key(further, longer, of[more]))
            at = np.concatenate([at, further[hit], begun])
            length = np.concatenate([length, longer[hit], np.full(len(begun), 1 << j)])
        of = texts.of(at)
        done = known(table, texts.key(at, length, of, whole_text))
        done = done[length[done] < texts.lengths[of[done]]]
        return at[done], length[done]

    def search(filter_words, short: list[int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The columns behind (seed, text) of each text, with the digest of what it holds; each digest once."""
        table = np.frombuffer(filter_words.value, number)
        for batch in batches:
            kept = pa.RecordBatch.from_arrays(batch.columns[2:], schema=pa.schema(list(batch.schema)[2:]))
            for first, texts in blocks(batch):
                raw = texts.data.tobytes()
                at, length = stretches(texts, table, short)
                cut = {(i, raw[p : p + n]) for i, p, n in zip(texts.of(at).tolist(), at.tolist(), length.tolist())}
                if cut:
                    held = pa.array([hashlib.md5(c).digest() for _, c in cut], pa.binary())
                    rows = kept.take(pa.array([first + i for i, _ in cut], pa.int64()))
                    yield pa.RecordBatch.from_arrays([*rows.columns, held], [*rows.schema.names, "held"])

    return enter, mark, search


def held_texts(texts: DataFrame, columns: list[str], block: int = BLOCK, most: int = ROUND, words: int = WORDS) -> DataFrame:
    """Rows of ``columns`` of each text with ``held``, the MD5 digest of a shorter text of its group that occurs in it.

    ``texts`` has a group ``grp`` and its different texts ``t``, none of them NULL or empty; it is read
    several times. The result is staged. Each pair comes once; a stretch that the filter knows by mistake
    comes as the digest of no text.
    """
    spark = texts.sparkSession
    length = F.octet_length("t")
    digit = F.length(F.bin(length)) - 1  # the highest
    size = texts.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(length), F.lit(0)).alias("bytes"), F.collect_set(F.when(digit < GATE, digit)).alias("short")
    ).first()
    cores = spark.sparkContext.defaultParallelism
    tasks = min(3 * cores, size.bytes // block + 1)
    rows = texts.select(F.xxhash64("grp").alias("_seed"), F.col("t").cast("binary").alias("_text"), *columns)
    if rows.rdd.getNumPartitions() < tasks:
        rows = rows.repartition(max(tasks, -(-size.bytes // TASK)))
    schema = T.StructType([*texts.select(*columns).schema.fields, T.StructField("held", T.BinaryType())])
    rounds = -(-size.n // most) or 1
    need = ENTRIES * size.n // rounds // 4  # four entries of three bits in a word
    words = min(words, max(1 << 10, 1 << need.bit_length()))
    enter, mark, search = _passes(words, block)
    found = []
    for k in range(rounds):
        some = rows.select("_seed", "_text")
        if rounds > 1:
            some = some.where(F.pmod(F.xxhash64("_text"), F.lit(rounds)) == k)
        keys = some.mapInArrow(enter, "part int, keys binary").repartition(min(cores, max(1, words // PART)), "part")
        bits = bytearray(8 * words)
        for row in keys.mapInArrow(mark, "part int, words binary").collect():  # together as large as the filter
            at = 8 * min(words, PART) * row.part
            bits[at : at + len(row.words)] = row.words
        table = spark.sparkContext.broadcast(bytes(bits))
        found.append(stage(rows.mapInArrow(lambda batches, table=table: search(table, size.short, batches), schema)))
        table.destroy()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
