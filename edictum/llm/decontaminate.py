"""Benchmark decontamination: n-gram seeds, the frequent ones behind a bound, then Smith-Waterman alignment."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from edictum.functions.names import fresh
from edictum.llm.common import utf8, words_of

GRAM = 3  # words of a seed
RARE = 0.001  # an n-gram is rare if no more than this share of all documents has it,
RARE_DOCS = 20  # or no more than so many documents
BLOCK_WORDS = 200_000  # words of the test items that are looked for at a time
MATCH, MISMATCH, GAP = 2, -1, 1
LEAST = 0.4  # of the score a whole copy of the item has


class Block(NamedTuple):
    """Some test items: their words as numbers, the n-grams that are looked for, and which of them are rare."""

    numbers: dict[bytes, int]  # from 1; 0 is any other word
    items: list[tuple[object, np.ndarray]]
    grams: np.ndarray  # sorted keys
    places: list[list[tuple[int, int]]]  # per key: (item, position in it)
    rare: np.ndarray  # per key

    def key(self, ids: np.ndarray) -> np.ndarray:
        """Keys of all n-grams of a sequence; -1 where a word is none of the items'."""
        n = len(ids) - GRAM + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        key, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(GRAM):
            part = ids[k : k + n]
            key = key * (len(self.numbers) + 1) + part
            known &= part > 0
        key[~known] = -1
        return key

    def ids(self, text: bytes) -> np.ndarray:
        words = words_of(text)
        get = self.numbers.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in the text, numbers of keys) of the n-grams found."""
        key = self.key(ids)
        if not len(key) or not len(self.grams):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(key >= 0)
        place = np.searchsorted(self.grams, key[at])
        same = self.grams[np.minimum(place, len(self.grams) - 1)] == key[at]
        return at[same], place[same]


def block_of(items: list[tuple[object, list[bytes]]]) -> Block:
    """All n-grams of some items."""
    numbers: dict[bytes, int] = {}
    for _, words in items:
        for w in words:
            numbers.setdefault(w, len(numbers) + 1)
    coded = [(item, np.array([numbers[w] for w in words], np.int64)) for item, words in items]
    empty = Block(numbers, coded, np.zeros(0, np.int64), [], np.zeros(0, bool))
    where: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i, (_, ids) in enumerate(coded):
        for at, key in enumerate(empty.key(ids).tolist()):
            where[key].append((i, at))
    keys = sorted(where)
    return empty._replace(grams=np.array(keys, np.int64), places=[where[k] for k in keys], rare=np.ones(len(keys), bool))


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The test items in blocks of bounded size, in order of item_id; the driver holds one at a time.

    Items without text, or of fewer than three words, cannot be told from any text and are left out.
    """
    rows = benchmark.select("item_id", utf8().alias("text")).orderBy("item_id", "text")
    held, size = [], 0
    for row in rows.toLocalIterator():
        words = words_of(bytes(row.text))
        if len(words) < GRAM:
            continue
        if held and size + len(words) > block_words:
            yield block_of(held)
            held, size = [], 0
        held.append((row.item_id, words))
        size += len(words)
    if held:
        yield block_of(held)


def rare_seeds(block: Block, docs: DataFrame, rare: float = RARE, rare_docs: int = RARE_DOCS) -> Block:
    """The block with the n-grams that occur, and which of them are rare by the number of documents that have them.

    Counts cover all documents. Frequent n-grams stay: a copy, or a part of one, that leaked into
    very many documents may have no others.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(len(block.grams), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0):
                found[np.unique(block.hits(block.ids(text.as_py()))[1])] += 1
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *some.tolist()]), pa.array([n, *found[some].tolist()])], ["gram", "n"])

    counted = docs.select(utf8().alias("text")).mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    frequency, n_docs = np.zeros(len(block.grams), np.int64), 0
    for row in counted.toLocalIterator():  # at most one row per n-gram of the block, and one for all documents
        if row.gram < 0:
            n_docs = row.n
        else:
            frequency[row.gram] = row.n
    occurs = np.flatnonzero(frequency)
    rare_ones = frequency[occurs] <= max(rare_docs, rare * n_docs)
    return block._replace(grams=block.grams[occurs], places=[block.places[g] for g in occurs.tolist()], rare=rare_ones)


def most_shared(item: np.ndarray, ids: np.ndarray) -> int:
    """The words that an alignment of the two can match, at most."""
    words, n = np.unique(item, return_counts=True)
    place = np.minimum(np.searchsorted(words, ids), len(words) - 1)
    found = np.bincount(place[words[place] == ids], minlength=len(words))
    return int(np.minimum(n, found).sum())


def best_cell(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman over two sequences: (score, last place in a, last place in b) of the best local alignment.

    Row by row; the gap along a row is a running maximum, so each row is a few array operations.
    """
    slope = GAP * np.arange(1, len(b) + 1)
    above = np.zeros(len(b) + 1, np.int64)
    best = (0, -1, -1)
    for i, x in enumerate(a.tolist()):
        row = np.maximum(above[:-1] + np.where(b == x, MATCH, MISMATCH), above[1:] - GAP)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + slope) - slope
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), i, j)
        above[1:] = row
    return best


def matches(block: Block, text: bytes, least: float = LEAST) -> list[tuple[object, float, int, int]]:
    """(item_id, score, first word, last word) for each item that the text holds a copy of.

    Seeds say where an item may begin; what lies around, wide enough for inserted words, is aligned
    with the whole item. A place without a rare seed is left out if too few of its words are the
    item's for any alignment to reach ``least``. Places that overlap are one. The best place of an
    item counts.
    """
    ids = block.ids(text)
    at, seed = block.hits(ids)
    if not len(at):
        return []
    spots: dict[int, dict[int, bool]] = defaultdict(dict)
    for p, s in zip(at.tolist(), seed.tolist()):
        for i, inside in block.places[s]:
            spots[i][p - inside] = spots[i].get(p - inside, False) or bool(block.rare[s])
    found = []
    for i, starts in spots.items():
        item_id, item = block.items[i]
        pad = len(item) // 3 + 4
        if not any(starts.values()) and most_shared(item, ids) / len(item) < least:
            continue
        windows: list[list[int]] = []
        for s in sorted(starts):
            a, b = max(0, s - pad), min(len(ids), s + len(item) + pad)
            if not starts[s] and most_shared(item, ids[a:b]) / len(item) < least:
                continue
            if windows and a <= windows[-1][1]:
                windows[-1][1] = max(b, windows[-1][1])
            else:
                windows.append([a, b])
        best = (0, 0, 0)
        for a, b in windows:
            score, i_end, j_end = best_cell(item, ids[a:b])
            if score > best[0]:
                _, _, back = best_cell(item[: i_end + 1][::-1], ids[a : a + j_end + 1][::-1])
                best = (score, a + j_end - back, a + j_end)
        share = best[0] / (MATCH * len(item))
        if share >= least:
            found.append((item_id, share, best[1], best[2]))
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word): documents that hold a copy of a test item.

    Score is the alignment's share of what an unchanged copy would have; at least ``least``. Copies
    whose words were changed, left out or added are found as long as one seed, three neighbouring
    words, is whole, however many documents have it. NULL or empty texts and NULL or very short items match nothing.
    """
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id bigint, item_id {item_type}, score double, first_word bigint, last_word bigint"
    kinds = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark, block_words):
        seeded = rare_seeds(block, docs)

        def run(batches: Iterator[pa.RecordBatch], seeded=seeded) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1)) for m in matches(seeded, t.as_py(), least)]
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind.type) for k, kind in enumerate(kinds)], schema=kinds)

        out = out.unionByName(rows.mapInArrow(run, schema))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that hold a copy of no test item, all columns as they were; narrow passes only."""
    for block in blocks(benchmark, block_words):
        seeded = rare_seeds(block, docs)

        def run(batches: Iterator[pa.RecordBatch], seeded=seeded) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = [not matches(seeded, t.as_py(), least) for t in batch.column(batch.num_columns - 1)]
                kept = batch.filter(pa.array(keep, pa.bool_()))
                yield pa.RecordBatch.from_arrays(kept.columns[:-1], schema=pa.schema(list(kept.schema)[:-1]))

        (searched,) = fresh(docs, "utf8")
        docs = docs.withColumn(searched, utf8()).mapInArrow(run, docs.schema)
    return docs


