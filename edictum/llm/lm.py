"""Language-model scoring with a sharded Elias-Fano n-gram trie.

Documents are taken in blocks of bounded size. A block's distinct words, then its distinct word
pairs, go to shards of the model by key; a shard adds up what all blocks learned, builds its part of
the trie, and answers each block's keys from it. So neither the vocabulary nor the pairs ever meet
in one place, and a task holds one block or one shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edictum.llm.common import grouped, stage, unstage, utf8
from edictum.llm.trie import NgramTrie, counts_of

BLOCK_BYTES = 8 << 20  # text of a block; a longer document is one of its own
SHARD_KEYS = 1_000_000  # keys that reach a shard
FAN_OUT = 64  # shards that a frequent context is spread over
PRIOR = 200.0  # weight of the unigram level under a context
END = b"\n"  # no word has white space in it


def _pack(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _narrow(values: np.ndarray, width: int) -> bytes:
    """Integers in ``width`` bytes each."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _wide(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


BLOCKS = "block bigint, n_words bigint, docs binary, tokens binary, words binary, trained binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (doc_id, held_out, text) to blocks: words by hash, tokens as places among them."""
    import xxhash

    part, seq = TaskContext.get().partitionId(), 0
    ids: list[int | None] = []
    held: list[bool] = []
    lengths: list[int] = []
    index: dict[bytes, int] = {END: 0}
    tokens: list[np.ndarray] = []
    size = 0

    def close() -> pa.RecordBatch:
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in index), np.uint64, len(index))
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        stream = rank[np.concatenate(tokens)]
        learned = np.repeat(~np.array(held), lengths)
        trained = np.bincount(stream[learned], minlength=len(index)).astype("<u4")
        docs = np.array([[0 if d is None else d, d is None, h, n] for d, h, n in zip(ids, held, lengths)], "<i8")
        row = [(part << 32) + seq, len(index), _pack(docs), _pack(stream), hashes[order].astype("<u8").tobytes(), _pack(trained)]
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["block", "n_words", "docs", "tokens", "words", "trained"])

    for batch in batches:
        for doc_id, held_out, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            text = value.as_py()
            words = text.lower().split()  # on bytes: A-Z and ASCII white space alone
            words.append(END)
            place = index.setdefault
            tokens.append(np.fromiter((place(w, len(index)) for w in words), np.int32, len(words)))
            ids.append(doc_id)
            held.append(held_out)
            lengths.append(len(words))
            size += len(text)
            if size >= BLOCK_BYTES:
                yield close()
                ids, held, lengths, index, tokens, size, seq = [], [], [], {END: 0}, [], 0, seq + 1
    if ids:
        yield close()


KEYS = "shard bigint, block bigint, keys binary, counts binary"
ANSWERS = "block bigint, shard bigint, n bigint, total bigint, first binary, second binary"
_ANSWERS = ["block", "shard", "n", "total", "first", "second"]


def _answer(rows: list[list]) -> pa.RecordBatch:
    kinds = [*[pa.int64()] * 4, pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], _ANSWERS)


def _key_rows(block: int, shards: np.ndarray, keys: np.ndarray, counts: np.ndarray, width: int) -> pa.RecordBatch:
    """Keys of a block, ordered by shard and then key, as a row per shard."""
    heads = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]])
    ends = np.r_[heads[1:], len(shards)]
    cuts = list(zip(heads.tolist(), ends.tolist()))
    columns = [
        pa.array(shards[heads], pa.int64()), pa.array([block] * len(heads), pa.int64()),
        pa.array([_narrow(keys[a:b], width) for a, b in cuts], pa.binary()), pa.array([_pack(counts[a:b].astype("<u4")) for a, b in cuts], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["shard", "block", "keys", "counts"])


def _merged(members: Iterator[dict], width: int) -> tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray]:
    """Blocks, their keys, all different keys and how often they were learned."""
    blocks, keys, counts = [], [], []
    for row in members:
        blocks.append(row["block"])
        keys.append(_wide(row["keys"], width))
        counts.append(_unpack(row["counts"], "<u4"))
    every, places = np.unique(np.concatenate(keys), return_inverse=True)
    return blocks, keys, every, np.bincount(places, np.concatenate(counts), len(every)).astype(np.int64)


def _shard_of_word(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _unigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of a shard; to each block its words' counts and ranks among the learned words."""
    for (shard,), members in grouped(batches, ["shard"]):
        blocks, keys, every, total = _merged(members, 8)
        learned = total > 0
        rank = np.cumsum(learned) - 1
        yield _answer([[-1, shard, int(learned.sum()), int(total.sum()), None, None]])
        for block, own in zip(blocks, keys):
            place = np.searchsorted(every, own)
            ranks = np.where(learned[place], rank[place], -1)
            yield _answer([[block, shard, 0, 0, _pack(total[place].astype("<u8")), _pack(ranks.astype("<i4"))]])


def _pairs(stream: np.ndarray, ids: np.ndarray, end: int, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of each token with the one before it, and whether both words were learned."""
    before = np.r_[end, stream[:-1]]
    known = (ids[before] >= 0) & (ids[stream] >= 0)
    return np.where(known, ids[before] * vocabulary + ids[stream], -1), known


class Model:
    """What a run learned: totals, and the tries' place."""

    def __init__(self, tokens: int, vocabulary: int, offsets: dict[int, int], shards: int, tries: DataFrame | None = None):
        self.tokens, self.vocabulary, self.offsets, self.shards, self.tries = tokens, vocabulary, offsets, shards, tries


def score_documents(docs: DataFrame, prior: float = PRIOR) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) from (doc_id, held_out, text).

    Words are lower case in A-Z, between ASCII white space, then one end per document. Counts come
    from all documents that are not held out. ``base_score`` adds log10((c + 1) / (N + 1 * (V + 1)))
    over the tokens, with exact counts. ``score`` is log10 of the bigram model's probability: under
    the word before (the end, for the first) a word has (c12 + prior * p) / (c1 + prior), p its
    unigram probability as above and c12 from the trie's quantised level; probabilities add up to one
    but for the rounding. NULL texts count as empty; repeated rows are documents of their own; with
    nothing learned every token has probability 1.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("held_out", F.lit(False)).alias("held_out"), utf8().alias("text"))
    blocks = stage(rows.mapInArrow(_blocks, BLOCKS), "lm-blocks", compression="none")
    n_keys = blocks.agg(F.sum("n_words")).first()[0] or 0
    shards = -(-n_keys // SHARD_KEYS) or 1

    def word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes = np.frombuffer(row["words"], "<u8")
                yield _key_rows(row["block"], _shard_of_word(hashes, shards).astype(np.int64), hashes, _unpack(row["trained"], "<u4"), 8)

    keyed = blocks.select("block", "words", "trained").mapInArrow(word_keys, KEYS)
    counted = stage(_by(keyed, "shard", "block").mapInArrow(_unigrams, ANSWERS), "lm-words", compression="none")
    sums = counted.where("block = -1").select("shard", "n", "total").orderBy("shard").collect()  # a row per shard
    offsets, vocabulary, tokens = {}, 0, 0
    for r in sums:
        offsets[r.shard] = vocabulary
        vocabulary, tokens = vocabulary + r.n, tokens + r.total
    width = max(1, -(-max(1, (vocabulary * vocabulary).bit_length()) // 8))

    import xxhash

    end_hash = np.uint64(xxhash.xxh64_intdigest(END))

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block with its words' counts and numbers in place of the words."""
        for (_,), members in grouped(batches, ["block"]):
            body, answers = None, []
            for row in members:
                if row["shard"] < 0:
                    body = row
                else:
                    answers.append(row)
            counts = np.concatenate([_unpack(a["first"], "<u8") for a in answers])
            ids = np.concatenate([np.where((r := _unpack(a["second"], "<i4").astype(np.int64)) >= 0, r + offsets[a["shard"]], -1) for a in answers])
            hashes = np.frombuffer(body["words"], "<u8")
            end = int(np.searchsorted(hashes, end_hash))
            out = [body["block"], end, body["docs"], body["tokens"], _pack(counts), _pack(ids.astype("<i8"))]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(out, [pa.int64(), pa.int64(), *[pa.binary()] * 4])], ["block", "end", "docs", "tokens", "counts", "ids"])

    empty = [F.lit(None).cast("binary").alias(c) for c in ("docs", "tokens", "words")]
    bodies = blocks.select("block", F.lit(-1).cast("bigint").alias("shard"), F.lit(None).cast("binary").alias("first"), F.lit(None).cast("binary").alias("second"), "docs", "tokens", "words")
    answers = counted.where("block >= 0").select("block", "shard", "first", "second", *empty)
    both = _by(bodies.unionByName(answers), "block", "shard")
    resolved = stage(both.mapInArrow(resolve, "block bigint, end bigint, docs binary, tokens binary, counts binary, ids binary"), "lm-resolved", compression="none")
    unstage(blocks)
    unstage(counted)

    def pair_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                stream, ids = _unpack(row["tokens"], "<i4"), _unpack(row["ids"], "<i8")
                keys, known = _pairs(stream, ids, row["end"], vocabulary)
                learned = np.repeat(_unpack(row["docs"], "<i8").reshape(-1, 4)[:, 2] == 0, _unpack(row["docs"], "<i8").reshape(-1, 4)[:, 3])
                every, places = np.unique(keys[known], return_inverse=True)
                if not len(every):
                    continue
                counts = np.bincount(places, learned[known], len(every))
                shard = _shard_of_pair(every, vocabulary, pair_shards)
                order = np.argsort(shard, kind="stable")
                yield _key_rows(row["block"], shard[order], every[order], counts[order], width)

    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A shard's trie, and from it the codes of each block's pairs."""
        for (shard,), members in grouped(batches, ["shard"]):
            blocks_, keys, every, total = _merged(members, width)
            some = total > 0
            trie = NgramTrie.build(every[some] // np.uint64(vocabulary), every[some] % np.uint64(vocabulary), total[some])
            data = trie.to_bytes()
            yield _answer([[-1, shard, int(some.sum()), int(total.sum()), data, None]])
            trie = NgramTrie.of_buffer(data)
            for block, own in zip(blocks_, keys):
                codes = trie.find(own // np.uint64(vocabulary), own % np.uint64(vocabulary))
                yield _answer([[block, shard, 0, 0, _pack(codes), None]])

    # As many pair shards as keep about SHARD_KEYS of the blocks' different pairs each, tokens being the bound.
    n_tokens = resolved.agg(F.sum(F.length("tokens"))).first()[0] or 0
    pair_shards = max(1, -(-n_tokens // (2 * SHARD_KEYS)))
    paired = resolved.select("block", "end", "docs", "tokens", "ids").mapInArrow(pair_keys, KEYS)
    coded = stage(_by(paired, "shard", "block").mapInArrow(bigrams, ANSWERS), "lm-pairs", compression="none")

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_,), members in grouped(batches, ["block"]):
            body, codes = None, {}
            for row in members:
                if row["shard"] < 0:
                    body = row
                else:
                    codes[row["shard"]] = row["first"]
            yield _scored(body, codes, tokens, vocabulary, pair_shards, prior)

    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("end", "bigint"), ("docs", "binary"), ("tokens", "binary"), ("counts", "binary"), ("ids", "binary"))]
    bodies = resolved.select("block", F.lit(-1).cast("bigint").alias("shard"), F.lit(None).cast("binary").alias("first"), "end", "docs", "tokens", "counts", "ids")
    answers = coded.where("block >= 0").select("block", "shard", "first", *nothing)
    out = _by(bodies.unionByName(answers), "block", "shard").mapInArrow(final, SCORES)
    out.model = Model(tokens, vocabulary, offsets, pair_shards, coded.where("block = -1").select("shard", "n", F.col("first").alias("trie")))
    return out


def _by(df: DataFrame, key: str, then: str) -> DataFrame:
    return df.repartition(key).sortWithinPartitions(key, then)


def _shard_of_pair(keys: np.ndarray, vocabulary: int, shards: int) -> np.ndarray:
    """By context, spread over FAN_OUT shards by the word that follows."""
    keys = keys.astype(np.uint64)
    context, word = keys // np.uint64(vocabulary), keys % np.uint64(vocabulary)
    return (((_mixed(context) >> np.uint64(20)) + (_mixed(word) >> np.uint64(20)) % np.uint64(FAN_OUT)) % np.uint64(shards)).astype(np.int64)


SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _scored(body: dict, codes: dict[int, bytes], tokens: int, vocabulary: int, shards: int, prior: float) -> pa.RecordBatch:
    docs = _unpack(body["docs"], "<i8").reshape(-1, 4)
    stream, ids = _unpack(body["tokens"], "<i4"), _unpack(body["ids"], "<i8")
    counts = _unpack(body["counts"], "<u8").astype(np.float64)
    keys, known = _pairs(stream, ids, body["end"], vocabulary)
    pair = np.zeros(len(stream))
    every, places = np.unique(keys[known], return_inverse=True)
    if len(every):
        shard = _shard_of_pair(every, vocabulary, shards)
        order = np.argsort(shard, kind="stable")
        own = np.empty(len(every), np.uint8)
        own[order] = np.concatenate([_unpack(codes[s], np.uint8) for s in np.unique(shard).tolist()])
        pair[known] = np.where(own > 0, counts_of(np.maximum(own, 1) - 1), 0.0)[places]
    unigram = (counts + 1) / (tokens + vocabulary + 1)
    context = counts[np.r_[body["end"], stream[:-1]]]
    probability = (pair + prior * unigram[stream]) / (context + prior)
    starts = np.cumsum(docs[:, 3]) - docs[:, 3]
    columns = [
        pa.array([None if gone else d for d, gone in docs[:, :2].tolist()], pa.int64()), pa.array(docs[:, 2].astype(bool)), pa.array(docs[:, 3]),
        pa.array(np.add.reduceat((counts[stream] > 0).astype(np.int64), starts)), pa.array(np.full(len(docs), tokens, np.int64)),
        pa.array(np.add.reduceat(np.log10(unigram)[stream], starts)), pa.array(np.add.reduceat(np.log10(probability), starts)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
