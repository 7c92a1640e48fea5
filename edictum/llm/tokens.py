"""Documents to token ids in binary shards, and back."""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edictum.llm.common import byte_letters, table
from edictum.llm.wavelet import Shard, WaveletMatrix

END_ID = 2
SHARD_TOKENS = 1 << 20
KNOWN_CHUNKS = 600_000  # a worker remembers the ids of up to twice as many chunks of text

SHARDS = "part int, seq int, n_docs bigint, n_tokens bigint, data binary"
_SHARDS = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("data", pa.binary())])
TOKENS = "part int, seq int, doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint"
_TOKENS = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def parted_by_blanks(spec: dict) -> bool:
    """Whether a tokenizer file drops white space and joins nothing across it.

    That is so where white space is made one blank, letters small, and what a pattern without white space
    finds is all that is kept, as words with an end mark.
    """
    normalizer, split, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    split = (split.get("pretokenizers") or [split])[0]
    pattern = split.get("pattern", {}).get("Regex", " ").replace(r"[^\s\p{L}\p{N}]", "")
    return (
        [n["type"] for n in normalizer.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        and (split.get("type"), split.get("behavior"), split.get("invert")) == ("Split", "Removed", True)
        and not re.search(r"\s|\\s", pattern)
        and (model.get("type"), model.get("end_of_word_suffix")) == ("BPE", "</w>")
    )


class Encoder:
    """Ids of whole texts by the tokenizers library, for any of its files.

    For a file that :func:`parted_by_blanks` a text's ids are those of the chunks between white space,
    in order. The chunks' ids come from the library and are remembered, the latest in ``known`` and
    those before in ``older``; all new chunks of some texts are looked up together. ``str.split`` also
    parts at four control characters that the library does not count as white space: a text that
    has one is encoded whole, as are all texts for other files.
    """

    _controls = re.compile("[\x1c-\x1f]")
    #: Letters that are composed already and have one small form each.
    _latin = re.compile("[A-Za-z\xc0-\u012f\u0131-\u017e]+")
    _letters = {b: letter for letter, b in byte_letters().items()}
    _marks = '.,!?;:|%&*$#"()[]{}+-=/_~^@'

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.older = Tokenizer.from_file(path), {}, {}
        with open(path, encoding="utf-8") as f:
            self.parted = parted_by_blanks(json.load(f))
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.marks: dict[str, bytes] = {}

    def _single(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, many to a call: each ends with a token that ends a word.

        Where lower-casing makes something else of a letter the number of ends differs; the words
        of that call are then encoded one by one.
        """
        out, step = [], 64
        groups = [words[i : i + step] for i in range(0, len(words), step)]
        found = self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, found):
            ids = np.array(encoding.ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(group) or cuts[-1] != len(ids):
                out += map(self._single, group)
                continue
            raw, at = ids.tobytes(), 0
            for cut in (4 * cuts).tolist():
                out.append(raw[at:cut])
                at = cut
        return out

    def _learn(self, chunks: set[str]) -> None:
        """Chunks not known yet: letters with marks after them by way of the letters, others as they are.

        The model itself takes words of Latin letters, made small, in its own letters for their bytes.
        """
        known, older, tokenize = self.known, self.older, self.tokenizer.model.tokenize
        others: dict[str, list[tuple[str, str]]] = {}
        for chunk in chunks:
            ids = older.get(chunk)
            if ids is None:
                word = chunk.rstrip(self._marks)
                if not word.isalpha() or not (word.isascii() or word.lower().isalpha()):
                    ids = self._single(chunk)
                else:
                    tail = chunk[len(word) :]
                    if not word.isascii() and not self._latin.fullmatch(word):
                        others.setdefault(word, []).append((chunk, tail))
                        continue
                    word = word.lower()
                    ids = known.get(word) or older.get(word)
                    if ids is None:
                        own = word if word.isascii() else word.encode().decode("latin-1").translate(self._letters)
                        known[word] = ids = array("I", [t.id for t in tokenize(own)]).tobytes()
                    if tail:
                        ids += self._mark(tail)
            known[chunk] = ids
        for uses, ids in zip(others.values(), self._words(list(others))):
            for chunk, tail in uses:
                known[chunk] = ids + self._mark(tail)

    def _mark(self, tail: str) -> bytes:
        if tail not in self.marks:
            if len(self.marks) > 10_000:
                self.marks.clear()
            self.marks[tail] = self._single(tail) if tail else b""
        return self.marks[tail]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not self.parted or self._controls.search(text):
            return self._single(text)
        chunks = text.split()
        try:
            return b"".join(map(self.known.__getitem__, chunks))
        except KeyError:
            missing = {c for c in chunks if c not in self.known}
            if len(self.known) + len(missing) > KNOWN_CHUNKS:
                self.older, self.known, missing = self.known, {}, set(chunks)
            self._learn(missing)
            return b"".join(map(self.known.__getitem__, chunks))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_shards(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Shards of documents in ascending doc_id order, as rows (part, seq, n_docs, n_tokens, data).

    Texts are dealt out by ranges of doc_id and sorted within; a task encodes its texts one after
    the other and closes a shard at the first document that fills it, so memory is bounded by a
    shard and the longest text. NULL ids come first; equal ids are ordered by a hash of the text;
    a NULL or empty text is the end id alone. Further columns are ignored.
    """
    path, end = tokenizer or default_tokenizer(), np.array([end_id], "<u4").tobytes()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seq = encoder(path).encode, TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            tokens = np.frombuffer(b"".join(texts), "<u4")
            lengths = np.array([len(t) // 4 for t in texts], np.int64)
            data = Shard(ids, lengths, WaveletMatrix.build(tokens)).to_bytes()
            return table({"part": [part], "seq": [seq], "n_docs": [len(ids)], "n_tokens": [len(tokens)], "data": [data]}, _SHARDS)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                texts.append(encode(text.as_py() or "") + end)
                ids.append(doc_id)
                held += len(texts[-1]) // 4
                if held >= shard_tokens:
                    yield close()
                    ids, texts, held, seq = [], [], 0, seq + 1
        if ids:
            yield close()

    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(shards, SHARDS)


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write the shards; each row's ``data`` is one self-contained compressed file.

    Spark's committer puts them in place, so a task that is run again leaves nothing behind, and any
    file system Spark can write to will do.
    """
    encode_shards(docs, **options).write.option("compression", "none").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARDS).parquet(path)


def decode_shards(shards: DataFrame) -> DataFrame:
    """(part, seq, doc_id, first, n_tokens, ids_crc32) of each document, from the decoded ids."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, seq, data = (batch.column(c)[i].as_py() for c in ("part", "seq", "data"))
                shard = Shard.from_bytes(data)
                raw, lengths = memoryview(shard.matrix.decode().astype("<u4").tobytes()), shard.lengths
                ends = np.cumsum(lengths)
                starts = ends - lengths
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(sums)
                yield table({"part": [part] * n, "seq": [seq] * n, "doc_id": shard.doc_ids, "first": starts, "n_tokens": lengths, "ids_crc32": sums}, _TOKENS)

    return shards.select("part", "seq", "data").mapInArrow(decode, TOKENS)


def token_report(shards: DataFrame) -> DataFrame:
    """Per document, read back from shards: doc_id, start (ids before it), n_tokens, ids_crc32.

    Starts add up tokens of parts, of shards within a part, and of documents within a shard.
    """
    earlier = (Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*earlier)), F.lit(0)).alias("before_part"))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(*earlier)), F.lit(0))
    places = shards.select("part", F.col("seq").alias("s"), inside.alias("before_seq")).join(parts, F.col("part") == F.col("p"))
    places = places.select("p", "s", (F.col("before_part") + F.col("before_seq")).alias("before"))
    docs = decode_shards(shards).join(places, (F.col("part") == F.col("p")) & (F.col("seq") == F.col("s")))
    return docs.select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
