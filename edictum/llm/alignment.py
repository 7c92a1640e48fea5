"""Two tokenizers over the same texts: which tokens cover which, and where both end."""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edictum.llm.common import byte_letters, stage

KNOWN_CHUNKS = 400_000  # a worker remembers the ids of up to twice as many stretches of text
PART = 1 << 19  # characters of a text that are aligned at a time
SLICE = 1 << 20  # tokens of both sides that are aligned at a time
MOST_BROADCAST = 100_000  # pairs of ids

#: A blank between two characters that are white space to no tokenizer.
BOUNDARY = re.compile("(?<=[!-~\xa1-ɏ]) (?=[!-~\xa1-ɏ])")
PLAIN = re.compile("[!-~\xa1-ɏ](?:.*[!-~\xa1-ɏ])?", re.DOTALL)


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Encoders:
    """Ids of both tokenizers for whole texts: blank and text by A, text by B, which adds the blank.

    A byte-level vocabulary with the usual splitting never joins what a single blank parts, and a piece
    vocabulary whose pieces hold the mark for a blank in front alone doesn't either. Where both is so
    (it is checked), ids are those of the stretches between such blanks, which are remembered.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        nothing = lambda i: self.b.is_control(i) or self.b.is_unknown(i)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if nothing(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_lengths, self.b_lengths = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        inner = any("▁" in p.lstrip("▁") for p in pieces)
        self.parted = spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not inner
        self.known: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}
        self.older: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}

    def encoded(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of each text by both, as 32-bit integers; None where the bytes are not the text's."""
        out: list[tuple[bytes, bytes] | None] = []
        both = zip(texts, self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False), self.b.encode(texts, num_threads=1))
        for text, a, b in both:
            whole = b" " + text.encode()
            a_ids = a.ids
            same = b"".join([self.b_bytes[i] for i in b]) == whole and b"".join([self.a_bytes[i] for i in a_ids]) == whole
            out.append((array("I", a_ids).tobytes(), array("I", b).tobytes()) if same else None)
        return out

    def _together(self, chunks: list[str]) -> list[tuple[bytes, bytes] | None]:
        """As :meth:`encoded` for stretches between boundaries, many to a call.

        Ids are cut where the bytes of a stretch end. A call whose bytes differ is done one by one.
        """
        out: list[tuple[bytes, bytes] | None] = []
        groups = [chunks[i : i + 64] for i in range(0, len(chunks), 64)]
        joined = [" ".join(g) for g in groups]
        both = zip(groups, joined, self.a.encode_batch_fast([" " + t for t in joined], add_special_tokens=False), self.b.encode(joined, num_threads=1))
        for group, text, a, b in both:
            a_ids = a.ids
            whole = b" " + text.encode()
            ends = np.cumsum([1 + len(c.encode()) for c in group])
            cut = []
            for ids, table, lengths in ((a_ids, self.a_bytes, self.a_lengths), (b, self.b_bytes, self.b_lengths)):
                raw = array("I", ids)
                if b"".join([table[i] for i in ids]) != whole:
                    break
                found = np.cumsum(lengths[raw])
                at = np.searchsorted(found, ends)
                if not np.array_equal(found[at], ends):
                    break
                stops = (4 * (at + 1)).tolist()
                raw = raw.tobytes()
                cut.append([raw[i:j] for i, j in zip([0, *stops], stops)])
            out += zip(*cut) if len(cut) == 2 else self.encoded(group)
        return out

    def _learn(self, chunks: list[str]) -> bool:
        a, b = self.known
        good = True
        fresh = []
        for c in chunks:
            if c in self.older[0]:
                a[c], b[c] = self.older[0][c], self.older[1][c]
            else:
                fresh.append(c)
        for c, ids in zip(fresh, self._together(fresh)):
            if ids is None:
                good = False
            else:
                a[c], b[c] = ids
        return good

    def part(self, text: str) -> tuple[bytes, bytes] | None:
        """Ids of a stretch that begins and ends at a boundary, or at an end of its text."""
        if not self.parted:
            return self.encoded([text])[0]
        a, b = self.known
        chunks = text.split(" ")
        try:
            return b"".join(map(a.__getitem__, chunks)), b"".join(map(b.__getitem__, chunks))
        except KeyError:
            missing = {c for c in chunks if c not in a}
        if all(map(PLAIN.fullmatch, missing)):
            if len(a) + len(missing) > KNOWN_CHUNKS:
                self.older, self.known = self.known, ({}, {})
                a, b = self.known
                missing = set(chunks)
            if not self._learn(list(missing)):
                return None
            return b"".join(map(a.__getitem__, chunks)), b"".join(map(b.__getitem__, chunks))
        # Blanks at an end, runs of them, other white space: what the boundaries leave whole is not remembered.
        chunks = BOUNDARY.split(text)
        missing = {c for c in chunks if c not in a}
        odd = [c for c in missing if " " in c or not PLAIN.fullmatch(c)]
        ids = dict(zip(odd, self.encoded(odd)))
        if None in ids.values() or not self._learn(list(missing - ids.keys())):
            return None
        return tuple(b"".join([ids[c][k] if c in ids else self.known[k][c] for c in chunks]) for k in (0, 1))

    def parts(self, text: str | None) -> Iterator[tuple[bytes, bytes]]:
        """Ids of a text, stretch by stretch; nothing for one without tokens."""
        if not text:
            return
        found, at = [], 0
        while self.parted and len(text) - at > PART and (cut := BOUNDARY.search(text, at + PART)):
            found.append(self.part(text[at : cut.start()]))
            at = cut.end()
        found.append(self.part(text[at:]))
        if None in found:
            found = self.encoded([text])
        if None not in found:
            yield from found


_encoders: dict[tuple[str, str], Encoders] = {}


def encoders(a_path: str, b_path: str) -> Encoders:
    if (a_path, b_path) not in _encoders:
        _encoders[a_path, b_path] = Encoders(a_path, b_path)
    return _encoders[a_path, b_path]


@dataclass
class Slice:
    """Documents of a batch, or parts of one, aligned. Tokens are numbered through the slice.

    ``over_a`` / ``over_b`` are the pairs of tokens that share bytes, ``ends`` says which of them end
    together; ``a_group`` / ``b_group`` number the groups these ends cut.
    """

    docs: list[int]
    a: np.ndarray
    b: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    over_a: np.ndarray
    over_b: np.ndarray
    ends: np.ndarray
    a_last: np.ndarray
    b_last: np.ndarray

    @property
    def a_group(self) -> np.ndarray:
        return np.cumsum(self.a_last) - self.a_last

    @property
    def b_group(self) -> np.ndarray:
        return np.cumsum(self.b_last) - self.b_last


def align_slice(coders: Encoders, docs: list[int], texts: list[tuple[bytes, bytes]]) -> Slice:
    """Each token start finds the covering token of the other side, by ``merge_asof`` within its document.

    Both sides have the same bytes, so offsets can run through the slice: they are in order, as
    ``merge_asof`` wants them. Two tokens share bytes exactly if one's start lies in the other, so both
    directions together give all overlaps; a pair that starts together is found by both and taken once.
    """
    sides = []
    for k, lengths in ((0, coders.a_lengths), (1, coders.b_lengths)):
        ids = np.frombuffer(b"".join([t[k] for t in texts]), np.uint32)
        doc = np.repeat(np.array(docs, np.int64), [len(t[k]) // 4 for t in texts])
        length = lengths[ids]
        end = np.cumsum(length)
        sides.append((ids, doc, end - length, end))
    (a, a_doc, a_start, a_end), (b, b_doc, b_start, b_end) = sides
    a_side = pd.DataFrame({"start": a_start, "doc": a_doc, "a": np.arange(len(a))}, copy=False)
    b_side = pd.DataFrame({"start": b_start, "doc": b_doc, "b": np.arange(len(b))}, copy=False)
    b_of_a = pd.merge_asof(a_side[["start", "doc"]], b_side, on="start", by="doc")["b"].to_numpy(np.int64)
    a_of_b = pd.merge_asof(b_side[["start", "doc"]], a_side, on="start", by="doc")["a"].to_numpy(np.int64)
    apart = np.flatnonzero(a_start[a_of_b] != b_start)
    over_a, over_b = np.concatenate((np.arange(len(a)), a_of_b[apart])), np.concatenate((b_of_a, apart))
    ends = a_end[over_a] == b_end[over_b]
    a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
    a_last[over_a[ends]] = True
    b_last[over_b[ends]] = True
    return Slice(docs, a, b, a_doc, b_doc, over_a, over_b, ends, a_last, b_last)


def slices(coders: Encoders, texts: list[str | None], most: int = SLICE) -> Iterator[Slice]:
    """The texts of a batch, numbered, as slices of about ``most`` tokens; a long text goes over several."""
    docs: list[int] = []
    held: list[tuple[bytes, bytes]] = []
    tokens = 0
    for doc, text in enumerate(texts):
        for ids in coders.parts(text):
            docs.append(doc)
            held.append(ids)
            tokens += (len(ids[0]) + len(ids[1])) // 4
            if tokens >= most:
                yield align_slice(coders, docs, held)
                docs, held, tokens = [], [], 0
    if docs:
        yield align_slice(coders, docs, held)


def _texts(column: pa.Array) -> list[str | None]:
    """UTF-8 as text; bytes that are none count as no text."""
    out = []
    for raw in column.to_pylist():
        try:
            out.append(None if raw is None else raw.decode())
        except UnicodeDecodeError:
            out.append(None)
    return out


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))


def _lists(values: list[np.ndarray], owners: np.ndarray, n: int, names: list[str]) -> pa.Array:
    """A list of structs per document from columns sorted by document."""
    offsets = np.searchsorted(owners, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(v, pa.int32()) for v in values], names))


ALIGNED = "doc_id bigint, a_ids array<int>, b_ids array<int>, a_group array<int>, b_group array<int>, overlaps array<struct<a:int,b:int,ends:boolean>>"


def align(docs: DataFrame, tokenizers: tuple[str, str] | None = None, slice_tokens: int = SLICE) -> DataFrame:
    """The alignment of each document: ids of both sides, the group of each token, and all overlaps.

    Tokens and groups are numbered from 0 within the document; an overlap names a token of each side and
    whether both end together. Documents whose text is NULL, empty, not UTF-8 or not given back by both
    tokenizers have empty lists. Rows may repeat, ids may be NULL; further columns are ignored.
    """
    a_path, b_path = tokenizers or default_tokenizers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = encoders(a_path, b_path)
        for batch in batches:
            n = batch.num_rows
            out = [{"doc_id": i, "a_ids": [], "b_ids": [], "a_group": [], "b_group": [], "overlaps": []} for i in batch.column(0).to_pylist()]
            for s in slices(coders, _texts(batch.column(1)), slice_tokens):
                a_at, b_at = np.searchsorted(s.a_doc, np.arange(n)), np.searchsorted(s.b_doc, np.arange(n))
                groups = {"a_group": s.a_group, "b_group": s.b_group}
                over_doc = s.a_doc[s.over_a]
                for doc in dict.fromkeys(s.docs):
                    row, of_a, of_b = out[doc], s.a_doc == doc, s.b_doc == doc
                    a_before, b_before, g_before = len(row["a_ids"]), len(row["b_ids"]), 1 + (row["a_group"][-1] if row["a_group"] else -1)
                    row["a_ids"] += s.a[of_a].tolist()
                    row["b_ids"] += s.b[of_b].tolist()
                    row["a_group"] += (groups["a_group"][of_a] - groups["a_group"][of_a][0] + g_before).tolist()
                    row["b_group"] += (groups["b_group"][of_b] - groups["b_group"][of_b][0] + g_before).tolist()
                    pairs = over_doc == doc
                    x, y, e = s.over_a[pairs] - a_at[doc] + a_before, s.over_b[pairs] - b_at[doc] + b_before, s.ends[pairs]
                    order = np.lexsort((y, x))
                    row["overlaps"] += [{"a": i, "b": j, "ends": k} for i, j, k in zip(x[order].tolist(), y[order].tolist(), e[order].tolist())]
            kinds = pa.schema([("doc_id", pa.int64()), *[(c, pa.list_(pa.int32())) for c in ("a_ids", "b_ids", "a_group", "b_group")],
                               ("overlaps", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("ends", pa.bool_())])))])
            yield pa.RecordBatch.from_pylist(out, kinds)

    return _rows(docs).mapInArrow(run, ALIGNED)


class _Digest:
    """Decimal ids with what follows them, for the digest of a document's groups."""

    def __init__(self, coders: Encoders):
        self.a, self.b = (
            np.array([f"{i}{mark}" for mark in (",", end) for i in range(len(table))], object)
            for table, end in ((coders.a_bytes, "|"), (coders.b_bytes, ";"))
        )

    def texts(self, s: Slice) -> Iterator[tuple[int, str]]:
        """(document, its groups in this slice as text, with a mark after the last too)."""
        a_group, b_group = s.a_group, s.b_group
        # Tokens of A stand before those of B of the same group.
        a_ends, b_ends = np.flatnonzero(s.a_last) + 1, np.flatnonzero(s.b_last) + 1
        b_starts = np.concatenate((np.zeros(1, np.int64), b_ends[:-1]))
        words = np.empty(len(s.a) + len(s.b), object)
        words[np.arange(len(s.a)) + b_starts[a_group]] = self.a[s.a + s.a_last * (len(self.a) // 2)]
        words[np.arange(len(s.b)) + a_ends[b_group]] = self.b[s.b + s.b_last * (len(self.b) // 2)]
        docs = np.array(list(dict.fromkeys(s.docs)), np.int64)
        cuts = (np.searchsorted(s.a_doc, docs, "right") + np.searchsorted(s.b_doc, docs, "right")).tolist()
        listed = words.tolist()
        for doc, first, last in zip(docs.tolist(), [0, *cuts], cuts):
            yield doc, "".join(listed[first:last])


LINKED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links array<struct<a:int,b:int,n:int>>"


def linked(docs: DataFrame, tokenizers: tuple[str, str] | None = None, slice_tokens: int = SLICE) -> DataFrame:
    """Per document what :func:`align` finds, in short: token, group and link counts, a digest of the
    groups (``a1,a2|b1;a3|b2``), and each pair of ids that ends together with how often it does."""
    a_path, b_path = tokenizers or default_tokenizers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = encoders(a_path, b_path)
        digest = _Digest(coders)
        for batch in batches:
            n = batch.num_rows
            counts = np.zeros((4, n), np.int64)
            hashes: dict[int, object] = {}
            waiting: dict[int, str] = {}
            keys, times = [], []
            for s in slices(coders, _texts(batch.column(1)), slice_tokens):
                pair_a, pair_b = s.over_a[s.ends], s.over_b[s.ends]
                pair_doc = s.a_doc[pair_a]
                for k, owner in enumerate((s.a_doc, s.b_doc, s.a_doc[s.a_last], pair_doc)):
                    counts[k] += np.bincount(owner, minlength=n)
                key, many = np.unique(pair_doc << 48 | s.a[pair_a].astype(np.int64) << 24 | s.b[pair_b], return_counts=True)
                keys.append(key)
                times.append(many)
                for doc, text in digest.texts(s):
                    if doc not in hashes:
                        hashes[doc] = hashlib.sha256()
                    # A part's last mark is written once another part follows.
                    hashes[doc].update((waiting.get(doc, "") + text[:-1]).encode())
                    waiting[doc] = text[-1]
            key, at = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_inverse=True)
            many = np.bincount(at, np.concatenate(times)).astype(np.int64) if keys else np.zeros(0, np.int64)
            links = _lists([key >> 24 & 0xFFFFFF, key & 0xFFFFFF, many], key >> 48, n, ["a", "b", "n"])
            shas = pa.array([hashes[d].hexdigest() if d in hashes else "" for d in range(n)], pa.string())
            columns = [batch.column(0), *[pa.array(c) for c in counts], shas, links]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    return _rows(docs).mapInArrow(run, LINKED)


def alignment_report(
    docs: DataFrame, tokenizers: tuple[str, str] | None = None, slice_tokens: int = SLICE, most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A pair's count is how many links hold it over all documents; ``n_best`` counts links whose pair has
    the highest count of its B id, ties included, ``count_sum`` adds up the counts of all links. Each
    document looks up its different pairs. A pair found in more than one of ``most_broadcast`` of all
    lookups is answered from a broadcast table, which therefore has fewer rows than that; the other
    pairs meet their counts in a join, where none of them is frequent.
    """
    found = stage(linked(docs, tokenizers, slice_tokens).withColumn("row", F.monotonically_increasing_id()), "linked")
    pair = (F.shiftleft(F.col("a").cast("bigint"), 32) + F.col("b")).alias("pair")
    asked = found.select("row", F.inline("links")).select("row", pair, "n")
    counts = stage(asked.groupBy("pair").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("asked")), "pairs")
    b_id = F.col("pair").bitwiseAND((1 << 32) - 1)
    top = counts.groupBy(b_id.alias("b_id")).agg(F.max("count").alias("top"))
    rated = counts.join(top, b_id == F.col("b_id")).select(F.col("pair").alias("r_pair"), "count", (F.col("count") == F.col("top")).alias("best"), "asked")
    rated = stage(rated, "rated")
    lookups = rated.agg(F.coalesce(F.sum("asked"), F.lit(0)).cast("decimal(38,0)")).scalar()
    often = F.broadcast(rated.where(F.col("asked").cast("decimal(38,0)") * F.lit(most_broadcast) > lookups))
    seldom = rated.where(F.col("asked").cast("decimal(38,0)") * F.lit(most_broadcast) <= lookups)
    rest = asked.join(often, F.col("pair") == F.col("r_pair"), "left_anti").join(seldom, F.col("pair") == F.col("r_pair"))
    answered = asked.join(often, F.col("pair") == F.col("r_pair")).unionByName(rest)
    best = F.sum(F.when(F.col("best"), F.col("n")).otherwise(F.lit(0)))
    sums = answered.groupBy(F.col("row").alias("s_row")).agg(best.alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    none = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return found.join(sums, F.col("row") == F.col("s_row"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", none("n_best"), none("count_sum"), "groups_sha256"
    )
