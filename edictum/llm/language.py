"""Language identification by cross-parsing against suffix automata."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edictum.llm.common import bounded_sample, stage, table, unstage

# Bounds of what is learned from, per language: documents, letters of each; and letters of all languages.
SAMPLE_DOCS = 80
PIECE = 250
ALL_LETTERS = 400_000
OWN_CODES = 180  # letters with a code of their own; others share 64 codes
SHARED_CODES = 64
SEGMENT = 2_048  # a phrase does not reach over the end of a segment
GROUP = 4 << 20  # letters parsed at once

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Whether a code point of the basic plane is a letter."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(1 << 16)]))
    return _letters[0]


def points_of(text: str) -> np.ndarray:
    """Lower-cased letters as code points; each run of anything else as one 0."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    is_letter = letter_table()[np.minimum(points, 0xFFFF)]
    for i in np.flatnonzero(points > 0xFFFF):
        is_letter[i] = chr(points[i]).isalpha()
    points = np.where(is_letter, points, 0)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    return points[keep]


class SuffixAutomaton:
    """The automaton of all substrings of a sequence."""

    def __init__(self, sequence: list[int]):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for symbol in sequence:
            new = len(self.next)
            self.next.append({})
            link.append(0)
            length.append(length[last] + 1)
            at = last
            while at >= 0 and symbol not in self.next[at]:
                self.next[at][symbol] = new
                at = link[at]
            if at >= 0:
                target = self.next[at][symbol]
                if length[target] == length[at] + 1:
                    link[new] = target
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[target]))
                    link.append(link[target])
                    length.append(length[at] + 1)
                    while at >= 0 and self.next[at].get(symbol) == target:
                        self.next[at][symbol] = copy
                        at = link[at]
                    link[target] = link[new] = copy
            last = new


MISS = np.uint32(1 << 31)
PLACE = np.uint32((1 << 31) - 1)


class Parser:
    """Cross-parses texts against the samples of all languages at once.

    A phrase is the longest string from where the last one ended that the sample has, or one letter
    that it has not. All automata lie in one table: entry (state, code) is the place of the next
    state's row, with a mark where a new phrase begins.
    """

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        points = {lang: points_of(samples[lang]) for lang in self.languages}
        common = Counter()
        for p in points.values():
            common.update(p[p > 0].tolist())
        own = sorted(c for c, _ in sorted(common.items(), key=lambda x: (-x[1], x[0]))[:OWN_CODES])
        self.own = np.array(own, np.int64)
        self.width = 1 + len(own) + SHARED_CODES
        rows, starts, self.log_size = [], [], []
        base = 0
        for lang in self.languages:
            codes = self.codes(points[lang])
            automaton = SuffixAutomaton(codes.tolist()).next
            n = len(automaton) + 1  # the last row: nothing read yet, every letter begins a phrase
            start = np.full(self.width, base + n - 1, np.uint32)
            for symbol, state in automaton[0].items():
                start[symbol] = base + state
            block = np.tile((start * np.uint32(self.width)) | MISS, (n, 1))
            where = [(s, c, t) for s, moves in enumerate(automaton) for c, t in moves.items()]
            if where:
                s, c, t = np.array(where, np.int64).T
                block[s, c] = ((t + base) * self.width).astype(np.uint32)
            rows.append(block)
            starts.append((base + n - 1) * self.width)
            self.log_size.append(float(np.log2(max(2, len(codes)))))
            base += n
        self.table = np.concatenate(rows).ravel() if rows else np.zeros(0, np.uint32)
        self.start = np.array(starts, np.uint32)

    def codes(self, points: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.own, points) if len(self.own) else np.zeros(len(points), np.int64)
        hit = self.own[np.minimum(place, len(self.own) - 1)] == points if len(self.own) else np.zeros(len(points), bool)
        other = 1 + len(self.own) + points % SHARED_CODES
        return np.where(points == 0, 0, np.where(hit, place + 1, other)).astype(np.uint8)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (codes) in each language: an array (texts, languages)."""
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        owner, pieces = [], []
        for i, codes in enumerate(texts):
            for a in range(0, len(codes), SEGMENT):
                owner.append(i)
                pieces.append(codes[a : a + SEGMENT])
        order = sorted(range(len(pieces)), key=lambda k: -len(pieces[k]))
        if not order:
            return total
        lengths = np.array([len(pieces[k]) for k in order])
        grid = np.zeros((lengths[0], len(order)), np.uint32)
        for column, k in enumerate(order):
            grid[: len(pieces[k]), column] = pieces[k]
        state = np.repeat(self.start[:, None], len(order), axis=1)
        count = np.zeros((len(self.languages), len(order)), np.uint32)
        open_ = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # pieces longer than t
        for t in range(lengths[0]):
            m = open_[t]
            moved = self.table.take(state[:, :m] + grid[t, :m])
            count[:, :m] += moved >> np.uint32(31)
            state[:, :m] = moved & PLACE
        np.add.at(total, np.array(owner)[order], count.T)
        return total

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text; the language that needs fewest phrases, weighed by log of its sample.

        Score: how far the next language is behind, 0 for a tie; 1 where there is no other.
        """
        points = [points_of(t or "") for t in texts]
        codes = [self.codes(p) for p in points]
        out: list[tuple[str, float]] = []
        counts = np.zeros((len(texts), len(self.languages)), np.int64)
        group, held = [], 0
        for i, c in enumerate(codes):
            group.append(i)
            held += len(c)
            if held >= GROUP or i == len(codes) - 1:
                counts[group] = self.phrases([codes[k] for k in group])
                group, held = [], 0
        for i, p in enumerate(points):
            if not self.languages or not (p > 0).any():
                out.append(("und", 0.0))
                continue
            cost = sorted((float(n) * w, lang) for n, w, lang in zip(counts[i], self.log_size, self.languages))
            out.append((cost[0][1], 1.0 if len(cost) == 1 else 1.0 - cost[0][0] / cost[1][0]))
        return out


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, piece: int = PIECE) -> dict[str, str]:
    """Per language, text of a bounded sample of its documents, from rows of (doc_id, text, lang).

    About ``sample_docs`` documents of each language by hashed id, ``piece`` letters of each from a
    place that the id decides; less where there are many languages. Rows without id, text or
    language are not learned from.
    """
    rows = docs.where("text IS NOT NULL AND doc_id IS NOT NULL AND lang IS NOT NULL AND length(text) > 0")
    ids = stage(bounded_sample(rows.select("doc_id", "lang"), "lang", "doc_id", sample_docs).distinct(), "lang-ids")
    # Only ids were moved; the texts are picked by them, a few for each language.
    chosen = rows.select("doc_id", "lang", "text").join(ids, ["doc_id", "lang"])
    spot = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.greatest(F.length("text") - F.lit(2 * piece), F.lit(1)))
    part = F.substring(F.col("text"), (spot + 1).cast("int"), F.lit(2 * piece))
    found = chosen.select("lang", "doc_id", part.alias("part")).orderBy("lang", "doc_id", "part").collect()
    unstage(ids)
    samples: dict[str, list[str]] = {}
    for r in found:
        samples.setdefault(r.lang, []).append("".join(chr(c) if c else " " for c in points_of(r.part)[:piece]))
    bound = min(sample_docs * piece, ALL_LETTERS // max(1, len(samples)))
    return {lang: " ".join(parts)[:bound] for lang, parts in samples.items()}


_parsers: dict[int, Parser] = {}
_PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predict_languages(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) from rows of (doc_id, held_out, text), in one narrow pass.

    ``und`` and 0 for a text that is NULL or has no letter, or where nothing was learned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(tuple(sorted(samples.items())))
        if key not in _parsers:
            _parsers.clear()
            _parsers[key] = Parser(samples)
        for batch in batches:
            found = _parsers[key].predict(batch.column(2).to_pylist())
            yield table({"doc_id": batch.column(0), "held_out": batch.column(1), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}, _PREDICTED)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "held_out", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")
