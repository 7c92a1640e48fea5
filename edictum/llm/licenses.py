"""Licence scans: ordered signature rules behind a keyword filter, overlaps resolved by containment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edictum.llm import license_rules
from edictum.llm.common import table, utf8, words_of

#: Phrases every scan counts, with their labels.
BASE = ((b"under the mit license", "mit"), (b"apache license version 2", "apache-2"), (b"cc by nc", "cc-by-nc"))
CONFIDENCE = {3: 1.0, 2: 0.8, 1: 0.5}


class Found(NamedTuple):
    start: int  # first word
    end: int  # after the last word
    label: str
    priority: int


class Scanner:
    def __init__(self, rules: list[tuple[str, int, str, str]] | None = None):
        by_key: dict[bytes, list] = {}
        for order, (label, priority, key, pattern) in enumerate(rules or license_rules.rules()):
            compiled = re.compile(rb" (?:" + pattern.encode() + rb")(?= )")
            by_key.setdefault(key.encode(), []).append((order, label, priority, compiled))
        self.by_key = list(by_key.items())

    def scan(self, line: bytes) -> list[Found]:
        """Detections in a text given as blank, words with single blanks, blank; kept ones, by place.

        A detection inside the interval of another is dropped if both name the same licence, or the
        other has a higher priority, or the same and is longer or its rule comes first. Partial
        overlaps stay.
        """
        found = []
        for key, rules in self.by_key:
            if key not in line:
                continue
            for order, label, priority, pattern in rules:
                start, seen = 0, 0
                for m in pattern.finditer(line):
                    start, seen = start + line.count(b" ", seen, m.start()), m.start()
                    found.append((Found(start, start + m.group().count(b" "), label, priority), order))
        # An interval that holds another comes before it, so one pass with the open ones will do.
        found.sort(key=lambda f: (f[0].start, -f[0].end, -f[0].priority, f[1]))
        kept, open_ = [], []
        for f, order in found:
            open_ = [o for o in open_ if o[0].end > f.start]
            if not any(self._covers(*o, f, order) for o in open_):
                kept.append(f)
            open_.append((f, order))
        return kept

    @staticmethod
    def _covers(outer: Found, outer_order: int, inner: Found, inner_order: int) -> bool:
        if outer.end < inner.end:
            return False
        longer = (outer.end - outer.start) - (inner.end - inner.start)
        return outer.label == inner.label or (outer.priority, longer, -outer_order) > (inner.priority, 0, -inner_order)


def base_places(line: bytes) -> list[tuple[int, str]]:
    """(first word, label) of every place where a base phrase's words stand one after the other."""
    places = []
    for phrase, label in BASE:
        needle = b" " + phrase + b" "
        at, seen, start = line.find(needle), 0, 0
        while at >= 0:
            start, seen = start + line.count(b" ", seen, at), at
            places.append((start, label))
            at = line.find(needle, at + 1)
    return places


SCANNED = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans array<struct<first:int,after:int,label:string,priority:int>>"
_SPAN = pa.struct([("first", pa.int32()), ("after", pa.int32()), ("label", pa.string()), ("priority", pa.int32())])
_SCANNED = pa.schema(
    [("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")]]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))]
)
_scanner: list[Scanner] = []


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if not _scanner:
        _scanner.append(Scanner())
    for batch in batches:
        out: dict[str, list] = {f.name: [] for f in _SCANNED}
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = words_of(text.as_py())
            line = b" ".join([b"", *words, b""])
            places, kept = base_places(line), _scanner[0].scan(line)
            base = {label for _, label in places}
            starts = [p for p, _ in places]
            values = {
                "doc_id": doc_id, "n_words": len(words), "n_base": len(places),
                "first_word": min(starts, default=None), "last_word": max(starts, default=None),
                "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | {f.label for f in kept})),
                "score": max([CONFIDENCE[f.priority] for f in kept] + [CONFIDENCE[2]] * bool(base), default=0.0),
                "spans": [{"first": f.start, "after": f.end, "label": f.label, "priority": f.priority} for f in kept],
            }
            for name, value in values.items():
                out[name].append(value)
        yield table(out, _SCANNED)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: the contract's figures, and ``spans`` of what was detected, in words.

    One narrow pass. A NULL text counts as empty: no words, no labels, score 0. Repeated rows give
    repeated results; further columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text")).mapInArrow(scan, SCANNED)
