import re

from edictum.llm import license_rules
from edictum.llm.common import prepare
from edictum.llm.licenses import BASE, Scanner, scan_licenses

SCHEMA = "doc_id bigint, text string, labels string, spans string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def test_each_rule_has_its_keyword_and_compiles():
    rules = license_rules.rules()
    assert len(rules) > 200
    for label, priority, key, pattern in rules:
        re.compile(pattern)
        assert priority in (1, 2, 3) and key and label
    assert [r[1] for r in rules] == sorted((r[1] for r in rules), reverse=True)


def labels(text):
    words = WORD.findall(lower(text))
    return [f.label for f in Scanner().scan(" ".join(["", *words, ""]).encode())]


def test_longer_and_higher_detections_cover_others():
    assert labels("Licensed under the Apache License, Version 2.0.") == ["apache-2"]
    assert labels("Licensed under CC BY-NC 4.0.") == ["cc-by-nc-4.0"]
    assert labels("Licensed under CC BY-NC-SA 3.0") == ["cc-by-nc-sa-3.0"]
    assert labels("This work is licensed under the GNU General Public License, version 3.") == ["gpl-3.0"]
    assert labels("GNU Lesser General Public License, version 2.1 or any later version") == ["lgpl-2.1-or-later"]
    assert labels("SPDX-License-Identifier: GPL-2.0-only") == ["gpl-2.0-only"]
    assert labels("Released under the MIT License; also the ISC license") == ["mit", "isc"]
    assert labels("the omit licenses of a committee") == []


def test_keyword_filter_loses_nothing():
    """Scanning with keywords finds what scanning without finds."""
    plain = Scanner([(label, p, " ", pattern) for label, p, _, pattern in license_rules.rules()])
    samples = [
        "under the terms of the mit license", "new bsd license", "bsd 3 clause", "eupl 1 2", "the unlicense", "cc0 1 0 universal",
        "creative commons attribution sharealike 4 0 international license", "creativecommons org licenses by nc nd 2 5", "cc by sa",
        "gnu affero general public license v3", "agplv3", "lgpl 2 1", "mozilla public license 2 0", "boost software license version 1 0",
        "sil open font license version 1 1", "all rights reserved", "copyright c 2020", "public domain", "apache license", "wtfpl",
        "gnu general public license as published by the free software foundation either version 2 of the license or",
    ]
    for sample in samples:
        line = f" a {sample} b ".encode()
        assert Scanner().scan(line) == plain.scan(line) != [], sample


def brute(text):
    words = WORD.findall(lower(text or ""))
    places = [
        (i, label) for phrase, label in BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.decode().split()
    ]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_against_brute_force(spark):
    prepare(spark)
    texts = [
        None, "", "...", "Under the MIT license", "UNDER THE MIT LICENSE under the mit license", "cc by nc cc by nc", "cc-by-nc/by-nc cc by-NC",
        "under the mit-licensed", "éunder the mit license", "Apache License, Version 2.0; under the_mit license",
        "x " * 30000 + "cc by nc", "\x85cc by nc\xa0", "cc by nc", "cc by nc\x00under the mit license",
    ]
    df = spark.createDataFrame([(i if i else None, t, "x", "y") for i, t in enumerate(texts + texts[3:5])], SCHEMA)
    got = scan_licenses(df)
    assert got.columns[:8] == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows = got.collect()
    assert len(rows) == len(texts) + 2
    for row in rows:
        text = (texts + texts[3:5])[row.doc_id or 0]
        assert tuple(row[1:6]) == brute(text), text[:50] if text else text
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
        assert 0 <= row.score <= 1 and (row.score > 0) == bool(row.labels)
    assert scan_licenses(df.limit(0)).collect() == []


def spelled(parsed):
    """Texts of a pattern: every branch, every optional part left out and put in."""
    out = [""]
    for op, value in parsed:
        if op is re._constants.LITERAL:
            more = [chr(value)]
        elif op is re._constants.IN:
            more = [chr(c if kind is re._constants.LITERAL else c[0]) for kind, c in value if kind in (re._constants.LITERAL, re._constants.RANGE)] or ["x"]
        elif op is re._constants.BRANCH:
            more = [t for branch in value[1] for t in spelled(branch)]
        elif op is re._constants.SUBPATTERN:
            more = spelled(value[-1])
        elif op in (re._constants.MAX_REPEAT, re._constants.MIN_REPEAT):
            more = [t * n for n in {value[0], value[0] + 1} for t in spelled(value[2])]
        else:
            raise AssertionError(op)
        out = [a + b for a in out for b in more]
    return out


def test_every_spelling_of_a_pattern_has_its_keyword():
    lost = [(key, text) for _, _, key, pattern in license_rules.rules() for text in spelled(re._parser.parse(pattern)) if key not in text]
    assert lost == []
    assert labels("Under the Beerware License.") == ["beerware"] and labels("the same terms as Perl 5 itself") == ["perl"]
