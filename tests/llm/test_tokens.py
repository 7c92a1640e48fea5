import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from edictum.llm import tokens
from edictum.llm.common import prepare
from edictum.llm.wavelet import Shard, WaveletMatrix

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, part string, data string"


@given(st.lists(st.integers(0, 70), max_size=300))
@settings(max_examples=60, deadline=None)
def test_matrix_agrees_with_the_plain_sequence(ids):
    m = WaveletMatrix.build(np.array(ids, np.uint32))
    assert m.decode().tolist() == ids
    assert [m.access(i) for i in range(len(ids))] == ids
    for symbol in {*ids[:5], 71}:
        places = [i for i, x in enumerate(ids) if x == symbol]
        assert m.count(symbol) == len(places)
        assert m.locate(symbol) == places
        assert m.rank(symbol, len(ids) // 2) == sum(p < len(ids) // 2 for p in places)


def test_matrix_of_wide_ids_and_long_planes():
    ids = np.random.default_rng(1).integers(0, 3_000_000, 5000).astype(np.uint32)
    m = WaveletMatrix.build(ids)
    assert (m.decode() == ids).all()
    assert m.access(4321) == ids[4321]
    with pytest.raises(IndexError):
        m.access(5000)


def test_file_round_trip():
    ids = np.array([5, 2, 9, 9, 2], np.uint32)
    shard = Shard.from_bytes(Shard([None, 7], np.array([2, 3]), WaveletMatrix.build(ids)).to_bytes())
    assert shard.doc_ids == [None, 7]
    assert shard.lengths.tolist() == [2, 3]
    assert shard.matrix.decode().tolist() == ids.tolist()
    with pytest.raises(ValueError):
        Shard.from_bytes(b"something else")


def test_chunks_give_the_ids_of_whole_texts():
    enc, rng = tokens.Encoder(tokens.default_tokenizer()), random.Random(3)
    pieces = ["don't", "ÉTÉ", "é", "́x", " ", "\t", "\n", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "​", "<|endoftext|>", "<|ENDOFTEXT|>", "12", "½", "日本", "😀", "ß", "İ", "Σ", "ΑΣ", "Word,", "été!!", "..!", "'s", "' s", "﻿", "\x00"]
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        whole = enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == whole, repr(text)


def test_memory_of_chunks_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_CHUNKS", 3)
    enc = tokens.Encoder(tokens.default_tokenizer())
    for text in ("a b c", "d e f", "a b c d e f g"):
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def rows():
    long_text = " ".join(f"word{i}" for i in range(4000))
    texts = ["One two.", None, "", long_text, "One two.", "é " * 50, "x"]
    ids = [5, 3, 9, -4, 5, None, 1 << 40]
    return [(d, t, None, None, None, "p", "q") for d, t in zip(ids, texts)]


@pytest.mark.parametrize("shard_tokens", [1, 60, 1 << 20])
def test_shards_against_one_by_one(spark, shard_tokens):
    from tokenizers import Tokenizer

    prepare(spark)
    found = tokens.token_report(tokens.encode_shards(spark.createDataFrame(rows(), SCHEMA), shard_tokens=shard_tokens)).collect()
    tok, start, expected = Tokenizer.from_file(tokens.default_tokenizer()), 0, []
    for d, t, *_ in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected


def test_no_documents(spark):
    prepare(spark)
    assert tokens.token_report(tokens.encode_shards(spark.createDataFrame([], SCHEMA))).collect() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_any_tokenizer_file(name):
    import public_tokenizers

    path, rng = public_tokenizers.path(name), random.Random(8)
    enc = tokens.Encoder(path)
    assert enc.parted == (name == "word_bpe_49k.json")
    letters = [chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xAA, 0x250), 0x1E9E, 0x3A3, 0x3C2, 0x130, 0xDF] if chr(c).isalpha()]
    texts = ["", "a  b", "\x1cx y", "<|endoftext|>x", "A\u0301 \ufb01", "\u0130, \u01c5!"]
    texts += [" ".join("".join(rng.choices(letters, k=rng.randint(1, 8))) + rng.choice(["", ",", "!?", ".", "'s"]) for _ in range(9)) for _ in range(400)]
    for text in texts:
        whole = enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == whole, text
