import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe, packing, textgrams
from tidemark.llm.queries import vocabulary_file

ODD = [
    "Hello  WORLD it's we'll 123 aaaa aaaaaaa banana's", "<|endoftext|>x<|startoftext|>", "<|ENDOFTEXT|> <|endof", "ΣΑΣ ς İstanbul ǅ", "é à ́ x", "\x1ca\x1db\x85c d​e﻿　f\xa0g", "日本語 テスト 한국어",
    "😀👍🏽 !!??..", "½ ² Ⅷ ٣", "'s'T'RE don'T'd ''s .'s", "a\x00b", "ﬁ Å ſ ẞ", "the" * 3000, "ẛ̣ क़", "≠ ẹ́", "a.b,c-d_e|f", "", " ",
]


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(vocabulary_file())


@pytest.fixture(scope="module")
def model():
    with open(vocabulary_file(), encoding="utf-8") as f:
        return bpe.vocabulary(f.read())


def encoded(model, texts):
    ids, starts = model.encode(textgrams.texts_of(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]


def test_ids_and_decoding_equal_the_library(model, library):
    for text, ids in zip(ODD, encoded(model, ODD), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids == expected, text
        assert model.decode(ids).decode() == library.decode(expected, skip_special_tokens=False)


def test_every_character_equals_the_library(model, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 50_000):
        texts = [f"a{chr(c)}b" for c in points[at : at + 50_000]]
        expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [hex(ord(t[1])) for t, x, y in zip(texts, encoded(model, texts), expected, strict=True) if x != y] == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=20), max_size=5))
def test_any_text_equals_the_library(model, library, texts):
    assert encoded(model, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_mixed_scripts_and_marks_equal_the_library(model, library):
    rng = random.Random(5)
    blocks = [(0x20, 0x250), (0x300, 0x370), (0x370, 0x600), (0x600, 0x1000), (0x1000, 0x3100), (0xA640, 0xABFF), (0x10000, 0x1F000), (0x1F300, 0x1FB00), (0xE0000, 0xE01FF), (0xFB00, 0xFE30)]
    texts = ["".join(chr(rng.randrange(*rng.choice(blocks))) for _ in range(rng.randint(1, 12))) for _ in range(20_000)]
    texts += ["Y\u030a y\u030a", "A\u030aB", "x\u089b\u0301", "\u1df6\u036f"]
    assert encoded(model, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_keys_of_a_text_depend_on_no_other_text():
    texts = [*ODD, "Plain WORDS here, and more.", "a < b", "<", "|", "Y", "\u030a", "x=Z", "\u0338"]
    together = packing.curve_keys(textgrams.texts_of(pa.array(texts)))
    assert together.tolist() == [packing.curve_keys(textgrams.texts_of(pa.array([t])))[0] for t in texts]


def test_round_trip_of_documents(documents, odd_texts, library):
    texts = [*odd_texts, *ODD]
    rows = {r["doc_id"]: r for r in bpe.round_trip(documents(texts), vocabulary_file()).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.round_trip(documents([]), vocabulary_file()).count() == 0


def test_encode_then_decode_as_tables(documents, library):
    ids = bpe.encode(documents(ODD), vocabulary_file())
    back = {r["doc_id"]: r["text"] for r in bpe.decode(ids, vocabulary_file()).collect()}
    assert back == {i: library.decode(library.encode(t, add_special_tokens=False).ids, skip_special_tokens=False) for i, t in enumerate(ODD)}


def test_hilbert_keys_visit_neighbouring_cells():
    bits, n = 3, 3
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
    keys = packing.hilbert_keys(grid, bits)
    assert sorted(keys.tolist()) == list(range(1 << bits * n))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_fill_cuts_full_sequences_and_powers_of_two():
    rng = random.Random(4)
    for _ in range(200):
        given_ids = [(i, np.arange(rng.choice([0, 1, 5, 40]))) for i in range(rng.randint(0, 12))]
        sequences = list(packing.fill(iter(given_ids), 16))
        lengths = [sum(p[3] for p in s) for s in sequences]
        assert all(n == 16 or n & (n - 1) == 0 for n in lengths) and sum(lengths) == sum(len(x) for _, x in given_ids)
        covered = defaultdict(list)
        for s in sequences:
            for d, _, start, length in s:
                covered[d] += range(start, start + length)
        assert all(covered[d] == list(range(len(x))) for d, x in given_ids)


def test_packed_documents(documents, odd_texts, library):
    texts = [*odd_texts, *ODD]
    rows = packing.pack(documents(texts), vocabulary_file(), size=64).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids"] == ids[at : at + r["length"]].tolist() and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == 64 or at & (at - 1) == 0
    assert packing.pack(documents([]), vocabulary_file()).count() == 0


def test_like_documents_are_neighbours_on_the_curve():
    rng = random.Random(1)
    texts, kind = [], []
    for k in range(8):
        vocabulary = [f"k{k}w{i}" for i in range(20)]
        for _ in range(20):
            texts.append(" ".join(rng.choices(vocabulary, k=150)))
            kind.append(k)
    order = np.argsort(packing.curve_keys(textgrams.texts_of(pa.array(texts))), kind="stable")
    along = np.array(kind)[order]
    assert (along[1:] == along[:-1]).mean() > 0.6  # 0.12 by chance
