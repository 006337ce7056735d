"""Packing: every id in one piece, ids as the tokenizer gives them, little padding."""

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stockledger.llm import packing, queries

from llm_cases import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
TOKENS = packing.WordTokenizer(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def check(rows, docs, capacity=4096):
    """Pieces cover every document once, and sequences are gapless and not too long."""
    expected = sorted((r[0] is None, r[0] or 0, tuple(ids_of(r[1]))) for r in docs)
    lengths = {}
    for r in rows:
        lengths.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in lengths.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    sizes = {s: sum(n for _, n in own) for s, own in lengths.items()}
    known = {}
    for _, doc_id, ids in expected:
        known.setdefault(doc_id, []).append(ids)
    covered = {}
    for r in rows:
        assert any(len(ids) == r.doc_tokens and crc(ids[r.start : r.start + r.length]) == r.ids_crc32 for ids in known[r.doc_id or 0])
        covered.setdefault((r.doc_id or 0, r.doc_tokens), []).append((r.start, r.length))
    for (doc_id, tokens), own in covered.items():
        times = sum(len(ids) == tokens for ids in known[doc_id])
        hits = np.zeros(tokens, int)
        for start, length in own:
            hits[start : start + length] += 1
        assert (hits == times).all()
    assert sum(r.length for r in rows) == sum(len(ids) for *_, ids in expected)
    padding = sum(capacity - s for s in sizes.values() if s & (s - 1))
    return padding / max(sum(sizes.values()), 1)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op12_packing(spark, SMALL)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert check(got.collect(), docs) < 0.002


def test_edges(spark, edge_docs, no_docs):
    assert packing.pack(no_docs, PATH).collect() == []
    docs = edge_docs.select("doc_id", "text").collect()
    rows = packing.pack(edge_docs, PATH, capacity=64).collect()
    assert check(rows, docs, 64) < 0.1
    assert sorted((r.start, r.length, r.doc_tokens) for r in rows if r.doc_id == 3) == [(0, 1, 1)]
    assert sum(r.doc_id == 2 and r.start == 0 for r in rows) == 2


WORDS = ["Hello", "hello,", "ÀÉß", "naïve...", "it's", "x=1", "don't", "a.b", "(see)", "ª", "ÿ!?", "é́", "Σς", "ſ", "<|endoftext|>", "Z`|~", "$$", "A"]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(WORDS)).map(" ".join) | st.text(alphabet="aAé \t\n\x0b\x0c\x1c\x85\xa0́ İß's0<|endoftext>", max_size=60))
def test_ids_of_words_in_a_row_are_those_of_the_text(text):
    got = TOKENS.encode([text.encode()])[0]
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == ids_of(text)[:-1]


def test_slices_and_forgotten_words(monkeypatch):
    text = "some words İstanbul it's 12 <|endoftext|> " * 40 + "unbroken" * 30
    monkeypatch.setattr(packing, "SLICE_BYTES", 50)
    monkeypatch.setattr(packing, "KNOWN_WORDS", 3)
    got = packing.WordTokenizer(PATH).encode([text.encode()])[0]
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == ids_of(text)[:-1]


def plain_first_fit(lengths, cut, capacity):
    room, sequence = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (cut[i], -lengths[i], i)):
        at = next((s for s, r in enumerate(room) if r >= lengths[i]), len(room))
        room += [capacity] * (at == len(room))
        room[at] -= lengths[i]
        sequence[i] = at
    return sequence


@pytest.mark.parametrize("n", [1, 2, 3, 17, 400])
def test_the_tree_finds_the_first_that_fits(n):
    rng = np.random.default_rng(n)
    lengths, cut = rng.integers(1, 65, n), np.zeros(n, bool)
    sequence, offset = packing.first_fit_decreasing(lengths, cut, 64)
    assert sequence.tolist() == plain_first_fit(lengths.tolist(), cut.tolist(), 64)
    for s in set(sequence.tolist()):
        own = np.argsort(offset[sequence == s])
        assert (np.cumsum(lengths[sequence == s][own]) - lengths[sequence == s][own] == offset[sequence == s][own]).all()


def test_the_last_sequence_ends_at_powers_of_two():
    lengths, cut = np.array([60, 3, 32, 16, 4, 1, 8, 4]), np.array([False, False, *[True] * 6])
    sequence, _ = packing.first_fit_decreasing(lengths, cut, 64)
    sizes = np.bincount(sequence, lengths)
    assert sorted(sizes[sizes > 0].tolist()) == [64, 64]
    sequence, offset = packing.first_fit_decreasing(np.array([16, 16, 8, 2, 1]), np.ones(5, bool), 64)
    sizes = np.bincount(sequence, [16, 16, 8, 2, 1])
    assert sorted(sizes[sizes > 0].tolist()) == [1, 2, 8, 32]
    assert sorted(zip(sequence.tolist(), offset.tolist()))[:2] == [(0, 0), (0, 16)]
