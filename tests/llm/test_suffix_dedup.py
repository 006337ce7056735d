"""Repeat removal against all strings."""

import hashlib
import random
from collections import Counter

import pytest
from llm_cases import EDGE_ROWS, SMALL

from stockledger.llm import queries, suffix_dedup


def brute(docs, length):
    """Rows of (id, text); equal rows count once."""
    named = sorted({((d is None, d or 0), suffix(t), t) for d, t in docs}, key=lambda x: x[0])
    seen, out = set(), {}
    for d, _, t in named:
        data, gone = (t or "").encode(), bytearray(len((t or "").encode()))
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d, t] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return Counter((d, *out[(d is None, d or 0), t]) for d, t in docs)


def suffix(text):
    return text or ""


def got(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = brute(docs, 100)
    assert got(queries.op6_suffix_dedup(spark, SMALL)) == want
    assert sum(w[2] for w in want) > 1000


@pytest.mark.parametrize("length,piece", [(100, 1 << 19), (30, 700), (10, 64)])
def test_planted_repeats(spark, monkeypatch, length, piece):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    rng = random.Random(length)
    letters = "abcdé "
    passages = ["".join(rng.choice(letters) for _ in range(rng.randrange(length // 2, length * 3))) for _ in range(20)]
    docs = []
    for i in range(150):
        text = ""
        for _ in range(rng.randrange(0, 5)):
            text += "".join(rng.choice(letters) for _ in range(rng.randrange(0, 2 * length)))
            text += rng.choice(passages)
        if i % 10 == 0:
            text = "ab" * length + text
        docs.append((rng.randrange(10**6) * 1000 + i, text))
    docs += [(d + 1000, t) for d, t in docs[:30]]
    docs += [(d + 2000, t[: len(t) // 2] + "x" + t[len(t) // 2 :]) for d, t in docs[:40]]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert got(suffix_dedup.remove_repeats(frame, length)) == brute(docs, length)


def test_edges(edge_docs, no_docs):
    docs = [(r[0], r[1]) for r in EDGE_ROWS]
    assert got(suffix_dedup.remove_repeats(edge_docs)) == brute(docs, 100)
    assert got(suffix_dedup.remove_repeats(no_docs)) == {}


@pytest.mark.parametrize("partitions", [1, 6])
def test_equal_rows_are_one_document(spark, partitions):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared, lone, unnamed = text(300), text(250), text(400)
    inner = text(150)
    docs = [(1, shared), (1, shared), (2, shared), (2, shared), (3, lone), (3, lone), (3, lone), (None, unnamed), (None, unnamed)]
    # a run that differs from another one in its bucket is looked at string by string
    docs += [(4, text(60) + inner + text(70))] * 2 + [(5, text(80) + inner + text(50))] * 2 + [(6, inner + inner)] * 2
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(partitions)
    want = brute(docs, 100)
    assert want[None, 400, 0, 0, hashlib.sha256(unnamed.encode()).hexdigest()] == 2
    assert got(suffix_dedup.remove_repeats(frame)) == want
