"""Runs of words against all periods of all stretches."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest

from stockledger.llm import periodic, queries

from llm_cases import SMALL


def brute_runs(words, least_length, least_exponent):
    """All maximal stretches with a smallest period, period by period."""
    n, found = len(words), {}
    numbers = np.unique(np.array(words, dtype=object), return_inverse=True)[1] if n else np.zeros(0, int)
    for q in range(1, n // least_exponent + 1):
        same = np.concatenate([[False], numbers[q:] == numbers[:-q], [False]])
        edges = np.flatnonzero(np.diff(same.astype(int)))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = end - start + q
            if length >= max(least_length, least_exponent * q):
                # a stretch of two periods or more is found at its smallest period first
                if not any(q % p == 0 and s <= start and start + length <= s + size for (s, size), p in found.items()):
                    found[start, length] = q
    return sorted((s, size, q) for (s, size), q in found.items())


def by_brute_runs(words, least_length, least_exponent):
    return sorted(brute_runs(words, least_length, least_exponent), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least_length, least_exponent", [(2, 2), (4, 2), (6, 3), (9, 4), (24, 3)])
def test_small_alphabets(least_length, least_exponent):
    rng = np.random.default_rng(least_length)
    texts = []
    for n in [0, 1, 2, 3, 5, 8, 20, 40, 80] * 12:
        words = rng.integers(0, rng.integers(1, 5), n)
        if n > 20:
            at, q = rng.integers(0, n // 2), rng.integers(1, n // 5)
            words[at:] = np.resize(words[at : at + q], n - at)
        texts.append(words)
    got = periodic._searched([" ".join(map(str, t)).encode() for t in texts], least_length, least_exponent)
    for words, n, runs, collapsed in zip(texts, *got):
        assert n == len(words)
        assert runs == by_brute_runs(words.tolist(), least_length, least_exponent)
        dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
        assert collapsed.decode() == " ".join(str(w) for i, w in enumerate(words) if i not in dropped)


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = by_brute_runs(words, 24, 3)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
    )


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13_periodic_runs(spark, SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = [tuple(r) for r in got.collect()]
    assert order(got) == order([expected(r.doc_id, r.text) for r in docs])
    assert sum(r[1] > 0 for r in got) > 5


def test_edges(spark, edge_docs, no_docs):
    assert periodic.periodic_runs(no_docs).collect() == []
    got = periodic.periodic_runs(edge_docs, 24, 3).collect()
    assert len(got) == edge_docs.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[3].n_words == by_id[4].n_words == by_id[5].n_words == 0 and by_id[3].collapsed == ""
    # one run over the whole long text
    assert [tuple(r) for r in by_id[6].runs] == [(0, 24000, 6)]
    assert by_id[6].collapsed == "lorem ipsum dolor sit amet consectetur"
    assert by_id[2].runs == [] and by_id[None].n_words == 7


def test_overlapping_runs_and_texts_that_share_words(spark):
    a, b = ["x y "] * 20, ["y z w "] * 20
    rows = [(1, "".join(a + b)), (2, "".join(b)), (3, "x y " * 11 + "x"), (4, "x y " * 12), (5, "same words here " * 8), (5, "same words here " * 8)]
    got = periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert order((r.doc_id, [tuple(x) for x in r.runs]) for r in got) == order((i, by_brute_runs(t.split(), 24, 3)) for i, t in rows)
    assert [len(r.runs) for r in sorted(got, key=lambda r: r.doc_id)] == [2, 1, 0, 1, 1, 1]


def test_least_exponent():
    with pytest.raises(ValueError):
        periodic.periodic_runs(None, least_exponent=1)
