"""The n-gram join against all pairs."""

import random
import re
from collections import Counter

import pytest
from llm_cases import EDGE_ROWS

from stockledger.llm import ngram_join, queries

SMALL = "/root/testdata/sf0.01"


def brute(docs, words, percent):
    sets, parent = [], {}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (doc_id, text) in enumerate(docs):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lower)
        sets.append({tuple(w[j : j + words]) for j in range(max(1, len(w) - words + 1))} if w else set())
        parent[i] = i
    by_token = {}
    for i, s in enumerate(sets):
        seen = Counter(j for t in s for j in by_token.get(t, ()))
        for j, both in seen.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
        for t in s:
            by_token.setdefault(t, []).append(i)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        ids = [x for x in (least.get(root(i)), doc_id) if x is not None]
        least[root(i)] = min(ids) if ids else None
    return Counter((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(docs))


def got(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert got(queries.op1_ngram_join(spark, SMALL)) == brute(docs, 4, 85)


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80), (3, 90)])
def test_near_copies_of_all_sizes(spark, words, percent):
    rng = random.Random(words)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(50)]
    docs = []
    for family in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 6, 15, 17, 20, 30, 33, 60, 64, 70, 130, 500]))]
        if family % 3 == 0:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rng.choice([1, 2, 5, 12])):
            copy = list(base)
            for _ in range(rng.randrange(0, 2 + len(base) // 20)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                copy += [rng.choice(vocabulary) for _ in range(len(base) // 15)]
            docs.append((len(docs), " ".join(copy)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(ngram_join.similar_documents(frame, words, percent)) == brute(docs, words, percent)


def test_edges(edge_docs, no_docs):
    docs = [(r[0], r[1]) for r in EDGE_ROWS]
    assert got(ngram_join.similar_documents(edge_docs)) == brute(docs, 5, 80)
    assert got(ngram_join.similar_documents(no_docs)) == {}


def test_every_link_shares_a_signature():
    rng = random.Random(1)
    known = ngram_join.WordHashes()
    for _ in range(400):
        words = [f"w{rng.randrange(1000)}" for _ in range(rng.randrange(5, 300))]
        copy = list(words)
        for _ in range(rng.randrange(1, 1 + len(words) // 12 + 1)):
            copy[rng.randrange(len(copy))] = "x"
        a, b = (ngram_join.shingle_set(" ".join(x).encode(), 4, known) for x in (words, copy))
        both = len(set(a) & set(b))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            assert set(ngram_join.signatures(a, 85)) & set(ngram_join.signatures(b, 85))


def test_rows_without_id_and_shared_ids(spark):
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randrange(1000)}" for _ in range(n)]
    unnamed, shared, other, mixed = text(80), text(80), text(80), text(80)
    docs = [(None, unnamed), (None, unnamed[:-1]), (None, unnamed), (7, shared), (7, other), (8, shared[1:]), (9, other[:-2]), (None, mixed), (3, mixed[1:])]
    docs = [(i, " ".join(w)) for i, w in docs]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = brute(docs, 5, 80)
    assert got(ngram_join.similar_documents(frame, 5, 80)) == want
    assert ngram_join.one_of_each(frame, 5, 80).count() == 4


def test_frequent_parts_are_left_out_without_loss():
    """Whatever the second order, two sets that link keep a part in common."""
    rng = random.Random(3)
    known = ngram_join.WordHashes()
    order = lambda x, seed: (ngram_join.mixed(x ^ ngram_join.np.uint64(seed * 7919)) >> ngram_join.np.uint64(60), x)
    for k in range(400):
        words = [f"w{rng.randrange(1000)}" for _ in range(rng.randrange(5, 300))]
        copy = list(words)
        for _ in range(rng.randrange(1, 1 + len(words) // 12 + 1)):
            copy[rng.randrange(len(copy))] = "x"
        a, b = (ngram_join.shingle_set(" ".join(x).encode(), 4, known) for x in (words, copy))
        both = len(set(a) & set(b))
        if 100 * both < 85 * (len(a) + len(b) - both):
            continue
        kept = []
        for tokens in (a, b):
            left = set()
            for spare, own in ngram_join.owned_parts(tokens, 85):
                place = ngram_join.np.lexsort(order(own, k)[::-1])
                left |= set(own[place][: len(own) - spare])
            kept.append(left)
        assert kept[0] & kept[1]


def test_a_pattern_of_many_documents_is_no_signature(spark):
    """Half of each document is common to all, and none link: hardly a common part may be looked up."""
    rng = random.Random(5)
    pattern = [f"p{i}" for i in range(60)]
    docs = [(i, " ".join(pattern + [f"w{rng.randrange(10**6)}" for _ in range(60)])) for i in range(120)]
    docs.append((500, docs[0][1] + " more"))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    join = ngram_join.NgramJoin(frame, 4, 85)
    held = join._shared().groupBy("sig").count().agg({"count": "max"}).first()[0]
    assert (held or 0) <= 12
    assert got(join.members()) == brute(docs, 4, 85)


def test_what_sets_own_is_shuffled_once(spark, monkeypatch):
    """Counts and rows of the signatures come from one reading; of their hashes, 48 bits are kept."""
    docs = spark.createDataFrame([(i, " ".join(f"w{i // 2}x{k}" for k in range(60 + i % 2))) for i in range(8)], "doc_id long, text string")
    join = ngram_join.NgramJoin(docs, 4, 85)
    written = []
    monkeypatch.setattr(ngram_join, "materialize", lambda df: written.append(df) or df)
    join._shared()
    plan = written[-1]._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Generate") == 2
    own = join.rows.selectExpr("explode(signed) AS s").selectExpr("explode(s.own) AS sig").agg({"sig": "max"}).first()[0]
    assert 0 < own < 1 << 48
