"""The byte network: gradients, held-out accuracy, edge cases."""

import zlib

import numpy as np
from llm_cases import EDGE_ROWS
from pyspark.sql import functions as F

from stockledger.llm import langid, queries

SMALL = "/root/testdata/sf0.01"


def test_gradients_are_the_slopes():
    net = langid.ByteNetwork(["a", "b", "c"], hidden=3, embedded=2)
    for d in net.sides:
        d.w, d.u, d.b = (x.astype(np.float64) for x in (d.w, d.u, d.b))
    net.embedding, net.out, net.bias = (x.astype(np.float64) for x in (net.embedding, net.out, net.bias))
    codes = np.array([[32, 97, 98, 32], [32, 99, 97, 32]], np.uint8).T
    answers = np.array([0, 2])

    def loss():
        p = net.probabilities(codes)
        return -np.log(p[:, np.arange(2), answers]).mean()

    parameters = [net.embedding, net.out, net.bias] + [p for d in net.sides for p in (d.w, d.u, d.b)]
    for p, g in zip(parameters, net._gradients(codes, answers)):
        flat = [i for i in np.ndindex(p.shape) if p is not net.embedding or i[0] in (32, 97, 98, 99)][:12]
        for i in flat:
            p[i] += 1e-3
            up = loss()
            p[i] -= 2e-3
            down = loss()
            p[i] += 1e-3
            assert abs((up - down) / 2e-3 - g[i]) < 1e-3


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op3_language_id(spark, SMALL).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    fresh = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id] for r in fresh]) >= 0.97


def test_edges(spark, edge_docs, no_docs):
    rows = langid.identify_languages(edge_docs, steps=20).collect()
    assert len(rows) == len(EDGE_ROWS)
    for r in rows:
        if r.doc_id in (3, 4, 5, 7):
            assert (r.lang_pred, r.score) == ("und", 0)
        else:
            assert r.lang_pred in ("en", "fr")
    assert langid.identify_languages(no_docs).collect() == []
    untaught = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify_languages(untaught).collect()] == [("und", 0)]


def test_a_rare_label_takes_no_words_from_the_others(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(10**9 + i, "zqx wvk jjq xzz qkw", "typo") for i in range(10**3)], docs.schema).where(
        ~langid.held_out(F.col("doc_id"))
    )
    rows = langid.identify_languages(docs.unionByName(odd.limit(1))).collect()
    want = {r.doc_id: r.lang for r in docs.collect()}
    fresh = [r for r in rows if r.held_out and r.doc_id in want]
    assert np.mean([r.lang_pred == want[r.doc_id] for r in fresh]) >= 0.97


def test_rejection_with_two_languages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("lang in ('en', 'de')")
    network = langid.fit(docs)
    assert network.least_score > 0.5
    labelled = docs.where("text rlike '[a-z]{3}'")
    kept = langid.recognised(docs, network)
    assert kept.columns == docs.columns and kept.count() >= 0.97 * labelled.count()
    unsure = langid.ByteNetwork(["a", "b"])
    unsure.out[:] = 0
    unsure.least_score = network.least_score
    assert langid.recognised(docs, unsure).count() == 0
