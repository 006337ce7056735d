"""Clustering with bounds against plain rounds over all distances."""

import hashlib

import numpy as np
import pytest

from stockledger.llm import centroids, queries

from llm_cases import SMALL

DDL = "vec_id long, embedding array<double>"


def brute(rows, clusters, rounds, dim):
    """(vec_id, cluster, distance, cluster_inertia, inertia, digest), and how often all distances were needed."""
    kept = [
        (i, [int(np.floor(256 * float(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)
    ]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    centres, vectors = [v for _, v in start], np.array([v for _, v in kept], np.int64).reshape(len(kept), dim)

    def assign():
        return ((vectors[:, None] - np.array(centres, np.int64)[None]) ** 2).sum(axis=2)

    if not kept:
        return []
    for _ in range(rounds):
        own = assign().argmin(axis=1)
        centres = [[int(s) // int((own == c).sum()) for s in vectors[own == c].sum(axis=0)] if (own == c).any() else old for c, old in enumerate(centres)]
    distances = assign()
    own, best = distances.argmin(axis=1), distances.min(axis=1)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, int(c), int(d), int(best[own == c].sum()), int(best.sum()), digests[c]) for (i, _), c, d in zip(kept, own, best)]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def result(df):
    return order(tuple(r)[:6] for r in df.collect())


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = queries.op11_centroid_clustering(spark, SMALL)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert result(got) == order(brute(rows, 40, 5, 64))


@pytest.mark.parametrize("clusters, rounds, spread", [(1, 3, 50), (7, 6, 3), (7, 6, 1), (12, 0, 40), (5, 8, 100_000)])
def test_ties_repeated_rows_and_long_runs(spark, monkeypatch, clusters, rounds, spread):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(spread)
    made = rng.integers(-spread, spread + 1, (150, 3)) / 4 + rng.integers(0, 4, (150, 1)) * spread
    rows = [(int(i % 140), v) for i, v in enumerate(made.tolist())] + [(None, [0.5, 1.0, -2.0])] * 2
    df = spark.createDataFrame(rows, DDL)
    got = centroids.cluster_vectors(df, clusters, rounds, 3)
    assert result(got) == order(brute(rows, clusters, rounds, 3))


def test_bounds_spare_scans(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(5)
    made = rng.normal(0, 0.2, (600, 4)) + rng.integers(0, 5, (600, 1)) * 20
    df = spark.createDataFrame(list(enumerate(made.tolist())), DDL)
    scans = [r.n_scans for r in centroids.cluster_vectors(df, 5, 8, 4).collect()]
    assert min(scans) >= 1 and sum(scans) < 0.6 * 9 * len(scans)


def test_edges(spark):
    odd = [(1, None), (2, [1.0, None, 2.0]), (3, [float("nan"), 1.0, 1.0]), (4, [float("inf"), 1.0, 1.0]), (5, [1.0]), (6, [])]
    df = spark.createDataFrame(odd, DDL)
    assert centroids.cluster_vectors(df, 4, 2, 3).collect() == []
    assert centroids.cluster_vectors(df.limit(0), 4, 2, 3).collect() == []
    few = odd + [(7, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 3.0]), (8, [-4.0, 0.001, 2.5])]
    df = spark.createDataFrame(few, DDL)
    for c in ("cluster", "distance", "block", "id", "inertia", "v"):
        df = df.withColumn(c, df.vec_id)
    assert result(centroids.cluster_vectors(df, 4, 2, 3)) == order(brute(few, 4, 2, 3))
    huge = spark.createDataFrame([(1, [1e300, 0.0, 0.0]), (2, [0.0, 0.0, 0.0])], DDL)
    with pytest.raises(Exception, match="too large"):
        centroids.cluster_vectors(huge, 2, 1, 3).collect()


def test_the_vectors_are_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 8)
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rng.normal(0, 1, (64, 4)).tolist())], DDL)
    rows = df.select(df.vec_id.alias("id"), df.embedding.cast("array<long>").alias("v"))
    blocks = centroids._written(centroids.packed(rows, 4).repartition(4, "block"), 4)
    start, still = np.zeros((2, 4), np.int64), np.zeros(2)
    state = centroids._written(centroids.assigned(blocks, None, start, still), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = centroids.assigned(blocks, state, start, still)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
