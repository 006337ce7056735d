"""Lloyd's clustering with heap-ordered bounds, exact in whole numbers.

Vectors are packed into blocks once. In a block each cluster keeps a heap of its vectors, ordered by
the gap between the distance to the second nearest and to the own centroid when they were last
scanned, plus the drift that the cluster had accumulated then. A round adds to a cluster's drift how far
its own centroid moved and how far any other did at most. A vector whose gap is above the drift is
still strictly nearest to its own centroid; only the others are popped and scanned again against all
centroids, in whole numbers, and go to the heap of the cluster found. A heap whose smallest entry has
not expired is not opened. Gaps are narrowed and drifts widened by more than rounding can do, so ties
and all results are exact.

Sums of clusters change by the vectors that moved: a block gives the change per cluster, and one row
per cluster reaches the driver. Blocks are a table bucketed by block number, and so are the heaps that
each round writes, so the two meet without a shuffle, and vectors are written once. Memory of a task
depends on the block size alone, whatever values repeat.

Vectors that are NULL, of another length, or hold NULL or non-finite components take no part.
Components beyond 2**27 in size are an error, as distances would not be exact. Repeated rows are
vectors of their own; rows without id take part and come last as starts. Fewer vectors than
clusters give fewer clusters; no vector gives no row.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockledger.functions.distributed import materialize, shared_folder
from stockledger.llm.common import ship

ship(__name__)

BLOCK_ROWS = 4096
BLOCKS_PER_BUCKET = 16
MOST_BUCKETS = 50_000
LARGEST = 1 << 27
# beyond what sums and roots of doubles can be off
SLACK = 1e-9
BLOCK = "block long, ids array<long>, vectors binary, wide boolean"
STATE = "block long, sizes binary, rows binary, gaps binary, scans binary, changes array<struct<cluster:int,many:long,total:array<long>>>"


def _written(df: DataFrame, buckets: int) -> DataFrame:
    """The rows as a table in the shared folder, bucketed by block."""
    name = f"stockledger_{uuid.uuid4().hex}"
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.bucketBy(buckets, "block").option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def packed(rows: DataFrame, dim: int) -> DataFrame:
    """Blocks of at most `BLOCK_ROWS` vectors in the order they are read."""

    def blocks(batches):
        task, nth = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                vectors = part.column(1).flatten().to_numpy(zero_copy_only=False)
                wide = bool(np.abs(vectors).max() >= 1 << 15)
                data = vectors.astype("<i4" if wide else "<i2").tobytes()
                ids = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column(0).cast(pa.int64()))
                columns = [pa.array([task + nth], pa.int64()), ids, pa.array([data], pa.binary()), pa.array([wide])]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "vectors", "wide"])
                nth += 1

    return rows.mapInArrow(blocks, BLOCK)


def squares(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of every vector to every centroid."""
    largest = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if largest * largest * vectors.shape[1] * 4 < 1 << 52:  # whole numbers that doubles hold
        a, b = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    return np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)


class Block:
    """The vectors of a block and one heap of (gap, row) per cluster, as arrays until one is opened."""

    def __init__(self, vectors: np.ndarray, clusters: int, state: dict | None):
        self.vectors, self.new = vectors, state is None
        if self.new:
            self.scans = np.zeros(len(vectors), np.int32)
            self.heaps = [(np.zeros(0, np.int32), np.zeros(0)) for _ in range(clusters)]
        else:
            self.scans = np.frombuffer(state["scans"], "<i4").copy()
            cuts = np.cumsum(np.frombuffer(state["sizes"], "<i4"))[:-1]
            rows, gaps = np.frombuffer(state["rows"], "<i4"), np.frombuffer(state["gaps"], "<f8")
            self.heaps = list(zip(np.split(rows, cuts), np.split(gaps, cuts)))

    def expired(self, drifts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows popped because their gap may not hold any more, with the cluster each comes from."""
        if self.new:
            return np.arange(len(self.vectors)), np.full(len(self.vectors), -1)
        popped, source = [], []
        for cluster, (rows, gaps) in enumerate(self.heaps):
            if len(gaps) and gaps[0] <= drifts[cluster]:
                heap = list(zip(gaps.tolist(), rows.tolist()))
                while heap and heap[0][0] <= drifts[cluster]:
                    popped.append(heapq.heappop(heap)[1])
                    source.append(cluster)
                self.heaps[cluster] = heap
        return np.array(popped, np.int64), np.array(source, np.int64)

    def scan(self, rows: np.ndarray, centroids: np.ndarray, drifts: np.ndarray) -> np.ndarray:
        """Finds the nearest centroid of `rows`, the smaller number first, and pushes them to its heap."""
        distances = squares(self.vectors[rows], centroids)
        nearest = distances.argmin(axis=1)
        own = np.sqrt(distances[np.arange(len(rows)), nearest].astype(np.float64))
        distances[np.arange(len(rows)), nearest] = np.iinfo(np.int64).max
        other = np.sqrt(distances.min(axis=1).astype(np.float64)) if len(centroids) > 1 else np.full(len(rows), np.inf)
        gaps = np.where(np.isinf(other), other, (other - own) - SLACK * (other + own)) + drifts[nearest] * (1 - SLACK)
        for cluster in np.unique(nearest):
            heap = self.heaps[cluster]
            if isinstance(heap, tuple):
                heap = list(zip(heap[1].tolist(), heap[0].tolist()))
            for i in np.flatnonzero(nearest == cluster):
                heapq.heappush(heap, (float(gaps[i]), int(rows[i])))
            self.heaps[cluster] = heap
        self.scans[rows] += 1
        return nearest

    def state(self) -> dict[str, bytes]:
        rows = [np.array([r for _, r in h], "<i4") if isinstance(h, list) else h[0] for h in self.heaps]
        gaps = [np.array([g for g, _ in h], "<f8") if isinstance(h, list) else h[1] for h in self.heaps]
        return {
            "sizes": np.array([len(r) for r in rows], "<i4").tobytes(),
            "rows": np.concatenate(rows).astype("<i4").tobytes(),
            "gaps": np.concatenate(gaps).astype("<f8").tobytes(),
            "scans": self.scans.astype("<i4").tobytes(),
        }

    def clusters(self) -> np.ndarray:
        out = np.zeros(len(self.vectors), np.int64)
        for cluster, h in enumerate(self.heaps):
            out[[r for _, r in h] if isinstance(h, list) else h[0]] = cluster
        return out


def _matrix(row: dict, dim: int) -> np.ndarray:
    return np.frombuffer(row["vectors"], "<i4" if row["wide"] else "<i2").reshape(-1, dim).astype(np.int64)


def assigned(blocks: DataFrame, state: DataFrame | None, centroids: np.ndarray, drifts: np.ndarray) -> DataFrame:
    """The heaps of all blocks after one assignment, with the changes of the clusters' sums."""
    k, dim = centroids.shape
    rows = blocks.drop("ids") if state is None else blocks.drop("ids").join(state.drop("changes"), "block")

    def change(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(_matrix(row, dim), k, row if state_known else None)
                popped, source = block.expired(drifts)
                changes = []
                if len(popped):
                    nearest = block.scan(popped, centroids, drifts)
                    moved = nearest != source
                    for c in np.unique(np.concatenate([nearest[moved], source[moved & (source >= 0)]])):
                        come, gone = popped[moved & (nearest == c)], popped[moved & (source == c)]
                        total = block.vectors[come].sum(axis=0) - block.vectors[gone].sum(axis=0)
                        changes.append({"cluster": int(c), "many": len(come) - len(gone), "total": total.tolist()})
                yield pa.RecordBatch.from_pylist([{"block": row["block"], **block.state(), "changes": changes}], schema=out)

    state_known = state is not None
    item = pa.struct([("cluster", pa.int32()), ("many", pa.int64()), ("total", pa.list_(pa.int64()))])
    fields = [("block", pa.int64()), *[(c, pa.binary()) for c in ("sizes", "rows", "gaps", "scans")], ("changes", pa.list_(item))]
    out = pa.schema(fields)
    return rows.mapInArrow(change, STATE)


def _changes(state: DataFrame, dim: int) -> list:
    """One row per cluster: the change of its count and of its sum in each component."""
    moved = state.select(F.explode("changes").alias("c")).select("c.*")
    exact = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(dim)]
    return moved.groupBy("cluster").agg(F.sum("many").alias("many"), *exact).collect()


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = 40,
    rounds: int = 5,
    dim: int = 64,
    scale: int = 256,
    seed: str = "2:",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """`vec_id`, `cluster`, `distance`, `cluster_inertia`, `inertia`, `centroid_sha256`, `n_scans` of every vector.

    Components count as floor(scale * x). The starts are the vectors with the smallest SHA-256 of
    `seed` and their id. Each of `rounds` rounds assigns and moves the centroids to the floor of
    their vectors' mean; then vectors are assigned once more. `n_scans` counts exact scans.
    """
    spark = vectors.sparkSession
    x = F.col(vector_col)
    sound = F.coalesce((F.size(x) == dim) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    large = F.exists("v", lambda c: F.abs(c.cast("double")) >= LARGEST)
    wrong = F.raise_error(F.lit("components of a vector are too large for exact distances"))
    rows = vectors.where(sound).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))
    rows = rows.select("id", F.when(large, wrong).otherwise(F.col("v").cast("array<long>")).alias("v"))

    hashed = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    starts = rows.orderBy(hashed.asc_nulls_last(), "v").limit(clusters).collect()
    schema = (
        "vec_id long, cluster int, distance long, n_scans int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    if not starts:
        return spark.createDataFrame([], schema).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_scans")
    centroids = np.array([r["v"] for r in starts], np.int64)
    k = len(centroids)

    made = packed(rows, dim)
    many = vectors.count()
    buckets = min(max(many // (BLOCK_ROWS * BLOCKS_PER_BUCKET), spark.sparkContext.defaultParallelism), MOST_BUCKETS)
    blocks, state = _written(made.repartition(buckets, "block"), buckets), None
    counts, totals, drifts = [0] * k, [[0] * dim for _ in range(k)], np.zeros(k)
    for nth in range(rounds + 1):
        state = _written(assigned(blocks, state, centroids, drifts), buckets)
        if nth == rounds:
            break
        for r in _changes(state, dim):
            counts[r["cluster"]] += r["many"]
            totals[r["cluster"]] = [t + int(r[f"t{i}"]) for i, t in enumerate(totals[r["cluster"]])]
        moved = np.array([[t // n for t in total] if n else old.tolist() for n, total, old in zip(counts, totals, centroids)], np.int64)
        drifts = drifts + drift(centroids, moved)
        centroids = moved
    return _described(blocks, state, centroids)


def drift(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """How far a vector's gap can have shrunk per cluster: its own centroid's way and the longest of the others."""
    way = np.sqrt(((after - before).astype(np.float64) ** 2).sum(axis=1)) * (1 + SLACK)
    others = np.array([np.delete(way, i).max(initial=0.0) for i in range(len(way))])
    return (way + others) * (1 + SLACK)


def _described(blocks: DataFrame, state: DataFrame, centroids: np.ndarray) -> DataFrame:
    k, dim = centroids.shape

    def distances(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(_matrix(row, dim), k, row)
                cluster = block.clusters()
                distance = ((block.vectors - centroids[cluster]) ** 2).sum(axis=1)
                columns = [pa.array(row["ids"], pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64()), pa.array(block.scans, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance", "n_scans"])

    found = materialize(blocks.join(state.drop("changes"), "block").mapInArrow(distances, "vec_id long, cluster int, distance long, n_scans int"))
    # one row per cluster
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    names = found.sparkSession.createDataFrame(list(enumerate(digests)), "cluster int, centroid_sha256 string")
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    about = names.join(sums.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy())), "cluster")
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_scans"
    )
