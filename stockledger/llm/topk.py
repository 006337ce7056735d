"""Exact top-k inner products by no-random-access aggregation.

Candidates are packed into groups of bounded size, queries into chunks, and every chunk meets
every group. Within a group each dimension is a sorted list. For a query the lists are read
sequentially and in parallel, from the end that the query's weight favours. What has been read
gives each candidate a lower and an upper bound: a dimension not yet read lies between the list's
last entry and the next one, and all of them together are at most the product of the lengths of
what is unread of both vectors. Reading stops when few candidates have an upper bound that reaches the
k-th best lower bound or, once known, the k-th best score of earlier lists; only their final scores are
then resolved. Ties are never cut off, so the smaller id wins them.

Vectors that are NULL or hold NULL or non-finite components, and rows without id, take no part;
vectors of other lengths than the query's are not compared with it. Each query row has its own result;
rows that share its id are its own. Repeated rows are candidates of their own. Scores must fit 53 bits.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.functions.distributed import materialize
from stockledger.llm.common import ship

ship(__name__)

GROUP_ROWS = 32768
LIST_ROWS = 2048
QUERY_ROWS = 256
# beyond what a root and a product in single precision can be off
ROUNDING = 1e-5
# shares of the lists after which bounds are compared
STOPS = (1 / 2, 5 / 8, 3 / 4, 7 / 8)


def _pack(rows: pa.Table) -> pa.Table:
    """One row with the ids and the matrix of a group of vectors."""
    ids = rows["id"].to_numpy()
    matrix = np.stack(rows["v"].to_numpy(zero_copy_only=False)) if len(ids) else np.zeros((0, 0))
    order = np.argsort(ids, kind="stable")
    small = np.int16 if np.abs(matrix).max(initial=0) < 2**15 else np.int64
    return pa.table(
        {
            "dim": pa.array([rows["dim"][0].as_py()], pa.int32()),
            "part": pa.array([rows["part"][0].as_py()], pa.int64()),
            "ids": pa.array([ids[order].astype(np.int64).tobytes()], pa.binary()),
            "rows": pa.array([rows["row"].to_numpy()[order].astype(np.int64).tobytes()], pa.binary()),
            "matrix": pa.array([matrix[order].astype(small).tobytes()], pa.binary()),
            "wide": pa.array([small is np.int64], pa.bool_()),
        }
    )


def _unpack(ids: bytes, matrix: bytes, wide: bool, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(matrix, np.int64 if wide else np.int16).reshape(len(ids), dim).astype(np.float64)


class SortedLists:
    """A slice of a group with one sorted list per dimension, and each candidate's place in it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        # whole numbers of sums of squares below 2**24 are exact in single precision
        single = np.abs(vectors).max(initial=0) ** 2 * vectors.shape[1] < 1 << 24
        self.turned = np.ascontiguousarray(vectors.T, np.float32 if single else np.float64)
        order = np.argsort(self.turned, axis=1, kind="stable")
        self.values = np.take_along_axis(self.turned, order, axis=1)
        self.places = np.empty(order.shape, np.uint16 if len(ids) <= 1 << 16 else np.int64)
        np.put_along_axis(self.places, order, np.arange(len(ids), dtype=self.places.dtype)[None], axis=1)
        self.lengths = np.einsum("dn,dn->n", self.turned, self.turned)

    def candidates(self, query: np.ndarray, k: int, floor: float) -> np.ndarray:
        """Positions that may be among the k best, given that k scores of `floor` are known."""
        n, alive, kind = len(self.ids), np.arange(len(self.ids)), self.turned.dtype
        if n <= 2 * k or not query.any():
            return alive
        if np.abs(query).max() ** 2 * len(query) >= 1 << 24:
            kind = np.dtype(np.float64)
        query = query.astype(kind)
        falling = query > 0  # these lists are read from their largest value down
        last = np.where(falling, self.values[:, 0], self.values[:, -1]) * query
        for share in STOPS:
            depth = int(n * share)
            read = np.where(falling[:, None], self.places >= n - depth, self.places < depth).astype(kind)
            following = np.where(falling, self.values[:, n - depth - 1], self.values[:, depth]) * query
            seen = self.turned * read
            sums = query @ seen
            bounds = np.stack([query * query, following, last])
            weight, highest, lowest = bounds.sum(axis=1)[:, None] - bounds @ read  # of what each has unread
            # the product of what is unread is at most that of the lengths; a little more for rounding
            rest = np.sqrt(weight * (self.lengths - np.einsum("dn,dn->n", seen, seen))) * (1 + ROUNDING)
            upper = sums + np.minimum(highest, rest)
            best = floor
            if floor == -np.inf:  # scores known from earlier lists are seldom below these
                best = np.partition(sums + np.maximum(lowest, -rest), n - k)[n - k]
            alive = np.flatnonzero(upper >= best)
            if len(alive) <= max(4 * k, n // 10):
                break
        return alive


def _top_of_group(asking, query_ids, queries, ids, vectors, k: int):
    """(query row, query id, id, score) of the k best of a group for each query."""
    lists = [SortedLists(ids[a : a + LIST_ROWS], vectors[a : a + LIST_ROWS]) for a in range(0, len(ids), LIST_ROWS)]
    for row, own, query in zip(asking, query_ids, queries):
        best: list[tuple[float, int]] = []  # scores with negated ids, the worst first
        for part in lists:
            # the query's own rows may be among the best
            floor = best[0][0] if len(best) == k else -np.inf
            at = part.candidates(query, k + int((part.ids == own).sum()), floor)
            scores = part.vectors[at] @ query
            at, scores = (x[(scores >= floor) & (part.ids[at] != own)] for x in (at, scores))
            for nth in np.lexsort((part.ids[at], -scores))[:k]:
                score, i = scores[nth], part.ids[at[nth]]
                entry = (score, -int(i))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        for score, i in best:
            yield int(row), int(own), -i, int(score)


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: the k best of all other rows for each row with `is_query`.

    Groups hold `GROUP_ROWS` candidates, chunks `QUERY_ROWS` queries; memory depends on neither
    number of rows. The work is queries times rows, as the search is exact.
    """
    x = F.col(vector_col)
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    sound = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = materialize(
        vectors.where(F.col(id_col).isNotNull() & sound).select(
            F.col(id_col).cast("long").alias("id"),
            whole.alias("v"),
            F.size(x).alias("dim"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    many, asking = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("asks"), 1))).first()
    groups, chunks = -(-many // GROUP_ROWS) or 1, -(-asking // QUERY_ROWS) or 1

    def packed(of: DataFrame, parts: int) -> DataFrame:
        # the row's number is hashed as well, for rows that repeat
        dealt = of.select("dim", F.pmod(F.xxhash64("id", "v", "row"), F.lit(parts)).alias("part"), "id", "v", "row")
        return dealt.groupBy("dim", "part").applyInArrow(_pack, "dim int, part long, ids binary, rows binary, matrix binary, wide boolean")

    asked = packed(rows.where("asks"), chunks).select("dim", F.col("part").alias("chunk"), *[F.col(c).alias(f"q_{c}") for c in ("ids", "rows", "matrix", "wide")])
    held = packed(rows, groups).drop("rows").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = held.repartition(max(spread, min(groups * chunks, 4096)), "dim", "part", "chunk").join(asked.hint("shuffle_hash"), ["dim", "chunk"])

    def search(batches):
        for batch in batches:
            for r in batch.to_pylist():
                asking = np.frombuffer(r["q_rows"], np.int64)
                if r["dim"] == 0:
                    ids, q_ids = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["q_ids"], np.int64)
                    found = [(int(a), int(q), int(i), 0) for a, q in zip(asking, q_ids) for i in [x for x in ids if x != q][:k]]
                else:
                    ids, matrix = _unpack(r["ids"], r["matrix"], r["wide"], r["dim"])
                    q_ids, queries = _unpack(r["q_ids"], r["q_matrix"], r["q_wide"], r["dim"])
                    found = list(_top_of_group(asking, q_ids, queries, ids, matrix, k))
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame(found, columns=["asking", "query_id", "vec_id", "score"]).astype("int64"), preserve_index=False
                )

    best = met.mapInArrow(search, "asking long, query_id long, vec_id long, score long")
    order = Window.partitionBy("asking").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
