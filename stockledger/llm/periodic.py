"""Periodic runs of words by uniting suffix classes from the longest common prefix downwards.

A run is a maximal stretch of consecutive words that repeat at a smallest period. Suffixes of the words
are sorted, and neighbours in that order are united by decreasing length of their common prefix, as
Kruskal's algorithm does with edges. Each class of united suffixes keeps its positions in order. Two
positions that become neighbours at a common prefix of `l` words and lie `d <= l` words apart are a
stretch of `d + l` words with period `d`; the prefix ends where the stretch does, and where the words
before both positions differ it begins there. A smaller period of the same stretch would have put a
position of the same class between the two before, so `d` is the smallest one, and each run is found once.

A run of at least `least_length` words and `least_exponent` periods has a common prefix of at least
`least_length * (1 - 1 / least_exponent)` words, so classes with shorter prefixes are not united. For
the same reason only stretches covered by windows of that many words that occur again in the same
stretch are sorted at all; windows are compared by a hash, which can only add stretches.

NULL and empty texts have no words and no run. A row is a document: repeated rows and rows without id
each get their own result. Texts are read whole; memory grows with the longest text.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm.common import ship

ship(__name__)

RUN = "struct<start:long,length:long,period:long>"
BATCH_BYTES = 8 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BASE = 0xD1342543DE82EF95


def suffix_order(words: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, a shorter one first, by doubling the compared length."""
    n, length = len(words), 1
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    while True:
        following = np.zeros(n, np.int64)
        following[: max(n - length, 0)] = rank[length:] + 1
        pair = rank * (n + 1) + following
        order = np.argsort(pair, kind="stable")
        step = np.concatenate([[0], np.diff(pair[order]) > 0])
        rank[order] = np.cumsum(step)
        if length >= n or rank[order[-1]] == n - 1:
            return order
        length *= 2


def common_prefixes(words: list[int], order: list[int]) -> list[int]:
    """Words each suffix shares with the one before it in `order`; 0 for the first."""
    n, shared = len(words), 0
    place, prefixes = [0] * n, [0] * n
    for at, position in enumerate(order):
        place[position] = at
    for i in range(n):
        at = place[i]
        if at == 0:
            shared = 0
            continue
        j = order[at - 1]
        end = n - max(i, j)
        while shared < end and words[i + shared] == words[j + shared]:
            shared += 1
        prefixes[at] = shared
        shared = max(shared - 1, 0)
    return prefixes


def runs_of(words: np.ndarray, least_length: int, least_exponent: int, least_prefix: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of numbered words."""
    order = suffix_order(words).tolist()
    words = words.tolist()
    prefixes = common_prefixes(words, order)
    weights = np.array(prefixes)
    edges = np.flatnonzero(weights >= least_prefix)
    edges = edges[np.argsort(-weights[edges], kind="stable")].tolist()
    parent, members, found = list(range(len(words))), {}, []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def seed(i: int, j: int, prefix: int) -> None:
        period = j - i
        if prefix + period >= max(least_length, least_exponent * period) and (i == 0 or words[i - 1] != words[j - 1]):
            found.append((i, prefix + period, period))

    for at in edges:
        prefix, left, right = prefixes[at], root(at - 1), root(at)
        large = members.pop(left, None) or [order[left]]
        small = members.pop(right, None) or [order[right]]
        if len(large) < len(small):
            large, small = small, large
        for p in small:
            insort(large, p)
        own = set(small)
        for p in small:
            nth = bisect_left(large, p)
            if nth > 0 and large[nth - 1] not in own:
                seed(large[nth - 1], p, prefix)
            if nth + 1 < len(large) and large[nth + 1] not in own:
                seed(p, large[nth + 1], prefix)
        parent[right] = left
        members[left] = large
    return sorted(found, key=lambda r: (r[0], r[2]))


def _again(groups: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a hash occurs more than once in its group."""
    with np.errstate(over="ignore"):
        keys = hashes ^ ((groups.astype(np.uint64) + np.uint64(1)) * GOLDEN)
    order = np.argsort(keys)
    equal = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][equal]] = True
    out[order[:-1][equal]] = True
    return out


def repeating_stretches(words: np.ndarray, bounds: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """(document, start, end) of the stretches that hold every run whose common prefix reaches `window`.

    `bounds` has the first word of each document and the number of all words.
    """
    n = len(words)
    document = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(np.arange(n) + window <= bounds[1:][document])
    if len(at) < 2:
        return []
    with np.errstate(over="ignore"):
        mixed = (words.astype(np.uint64) + np.uint64(1)) * GOLDEN
        mixed ^= mixed >> np.uint64(29)
        powers = np.cumprod(np.full(n, BASE, np.uint64))
        back = np.cumprod(np.full(n, pow(BASE, -1, 1 << 64), np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * powers)])
        hashes = (sums[at + window] - sums[at]) * back[at]
    kept = _again(document[at], hashes)
    at, hashes = at[kept], hashes[kept]
    if not len(at):
        return []
    stretch = np.concatenate([[0], np.cumsum((np.diff(at) > window) | (np.diff(document[at]) > 0))])
    repeats = np.unique(stretch[_again(stretch, hashes)])
    first = np.flatnonzero(np.concatenate([[True], np.diff(stretch) > 0]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return [(int(document[at[first[s]]]), int(at[first[s]]), int(at[last[s]]) + window) for s in repeats]


def _searched(texts: list[bytes], least_length: int, least_exponent: int) -> tuple[list[int], list[list], list[bytes]]:
    """Word counts, runs and collapsed texts."""
    window = max(-(-least_length * (least_exponent - 1) // least_exponent), 1)
    split = [t.split() for t in texts]
    counts = [len(s) for s in split]
    number = defaultdict(int)
    number.default_factory = number.__len__
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    words = np.fromiter((number[w] for s in split for w in s), np.int64, int(bounds[-1]))
    runs: list[list] = [[] for _ in texts]
    for d, start, end in repeating_stretches(words, bounds, window):
        offset = start - int(bounds[d])
        runs[d] += [(offset + s, length, q) for s, length, q in runs_of(words[start:end], least_length, least_exponent, window)]
    collapsed = []
    for s, own in zip(split, runs):
        if own:
            own.sort(key=lambda r: (r[0], r[2]))
            kept = np.ones(len(s), bool)
            for start, length, period in own:
                kept[start + period : start + length] = False
            s = [s[i] for i in np.flatnonzero(kept)]
        collapsed.append(b" ".join(s))
    return counts, runs, collapsed


def periodic_runs(
    docs: DataFrame, least_length: int = 24, least_exponent: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id`, `n_words`, `runs` (array of start, length, period in words, by start and period) and `collapsed`.

    Runs have at least `least_length` words and `least_exponent` periods (2 or more). In `collapsed`
    a run's words after its first period are left out, and words are joined by one space.
    """
    if least_exponent < 2:
        raise ValueError("a run has at least two periods")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def search(batches):
        for batch in batches:
            sizes = np.cumsum([len(t) for t in _bytes(batch)])
            cuts = np.flatnonzero(np.diff(sizes // BATCH_BYTES, prepend=0)).tolist()
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                if end > start:
                    part = batch.slice(start, end - start)
                    counts, runs, collapsed = _searched(_bytes(part), least_length, least_exponent)
                    found = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
                    arrays = [part.column(0), pa.array(counts, pa.int64()), pa.array(found, run), pa.array(collapsed, pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "runs", "collapsed"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(search, f"doc_id {id_type}, n_words long, runs array<{RUN}>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column(1).to_pylist()]
