"""Exact removal of long repeated byte strings by bucket-pointer refinement.

A byte is removed if it lies in a string of `length` bytes that also starts earlier, in a document
with a smaller id or further left in the same one. Buckets are refined in three steps, each of which
sorts on identifiers that later offsets got in the step before:

1. The bucket identifiers of short strings are combined with those at later offsets, again and again,
   into identifiers of q-grams and of whole strings of `length` bytes, within a document's own bytes.
2. Every string of `length` bytes goes into the bucket of the smallest q-gram it holds, which is the
   same wherever the string occurs. Neighbouring strings mostly share its place, and a run of them is
   one row: the q-gram and an identifier of all its strings. Rows are sorted by both. Alone in its
   bucket, a run repeats nothing; equal to an earlier run, it repeats as a whole.
3. Only runs that differ from another one in their bucket are refined to their single strings, which
   are sorted by their own identifiers. All but the first of equal strings are repeats.

Tasks drop what they know to be a repeat of their own rows before anything is shuffled, so a text
or line that a third of all documents hold is one row per task. Identifiers have 64 bits.

NULL text is empty; rows without id come after all others; rows that share an id are told apart by
24 bits of their text's hash, those without id by 64 bits. Equal rows with equal ids are one document,
which all of them report: what a row shares with its equals at the same place is no repeat.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockledger.functions.distributed import materialize
from stockledger.llm.common import ship

ship(__name__)

LENGTH = 100
GRAM = 40  # longer ones make more runs, but fewer that meet a differing one
PIECE = 1 << 17  # bytes handled at a time; a longer text is cut, and its runs with it
SPANS = 1 << 10
PLACE = np.uint64((1 << 24) - 1)  # room for places in a group of pieces
LAST = (1 << 63) - 1


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


BYTE_IDS = mixed(mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def refined(ids: np.ndarray, reach: int, wanted: int) -> np.ndarray:
    """Identifiers of strings of `wanted` bytes from those of `reach` bytes, doubling as far as it goes."""
    while reach < wanted:
        step = min(reach, wanted - reach)
        if len(ids) <= step:
            return ids[:0]
        ids = mixed(ids[:-step] * np.uint64(0x9E3779B97F4A7C15) + ids[step:])
        reach += step
    return ids


def smallest_within(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        values = np.minimum(values[:-step], values[step:])
        reach += step
    return values


def string_ids(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every start of a whole string: its smallest q-gram, the leftmost place of that, its own identifier.

    Strings that share the place of their smallest q-gram differ: equal ones have it at one offset.
    """
    gram = min(GRAM, length)
    grams = refined(BYTE_IDS[data], 1, gram)
    places = np.arange(len(grams), dtype=np.uint64)
    least = smallest_within((grams & ~PLACE) | places, length - gram + 1) & PLACE
    return grams[least], least, refined(grams, gram, length)


def pieces(texts: list[bytes], length: int):
    """Groups of whole texts, or parts of one long text: (row of each byte's text, first offset, bytes) per part.

    Parts of a text overlap so that every string lies in one of them.
    """
    group, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[at : at + PIECE + length - 1]
            if len(part) < length:
                continue
            group.append((row, at, part))
            size += len(part)
            if size >= PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


def strings_of(group, length: int):
    """Starts of all whole strings of a group of parts: part number, offset in the text, bucket, its place, identifier."""
    data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
    sizes = np.array([len(p) for _, _, p in group])
    ends = np.cumsum(sizes)
    bucket, place, own = string_ids(data, length)
    part = np.repeat(np.arange(len(group)), sizes)[: len(own)]
    within = np.arange(len(own)) + length <= ends[part]
    offset = np.arange(len(own)) - (ends - sizes)[part] + np.array([a for _, a, _ in group])[part]
    return part[within], offset[within], bucket[within], place[within], own[within]


def _first_seen(*keys: np.ndarray) -> np.ndarray:
    """Whether each row is the first with its keys."""
    order = np.lexsort(keys[::-1])
    same = np.ones(len(order), bool)
    for k in keys:
        same[1:] &= k[order][1:] == k[order][:-1]
    same[:1] = False
    out = np.empty(len(order), bool)
    out[order] = ~same
    return out


RUNS = "doc long, twin long, at int, many int, bucket long, run long, repeats boolean"


def runs(batches, length: int):
    """Runs of strings that share their smallest q-gram; `repeats` where the same run came before in the batch."""
    for batch in batches:
        texts, docs, twins = _in_order(batch, "text")
        rows = []
        for group in pieces(texts, length):
            part, offset, bucket, place, own = strings_of(group, length)
            starts = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (part[1:] != part[:-1])])
            many = np.diff(np.r_[starts, len(part)])
            nth = (np.arange(len(part)) - np.repeat(starts, many)).astype(np.uint64)
            run = np.add.reduceat(mixed(own + nth * np.uint64(0x9E3779B97F4A7C15)), starts)
            row = np.array([r for r, _, _ in group])[part[starts]]
            rows.append((row, offset[starts], many, bucket[starts], run))
        if not rows:
            continue
        row, at, many, bucket, run = (np.concatenate(c) for c in zip(*rows))
        doc, twin = docs[row], twins[row]
        repeats = ~_first_seen(bucket, run)
        # known repeats need no bucket: they are dealt out anywhere
        bucket = np.where(repeats, mixed(run + at.astype(np.uint64) + doc.view(np.uint64)), bucket)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(twin), pa.array(at.astype(np.int32)), pa.array(many.astype(np.int32)),
             pa.array(bucket.view(np.int64)), pa.array(run.view(np.int64)), pa.array(repeats)],
            names=["doc", "twin", "at", "many", "bucket", "run", "repeats"],
        )


def _in_order(batch, *columns: str):
    """The columns' values, ids and twins by id, twin: what comes first in a batch then comes first. Equal rows stay once."""
    docs, twins = batch.column("doc").to_numpy(), batch.column("twin").to_numpy()
    order = np.lexsort((twins, docs))
    again = np.r_[False, (docs[order][1:] == docs[order][:-1]) & (twins[order][1:] == twins[order][:-1])][: len(order)]
    order = order[~again]
    batch = batch.take(pa.array(order))
    return *(batch.column(c).to_pylist() for c in columns), docs[order], twins[order]


def _all_strings(parts: list[bytes], length: int) -> np.ndarray:
    """Identifiers of all whole strings of the parts, one after the other."""
    if not parts:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b"".join(parts), np.uint8)
    gram = min(GRAM, length)
    ids = refined(refined(BYTE_IDS[data], 1, gram), gram, length)
    ends = np.cumsum([len(p) for p in parts])
    inside = np.ones(len(data), bool)
    for back in range(1, length):
        inside[ends - back] = False
    return ids[inside[: len(ids)]]


def single_strings(batches, length: int):
    """The strings of the runs listed with each text, with their identifiers."""
    for batch in batches:
        texts, listed, docs, twins = _in_order(batch, "text", "runs")
        spans = [(i, x["at"], x["many"]) for i, found in enumerate(listed) for x in sorted(found, key=lambda x: x["at"])]
        if not spans:
            continue
        which, first, many = np.array(spans, np.int64).T
        own, chunk = [], []
        for i, at, n in spans:
            chunk.append(texts[i][at : at + n + length - 1])
            if len(chunk) == SPANS:
                own.append(_all_strings(chunk, length))
                chunk = []
        own = np.concatenate([*own, _all_strings(chunk, length)])
        doc, twin = np.repeat(docs[which], many), np.repeat(twins[which], many)
        at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(len(own))
        repeats = ~_first_seen(own)
        own = np.where(repeats, mixed(own + at.astype(np.uint64) + doc.view(np.uint64)), own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(twin), pa.array(at.astype(np.int32)), pa.array(own.view(np.int64)), pa.array(repeats)],
            names=["doc", "twin", "at", "own", "repeats"],
        )


def removed_spans(starts: list[tuple[int, int]], length: int) -> np.ndarray:
    """Maximal byte spans covered by runs (first start, number of starts) of repeated strings."""
    found = np.array(sorted(starts), np.int64).reshape(-1, 2)
    begin, end = found[:, 0], np.maximum.accumulate(found.sum(axis=1) + length - 1)
    new = np.r_[True, begin[1:] > end[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(begin) - 1]
    return np.stack([begin[new], end[last]], axis=1)


def cut(batches, length: int):
    """Per text with repeats: bytes, removed bytes, removed spans, digest of the rest."""
    for batch in batches:
        out = []
        for text, listed in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            text, digest, gone, spans = text or b"", hashlib.sha256(), 0, ()
            if listed:
                spans, kept = removed_spans([(s["at"], s["many"]) for s in listed], length), 0
                for a, b in spans.tolist():
                    digest.update(text[kept:a])
                    gone, kept = gone + b - a, b
                text = text[kept:]
            digest.update(text)
            out.append((gone, len(spans), digest.hexdigest(), [{"start": int(a), "end": int(b)} for a, b in spans]))
        gone, spans, digests, where = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("twin"), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string()),
             pa.array(where, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            names=["doc", "twin", "n_removed", "n_spans", "kept_sha256", "removed"],
        )


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: `doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`, `removed` (byte spans)."""
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    # any number of rows may lack an id: their twins have all bits
    known = F.col(id_col).cast("long").isNotNull()
    twin = F.when(known, F.pmod(F.xxhash64(data), F.lit(1 << 24))).otherwise(F.xxhash64(data))
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), twin.alias("twin"), data.alias("text"))
    # once through the texts: runs, the only large shuffle
    found = texts.mapInArrow(lambda it: runs(it, length), RUNS)
    in_bucket = Window.partitionBy("bucket")
    place = F.struct("doc", "twin", "at")
    of_run = Window.partitionBy("bucket", "run").orderBy("doc", "twin", "at")
    judged = (
        # dealt by bucket, rows serve both windows without another shuffle
        found.repartition("bucket")
        .withColumn("_first", F.first(place).over(of_run))
        .withColumn("_differ", F.min("run").over(in_bucket) != F.max("run").over(in_bucket))
        .withColumn("repeats", F.col("repeats") | (F.col("_first") != place))
        .where("repeats or _differ")
        .select("doc", "twin", "at", "many", (~F.col("repeats")).alias("refine"))
    )
    judged = materialize(judged)

    def by_text(runs_of: DataFrame) -> DataFrame:
        # as many entries as the text's own length allows
        return runs_of.groupBy("doc", "twin").agg(F.collect_set(F.struct("at", "many")).alias("runs"))

    to_refine = by_text(judged.where("refine").drop("refine"))
    strings = texts.join(to_refine, ["doc", "twin"]).mapInArrow(
        lambda it: single_strings(it, length), "doc long, twin long, at int, own long, repeats boolean"
    )
    in_order = Window.partitionBy("own").orderBy("doc", "twin", "at")
    repeated = strings.withColumn("_first", F.first(place).over(in_order)).where(F.col("repeats") | (F.col("_first") != place))
    singles = materialize(repeated.select("doc", "twin", "at", F.lit(1).alias("many")))
    gone = by_text(judged.where("not refine").select("doc", "twin", "at", "many").unionByName(singles))
    whole = texts.join(gone, ["doc", "twin"])
    changed = whole.mapInArrow(
        lambda it: cut(it, length),
        "doc long, twin long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,end:long>>",
    ).dropDuplicates(["doc", "twin"])
    sizes = texts.select("doc", "twin", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("_sha256"))
    zero = F.lit(0).cast("long")
    return sizes.join(changed, ["doc", "twin"], "left").select(
        F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"),
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "_sha256").alias("kept_sha256"),
        "removed",
    )
