"""Packing of tokenised documents into sequences, first-fit decreasing in randomised groups.

A document's ids end with an end token. Whole stretches of `capacity` ids are sequences of their own; the
rest is a piece. Every sixteenth document's rest is cut at the binary digits of its length, so that each
group has pieces of every power of two to fill gaps with. Pieces are dealt at random into groups of
about `GROUP_PIECES`. In a group, whole rests are placed first, then the cut ones, each by decreasing
length into the first sequence that has room; a tournament tree over the room left finds it. What the
cut pieces leave in the last sequence is divided into sequences of a power of two.

Words are tokenised once each while they stay in a worker's memory of `KNOWN_WORDS`: the tokenizer
drops white space and never joins what it parts, so ids of a text are those of its words in a row.
Only lengths and checksums are written and shuffled, no text and no ids. NULL and empty texts have the
end token only. A row is a document: repeated rows and rows without id are packed each for itself.
"""

from __future__ import annotations

import os
import re
import string
import struct
import sys
import zlib
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.functions.distributed import materialize
from stockledger.llm.common import ship

ship(__name__)

GROUP_PIECES = 8192
CUT_EVERY = 16
KNOWN_WORDS = 500_000
SLICE_BYTES = 1 << 18
OUT_ROWS = 8192
PARTS_AT_ONCE = 1000
GAP = re.compile(rb"[\x20\x09-\x0D]")
MARKS = bytes(set(range(0x21, 0x7F)) - set(b"'") - set(string.digits.encode()) - set(string.ascii_letters.encode()))
# letters that composition leaves alone and whose small form is the same whatever follows
OTHER_LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
# fixed value: how the tokenizer's vocabulary marks the last token of a part
END_OF_PART = "</w>"
PIECES = "row long, doc_id long, doc_tokens long, start long, length long, ids_crc32 long, cut boolean, sequence_id long"


class WordTokenizer:
    """Ids of texts as little-endian 32-bit numbers, remembered by word.

    Most words are letters with marks behind them. Such letters are a part of their own to the
    tokenizer, so they are remembered without case and marks, and many are encoded in one text; the
    tokens that end a part tell them apart again. All other words are encoded one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {b"": b""}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(END_OF_PART)]] = True

    def _one_by_one(self, words: list[bytes]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in (e.ids for e in encoded)]

    def _many(self, letters: list[bytes]) -> list[bytes]:
        out = []
        groups = [letters[at : at + PARTS_AT_ONCE] for at in range(0, len(letters), PARTS_AT_ONCE)]
        encoded = self.tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)
        for group, found in zip(groups, encoded):
            ids = np.array(found.ids, "<u4")
            cuts = [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
            data = ids.tobytes()
            if len(cuts) == len(group) + 1 and cuts[-1] == len(data):
                out += [data[a:b] for a, b in zip(cuts, cuts[1:])]
            else:
                out += self._one_by_one(group)
        return out

    def learn(self, words: list[bytes]) -> None:
        """Remembers `words`, and forgets the others where there are too many."""
        if len(self.known) + len(words) > KNOWN_WORDS:
            self.known.clear()
        if len(self.parts) > KNOWN_WORDS:
            self.parts = {b"": b""}
        known, parts = self.known, self.parts
        plain, other = [], []
        for w in words:
            front = w.rstrip(MARKS)
            if front.isalpha() or OTHER_LETTERS.fullmatch(front):
                plain.append(w)
            else:
                other.append(w)
        # lower case of these letters has as many bytes
        fronts = [w.rstrip(MARKS) for w in plain]
        letters = [f.lower() if f.isascii() else f.decode().lower().encode() for f in fronts]
        marks = [w[len(f) :] for w, f in zip(plain, fronts)]
        fresh = [x for x in dict.fromkeys(letters) if x not in parts]
        parts.update(zip(fresh, self._many(fresh)))
        fresh = [x for x in dict.fromkeys(marks) if x not in parts]
        parts.update(zip(fresh, self._one_by_one(fresh)))
        known.update(zip(plain, [parts[a] + parts[b] for a, b in zip(letters, marks)]))
        known.update(zip(other, self._one_by_one(other)))

    def _encode(self, slices: list[bytes]) -> list[bytes]:
        get = self.known.get
        split = [s.split() for s in slices]
        found = [list(map(get, words)) for words in split]
        holes = [[i for i, x in enumerate(ids) if x is None] if None in ids else [] for ids in found]
        missing = {words[i] for words, own in zip(split, holes) for i in own}
        if missing:
            self.learn(list(missing))
            for words, ids, own in zip(split, found, holes):
                for i in own:
                    ids[i] = self.known[words[i]]
        return [b"".join(ids) for ids in found]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of UTF-8 texts; new words are learned for many of them at once, long ones are cut at white space."""
        slices = []
        for nth, text in enumerate(texts):
            at = 0
            while at < len(text):
                gap = GAP.search(text, at + SLICE_BYTES) if len(text) - at > SLICE_BYTES else None
                end = gap.start() if gap else len(text)
                slices.append((nth, text[at:end]))
                at = end
        out: list[list[bytes]] = [[] for _ in texts]
        start = size = 0
        for i, (_, text) in enumerate(slices):
            size += len(text)
            if size >= SLICE_BYTES or i + 1 == len(slices):
                group = slices[start : i + 1]
                for (nth, _), ids in zip(group, self._encode([s for _, s in group])):
                    out[nth].append(ids)
                start, size = i + 1, 0
        return [b"".join(parts) for parts in out]


def worker_tokenizer(path: str) -> WordTokenizer:
    """The worker process's tokenizer with the words it knows; a worker serves many tasks."""
    store = sys.modules.setdefault("stockledger_words", ModuleType("stockledger_words")).__dict__
    if path not in store:
        store[path] = WordTokenizer(path)
    return store[path]


class RoomTree:
    """A tournament tree over the room left in sequences; a node knows the largest room below it."""

    def __init__(self, most: int, capacity: int):
        self.leaves = 1 << max(most - 1, 0).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """The first sequence with room for `length`, and the room it had; the room is taken."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < length:
                node += 1
        had = room[node]
        room[node] = had - length
        place = node - self.leaves
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
        return place, had


def first_fit_decreasing(lengths: np.ndarray, cut: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; cut pieces come last and are powers of two."""
    n = len(lengths)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    tree = RoomTree(n, capacity)
    for i in np.lexsort((-lengths, cut)).tolist():
        sequence[i], had = tree.place(int(lengths[i]))
        offset[i] = capacity - had
    last = np.flatnonzero(sequence == sequence.max(initial=0))
    if n and cut[last].all() and lengths[last].sum() < capacity:
        # decreasing powers of two at their offsets: a sequence ends where the next digit of the sum begins
        total, start, fresh = int(lengths[last].sum()), 0, int(sequence.max())
        for bit in range(total.bit_length() - 1, -1, -1):
            if total >> bit & 1:
                own = last[(offset[last] >= start) & (offset[last] < start + (1 << bit))]
                sequence[own] = fresh
                start, fresh = start + (1 << bit), fresh + 1
        for s in np.unique(sequence[last]):
            own = last[sequence[last] == s]
            offset[own] -= offset[own].min()
    return sequence, offset


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """The pieces of every document; whole stretches of `capacity` have their sequence already."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    schema = pa.schema(
        [(c, pa.bool_() if c == "cut" else pa.int64()) for c in ("row", "doc_id", "doc_tokens", "start", "length", "ids_crc32", "cut", "sequence_id")]
    )
    tail_id = np.array([end_id], "<u4").tobytes()

    def cut_up(batches):
        encoder = worker_tokenizer(tokenizer)
        task = TaskContext.get().partitionId() << 40
        nth = whole = piece = 0
        out = []
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                ids += tail_id
                tokens, start = len(ids) // 4, 0
                sizes = [capacity] * (tokens // capacity)
                rest = tokens % capacity
                cut = nth % CUT_EVERY == CUT_EVERY - 1
                sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1] if cut else [rest] * (rest > 0)
                for size in sizes:
                    sequence = None
                    if size == capacity:
                        whole += 1
                        sequence = -(task + whole)
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + size)])
                    out.append((task + piece, doc_id, tokens, start, size, crc, cut, sequence))
                    start, piece = start + size, piece + 1
                    if len(out) >= OUT_ROWS:
                        yield _batch(out, schema)
                        out = []
                nth += 1
        if out:
            yield _batch(out, schema)

    return rows.mapInArrow(cut_up, PIECES)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id`, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id`, `offset` of every piece.

    `capacity` is a power of two. `tokenizer` is the path of a tokenizer file that drops white space,
    readable on every executor. Ids of sequences are unique and have no order.
    """
    pieces = materialize(pieces_of(docs, tokenizer, capacity, end_id, id_col, text_col))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = pieces.where(F.col("sequence_id").isNotNull()).select(*columns, "sequence_id", F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("sequence_id").isNull())
    groups = -(-rest.count() // GROUP_PIECES) or 1
    dealt = rest.select(*columns, "row", "cut", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("part"))

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        lengths, cut = table["length"].to_numpy(), table["cut"].to_numpy()
        sequence, offset = first_fit_decreasing(lengths, cut, capacity)
        sequence += table["part"][0].as_py() << 32
        placed = table.select(columns)
        return placed.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = ", ".join(f"{c} long" for c in [*columns, "sequence_id", "offset"])
    return dealt.groupBy("part").applyInArrow(place, schema).unionByName(whole)
