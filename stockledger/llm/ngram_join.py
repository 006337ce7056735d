"""Documents whose word shingles have a Jaccard similarity of at least a threshold, joined exactly.

A token-group matrix decides what is compared. Documents with equal sets are one class. Classes
are partitioned into groups of similar ones, of bounded size; the matrix holds, for each group, the
union of its members' tokens (hashed to a fixed number of columns). The overlap of a query with a
group's union bounds its similarity with every member, and only groups whose bound reaches the
threshold are opened, that is, compared member by member on the whole sets.

Which (query, group) cells of the matrix are looked at is decided by signatures, without loss. Two
sets of sizes a and b that link differ in at most d = (a + b)(1 - t)/(1 + t) tokens. Tokens are hashed
into parts; a differing token changes one part, so among the first d + 1 non-empty parts of a set,
in one global order, one is the same in both. Two orders are used in turn. The first prefers parts
with many tokens, which chance or a shared passage seldom make equal; the first d + 1 + e parts in it are
a set's own, and of two sets that link e + 1 are the same. The second order is by how many rows own a
part: of its own parts a set leaves out the e most frequent, and one is still the same in both. What
a passage or a pattern makes common to many sets that do not link is left out first. The number of parts
doubles with the size of the sets, and e is the same for all sets of a size range; a set near the upper end
of its range gives signatures for the next range as well. Sets below `SMALL_SET` tokens have one
part per token. Shingles, parts and sets are known by 64-bit hashes; of a signature's, 48 bits are written
and shuffled, which is the most there is of anything here. Parts that these take for the same are compared in vain.

Similar documents are found in two steps. First each class is compared with one class of every
signature it has, the smallest, then the one with most links, which joins most of a family of
any size in about as many comparisons as it has members. What components still share signatures is
then looked up group by group in the matrix. Links only ever join components, so comparisons inside
one are left out.

A text without words, or NULL, has no set and links with nothing. Rows with the same text are one
class, whatever their ids; a component's id is the smallest id in it that is not NULL.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.functions.distributed import Scratch, materialize
from stockledger.llm.common import row_hash, ship
from stockledger.llm.graph import connected_components

ship(__name__)

SMALL_SET = 16
MATRIX_WORDS = 8
GROUP_ROWS = 48
LEADER_ROUNDS = 1
SMALL_EXTRA = 4
EXTRA = 0.4  # of the tokens that two sets at the upper end of a range may differ in
FILTER_BITS = 24
DROPPED_BITS = np.uint64(16)  # of a signature's hash
CACHED_WORDS = 1 << 20
BITS = [f"bits{i}" for i in range(MATRIX_WORDS)]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


def shingle_set(text: bytes | None, words: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of `words` words; of all words together if there are fewer."""
    found = (text or b"").lower().split()  # bytes: A-Z only, and ASCII white space
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    run = min(words, len(h))
    total = np.full(len(h) - run + 1, run, np.uint64)
    for i in range(run):
        total = mixed(total + h[i : len(h) - run + 1 + i])
    return np.unique(total)


def most_different(n: int, percent: int) -> int:
    """In how many tokens a set of n differs from one it links with, at most."""
    return (n + n * 100 // percent) * (100 - percent) // (100 + percent)


def _level(n: int) -> int:
    return (n // SMALL_SET).bit_length() - 1


def owned_parts(tokens: np.ndarray, percent: int) -> list[tuple[int, np.ndarray]]:
    """Per size range: how many parts a set may leave out in the second order, and the parts it owns."""
    n = len(tokens)
    needed = most_different(n, percent) + 1
    partner = n * 100 // percent
    out = [(max(0, min(n - needed, SMALL_EXTRA)), mixed(tokens[: needed + SMALL_EXTRA]))] if n < SMALL_SET else []
    for level in {_level(n), _level(partner)} if partner >= SMALL_SET else ():
        if level < 0:
            continue
        # room for `needed` non-empty parts at either end of the range, but for odds below 1e-8
        most = most_different(SMALL_SET * 2 ** (level + 1), percent)
        parts, extra = int(most * 1.28) + 8, int(most * EXTRA) + SMALL_EXTRA
        part = ((tokens >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        held = np.diff(np.r_[starts, n])
        content = mixed(np.add.reduceat(mixed(tokens + np.uint64(level + 1)), starts) + part[starts])
        own = content[np.lexsort((content, -held))[: needed + extra]]
        out.append((max(0, len(own) - needed), own))
    return out


def signatures(tokens: np.ndarray, percent: int) -> np.ndarray:
    """All parts a set owns."""
    return np.concatenate([own for _, own in owned_parts(tokens, percent)])


def describe(batches, words: int, percent: int):
    """Per row: set size, class, the set's bits in the matrix, signatures per size range."""
    known = WordHashes()
    for batch in batches:
        sizes, classes, bits, signed = [], [], [], []
        spare, ranges, ends = [], [0], [0]
        for text in batch.column("text").to_pylist():
            tokens = shingle_set(text, words, known)
            sizes.append(len(tokens))
            if not len(tokens):
                classes.append(None)
                bits.append([0] * MATRIX_WORDS)
                ranges.append(len(spare))
                continue
            classes.append(mixed(mixed(tokens).sum(keepdims=True) + np.uint64(len(tokens))).view(np.int64)[0])
            column = tokens % np.uint64(64 * MATRIX_WORDS)
            row = np.zeros(MATRIX_WORDS, np.uint64)
            np.bitwise_or.at(row, (column >> np.uint64(6)).astype(int), np.uint64(1) << (column & np.uint64(63)))
            bits.append(row.view(np.int64))
            for left_out, own in owned_parts(tokens, percent):
                spare.append(left_out)
                signed.append((own >> DROPPED_BITS).view(np.int64))
                ends.append(ends[-1] + len(own))
            ranges.append(len(spare))
        values = pa.array(np.concatenate(signed) if signed else np.zeros(0, np.int64))
        own = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        by_range = pa.StructArray.from_arrays([pa.array(spare, pa.int32()), own], ["spare", "own"])
        matrix = np.array(bits, np.int64).reshape(len(bits), MATRIX_WORDS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_key"), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64())]
            + [pa.array(matrix[:, i]) for i in range(MATRIX_WORDS)]
            + [pa.ListArray.from_arrays(pa.array(ranges, pa.int32()), by_range)],
            names=["doc_id", "row_key", "n", "cls", *BITS, "signed"],
        )


def whole_sets(batches, words: int, wanted: np.ndarray):
    """(row key, set) of the rows that may be wanted: a filter of fixed size lets some others through."""
    known = WordHashes()
    for batch in batches:
        place = batch.column("place").to_numpy()
        passed = np.flatnonzero((wanted[place >> 6] >> (place & 63)) & 1)
        if not len(passed):
            continue
        rows = batch.take(pa.array(passed))
        sets = [shingle_set(t, words, known) for t in rows.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [rows.column("row_key"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["row_key", "tokens"]
        )


def _absent(a: str, b: str) -> Column:
    """How many matrix columns of `a` are not in `b`, a lower bound of its tokens that `b` lacks."""
    return sum((F.bit_count(F.col(f"{a}.{c}").bitwiseAND(F.bitwise_not(f"{b}.{c}"))) for c in BITS[1:]),
               F.bit_count(F.col(f"{a}.{BITS[0]}").bitwiseAND(F.bitwise_not(f"{b}.{BITS[0]}"))))


def _led(at_issue: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs of each signature's best linked class with its classes in other components."""
    ends = links.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count(F.lit(1)).alias("links"))
    ranked = at_issue.join(ends, "cls", "left").select("sig", "cls", "component", F.coalesce("links", F.lit(0)).alias("links"))
    lead = ranked.groupBy("sig").agg(F.max_by(F.struct("cls", "component"), F.struct("links", F.xxhash64("cls"))).alias("lead"))
    met = at_issue.join(lead, "sig").where(F.col("component") != F.col("lead.component"))
    return met.select(F.col("lead.cls").alias("a"), F.col("cls").alias("b"))


class NgramJoin:
    """The join over one table of documents; `members` and `links` are its results."""

    def __init__(self, docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"):
        if not 80 <= percent <= 100:
            raise ValueError("signatures are laid out for thresholds from 80 to 100 percent")
        self.words, self.percent = words, percent
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), row_hash(id_col, text_col).alias("row_key"))
        bits = ", ".join(f"{c} long" for c in BITS)
        self.rows = materialize(
            self.docs.mapInArrow(
                lambda it: describe(it, words, percent), f"doc_id long, row_key long, n long, cls long, {bits}, signed array<struct<spare:int,own:array<long>>>"
            )
        )
        described = [F.first(c).alias(c) for c in ("n", *BITS)]
        self.classes = materialize(
            self.rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.min("row_key").alias("row_key"), *described)
        )

    def _pair_may_link(self, a: str, b: str) -> Column:
        """The bound for two sets: the matrix columns they differ in, against what a link allows."""
        size = F.col(f"{a}.n") + F.col(f"{b}.n")
        return (_absent(a, b) + _absent(b, a)) * (100 + self.percent) <= size * (100 - self.percent)

    def _shared(self) -> DataFrame:
        """(`sig`, `cls`, `lead`) for signatures of several classes, `lead` being the smallest.

        What classes own is shuffled once, and counted next to its rows. Parts of one class come before all
        others in the second order, so those left out are among the rest.
        """
        ranges = self.rows.select("cls", F.posexplode("signed").alias("range", "_s"))
        signed = ranges.select("cls", "range", "_s.spare", F.explode("_s.own").alias("sig"))
        by_sig = Window.partitionBy("sig")
        counts = {"_first": F.min("cls").over(by_sig), "_last": F.max("cls").over(by_sig), "_rows": F.count(F.lit(1)).over(by_sig)}
        owned = signed.withColumns(counts).where("_first < _last").drop("_first", "_last").distinct()
        falling = Window.partitionBy("cls", "range").orderBy(F.desc("_rows"), F.desc("sig"))
        kept = owned.withColumn("_place", F.row_number().over(falling)).where("_place > spare").select("sig", "cls")
        leads = {"lead": F.min("cls").over(by_sig), "_last": F.max("cls").over(by_sig)}
        return materialize(kept.withColumns(leads).where("lead < _last").drop("_last"))

    def _sets(self, classes: DataFrame) -> DataFrame:
        """(`cls`, `tokens`) of the given classes, from the text of one document of each, known by id and text."""
        reps = classes.join(self.classes.select("cls", "row_key"), "cls")
        place = F.pmod(F.xxhash64("row_key"), F.lit(1 << FILTER_BITS))
        words = reps.select(place.alias("p")).groupBy(F.floor(F.col("p") / 64).alias("w")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(pmod(p, 64) AS int))")).alias("b")
        )
        wanted = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        for r in words.toLocalIterator():  # 2 MB in all, whatever the number of classes
            wanted[r["w"]] = r["b"]
        n = self.words
        sets = self.docs.drop("doc_id").withColumn("place", place).mapInArrow(
            lambda it: whole_sets(it, n, wanted), "row_key long, tokens array<long>"
        )
        kept = reps.join(sets, "row_key").groupBy("cls").agg(F.first("tokens").alias("tokens"))
        return materialize(kept)

    def _verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Those of the pairs (`a`, `b`) whose whole sets reach the threshold."""
        left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("_x"))
        right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("_y"))
        both = F.size(F.array_intersect("_x", "_y"))
        return (
            pairs.join(right, "b").join(left, "a")
            .where(both * 100 >= (F.size("_x") + F.size("_y") - both) * self.percent)
            .select("a", "b")
        )

    def components(self) -> DataFrame:
        """`cls`, `component` of the classes that link with another one."""
        shared = self._shared()
        nodes = self.classes.select("cls", "n", *BITS)
        sets = self._sets(shared.select("cls").distinct())
        star = shared.where("cls <> lead").select(F.col("lead").alias("a"), F.col("cls").alias("b"))
        links = materialize(self._verified(self._possible(star, nodes), sets))
        found = connected_components(links)
        for _ in range(LEADER_ROUNDS):
            at_issue = self._at_issue(shared, found)
            links = materialize(links.unionByName(self._verified(self._possible(_led(at_issue, links), nodes), sets)))
            found = connected_components(links)
        opened = materialize(self._opened(self._at_issue(shared, found), nodes))
        links = links.unionByName(materialize(self._verified(opened, sets)))
        return connected_components(links).select(F.col("node").alias("cls"), "component")

    def _possible(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """The pairs that the matrix does not rule out."""
        known = pairs.distinct().join(nodes.select(F.struct("*").alias("x")), F.col("a") == F.col("x.cls"))
        known = known.join(nodes.select(F.struct("*").alias("y")), F.col("b") == F.col("y.cls"))
        return materialize(known.where(self._pair_may_link("x", "y")).select("a", "b"))

    def _at_issue(self, shared: DataFrame, components: DataFrame) -> DataFrame:
        """(`sig`, `cls`, `component`) for the signatures that several components share."""
        of_class = shared.select("cls").distinct().join(components.withColumnRenamed("node", "cls"), "cls", "left")
        signed = shared.select("sig", "cls").join(of_class, "cls").withColumn("component", F.coalesce("component", "cls"))
        by_sig = Window.partitionBy("sig")
        ends = {"_x": F.min("component").over(by_sig), "_y": F.max("component").over(by_sig)}
        return materialize(signed.withColumns(ends).where("_x < _y").drop("_x", "_y"))

    def _opened(self, at_issue: DataFrame, nodes: DataFrame) -> DataFrame:
        """Pairs (`a`, `b`) of a query and a member of a group it opens."""
        placed = at_issue.select("cls", "component").distinct()
        counts = placed.groupBy("component").agg(F.count(F.lit(1)).alias("many"))
        grp = F.xxhash64("component", F.pmod(F.xxhash64("cls"), F.ceil(F.col("many") / GROUP_ROWS)))
        members = materialize(placed.join(counts, "component").withColumn("grp", grp).join(nodes, "cls"))
        matrix = members.groupBy("grp").agg(
            F.first("component").alias("component"), F.first("many").alias("many"),
            F.min("n").alias("least"), F.max("n").alias("most"), *[F.bit_or(c).alias(c) for c in BITS],
            F.struct(*[F.bit_and(c).alias(c) for c in BITS]).alias("all"),
        )
        cells = at_issue.join(members.select("cls", "grp"), "cls").select("sig", "grp").distinct()
        groups = cells.join(matrix, "grp").select("sig", F.struct(*[c for c in matrix.columns if c != "all"]).alias("g"), "all")
        queries = at_issue.select("sig", "cls").join(members, "cls").select("sig", F.struct(*members.columns).alias("q"))
        n, p = F.col("q.n"), self.percent
        smaller = F.struct("q.many", "q.component") < F.struct("g.many", "g.component")
        in_reach = (n * 100 >= F.col("g.least") * p) & (F.col("g.most") * 100 >= n * p)
        # what the query has and no member, and what every member has and the query not
        bound = (_absent("q", "g") * 100 <= n * (100 - p)) & (
            (_absent("q", "g") + _absent("all", "q")) * (100 + p) <= (n + F.col("g.most")) * (100 - p)
        )
        cells = queries.join(groups, "sig").where(smaller & in_reach & bound).select(F.col("q.cls").alias("a"), F.col("g.grp").alias("grp")).distinct()
        # the query's columns come first, so that the bound is part of the join with the members
        pairs = (
            cells.join(nodes.select(F.col("cls").alias("a"), F.struct("n", *BITS).alias("x")), "a")
            .join(members.select("grp", F.struct("cls", "n", *BITS).alias("y")), "grp")
            .where(self._pair_may_link("x", "y"))
        )
        return pairs.select("a", F.col("y.cls").alias("b"))

    def members(self) -> DataFrame:
        """One row per document: `doc_id`, `n_shingles`, `component_id`."""
        linked = self.components()
        named = self.classes.join(linked, "cls", "left").select("cls", F.coalesce("component", "cls").alias("component"), "rep")
        # every class once; components of any size combine before they are shuffled
        ids = named.groupBy("component").agg(F.min("rep").alias("component_id"))
        of_class = named.join(ids, "component").select("cls", "component_id")
        return self.rows.select("doc_id", "n", "cls").join(of_class, "cls", "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
        )


    def representatives(self) -> DataFrame:
        """`row_key` of one document per component, the one with the smallest id, and of those without words."""
        first = F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "row_key"))
        of_class = self.rows.where("cls is not null").groupBy("cls").agg(first.alias("first"))
        named = of_class.join(self.components(), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        kept = named.groupBy("component").agg(F.min("first").alias("first")).select("first.row_key")
        return kept.unionByName(self.rows.where("cls is null").select("row_key").distinct())


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, with all its columns; equal rows stay once."""
    with Scratch(docs.sparkSession) as scratch:  # sets and signatures go once the choice is written
        kept = scratch.keep(NgramJoin(docs, words, percent, id_col, text_col).representatives())
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), row_hash(id_col, text_col).alias("row_key"))
    return keyed.join(kept, "row_key").dropDuplicates(["row_key"]).select("_row.*")


def similar_documents(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_shingles` and `component_id` (the smallest id reachable by links) of every document."""
    return NgramJoin(docs, words, percent, id_col, text_col).members()
