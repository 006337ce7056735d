"""Mixing sources to target weights by drawing fixed-length blocks.

Each source's words, its documents in hash order, form one stream that is cut into blocks of
`block_words`. Every output shard draws its sources by a multinomial draw conditioned on the
sources' totals: all slots of the mix are one deck that a pseudorandom permutation deals out to
the shards, so a shard's counts vary as a draw does while the totals come out exact. The slots of
a source are mapped to its blocks through a permutation of its own, a new one for each pass over
the source, and blocks are joined to documents by their index.

The permutations are swap-or-not shuffles: bijections on any number of items, computed per item.

Documents without words have size 0 and are in no block; NULL sources are one source, the last in
order. Repeated rows are rows of their own, extra columns are ignored, empty tables give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.functions.distributed import Scratch, materialize
from stockledger.llm.common import WORD, row_hash, same

WEIGHTS = (5, 2, 1)
ROUNDS = 10
BUCKETS = 1024
CHUNK = 1 << 14


def permuted(x: Column, n: Column, seed: Column, rounds: int = ROUNDS) -> Column:
    """The place of item `x` of 0..n-1 in a pseudorandom permutation of them."""

    def swap(y: Column, r: Column) -> Column:
        mirrored = F.pmod(F.pmod(F.xxhash64(seed, r), n) - y, n)
        side = F.xxhash64(seed, r, F.greatest(y, mirrored)).bitwiseAND(F.lit(1).cast("long"))
        return F.when(side == 1, mirrored).otherwise(y)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x.cast("long"), swap)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, repeat: float = 2.0) -> DataFrame:
    """Target words per source from (`source`, `source_size`).

    Weights go round by code point of the source's name, NULL last. What is over `repeat` times a
    source's size goes to the others by weight; the level at which that settles has a closed form
    over the sources in the order in which they fill up. One row per source passes one task.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    listed = sizes.withColumn("_nth", F.row_number().over(named)).withColumn(
        "_weight", F.element_at(F.lit(list(weights)), (F.pmod(F.col("_nth") - 1, F.lit(len(weights))) + 1).cast("int")).cast("double")
    )
    filling = Window.orderBy("_fills_at", "_nth")
    cap = F.col("source_size") * F.lit(float(repeat))
    levels = (
        listed.withColumn("_cap", cap)
        .withColumn("_fills_at", F.col("_cap") / F.col("_weight"))
        .withColumn("_filled", F.coalesce(F.sum("_cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("_open", F.sum("_weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("_all", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
        .withColumn("_level", (F.col("_all") - F.col("_filled")) / F.col("_open"))
    )
    level = F.max(F.when(F.col("_level") <= F.col("_fills_at"), F.col("_level"))).over(Window.partitionBy())
    return levels.withColumn("_settled", level).select(
        "source",
        "source_size",
        F.coalesce(F.least("_cap", F.col("_settled") * F.col("_weight")), F.col("_cap")).alias("target"),
        F.col("_nth").alias("source_nth"),
    )


class Mix:
    """A mix of documents: its sources, the slots of its output shards and what it takes of each document."""

    def __init__(
        self,
        docs: DataFrame,
        id_col: str = "doc_id",
        text_col: str = "text",
        source_col: str = "source",
        weights=WEIGHTS,
        share: float = 1.5,
        repeat: int = 2,
        block_words: int = 32,
        shard_slots: int = 65536,
        seed: int = 7,
    ):
        self.block_words, self.shard_slots, self.seed = block_words, shard_slots, seed
        rows = materialize(
            docs.select(
                F.col(id_col).alias("doc_id"),
                F.col(source_col).alias("source"),
                word_count(F.col(text_col)).alias("size"),
                row_hash(id_col, text_col).alias("row_key"),
            )
        )
        targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeat)
        blocks = F.ceil(F.col("source_size") / block_words)
        wanted = F.round(F.try_divide(F.col("target") * blocks, F.col("source_size")))
        slots = F.coalesce(F.least(wanted.cast("long"), blocks * repeat), F.lit(0)).cast("long")
        before = Window.orderBy("source_nth").rowsBetween(Window.unboundedPreceding, -1)
        self.sources = materialize(
            targets.withColumn("blocks", blocks.cast("long"))
            .withColumn("slots", slots)
            .withColumn("first_slot", F.coalesce(F.sum("slots").over(before), F.lit(0)))
        )
        self.rows = self._in_stream(rows)

    def _in_stream(self, rows: DataFrame) -> DataFrame:
        """Adds the word position at which each document begins in its source's stream.

        Buckets by hash split a source of any size; their sums give the offsets.
        """
        sources = self.sources.withColumnRenamed("source", "_source")
        known = rows.join(sources, same(F.col("source"), F.col("_source")), "left").drop("_source")
        known = known.withColumn("_bucket", F.pmod("row_key", F.lit(BUCKETS)))
        ahead = Window.partitionBy("source_nth").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (
            known.groupBy("source_nth", "_bucket")
            .agg(F.sum("size").alias("_words"))
            .select("source_nth", "_bucket", F.coalesce(F.sum("_words").over(ahead), F.lit(0)).alias("_offset"))
        )
        inside = (
            Window.partitionBy("source_nth", "_bucket")
            .orderBy("row_key", "doc_id")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return (
            known.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(offsets, ["source_nth", "_bucket"])
            .withColumn("start", F.col("_offset") + F.col("_inside"))
            .drop("_bucket", "_offset", "_inside")
        )

    def slots(self) -> DataFrame:
        """One row per slot of the mix: `shard`, `slot`, `source`, `source_nth`, `block`."""
        total = self.sources.agg(F.sum("slots")).first()[0] or 0
        chunked = self.sources.where("slots > 0").select(
            "source", "source_nth", "blocks", "slots", "first_slot",
            F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK))).alias("_chunk"),
        )
        partitions = int(chunked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        nth = F.explode(
            F.sequence(F.col("_chunk") * CHUNK, F.least((F.col("_chunk") + 1) * CHUNK, F.col("slots")) - 1)
        )
        drawn = chunked.repartition(partitions, "source_nth", "_chunk").withColumn("_nth", nth)
        in_pass, passed = F.pmod(F.col("_nth"), F.col("blocks")), F.floor(F.col("_nth") / F.col("blocks"))
        own = F.xxhash64(F.lit(self.seed), F.lit("blocks"), "source", passed)
        deck = F.xxhash64(F.lit(self.seed), F.lit("deck"))
        return (
            drawn.withColumn("_dealt", permuted(F.col("first_slot") + F.col("_nth"), F.lit(total).cast("long"), deck))
            .withColumn("block", permuted(in_pass, F.col("blocks"), own))
            .select(
                F.floor(F.col("_dealt") / self.shard_slots).alias("shard"),
                F.pmod(F.col("_dealt"), F.lit(self.shard_slots)).alias("slot"),
                "source",
                "source_nth",
                "block",
            )
        )

    def uses(self) -> DataFrame:
        """How often the mix holds each block it holds: `source_nth`, `block`, `uses`.

        Spark takes the exploded slots for as small as the sources; joins must be told not to send them.
        """
        return self.slots().groupBy("source_nth", "block").agg(F.count(F.lit(1)).alias("uses"))

    def taken(self) -> DataFrame:
        """One row per document with the words that the mix takes of it, repeats counted."""
        n = F.lit(self.block_words)
        end = F.col("start") + F.col("size")
        over = F.sequence(F.floor(F.col("start") / n), F.floor((end - 1) / n))
        overlap = F.least(end, (F.col("block") + 1) * n) - F.greatest(F.col("start"), F.col("block") * n)
        spoken = (
            self.rows.where("size > 0")
            .withColumn("block", F.explode(over))
            .join(self.uses().hint("merge"), ["source_nth", "block"], "left")
            .groupBy("doc_id", "row_key", "source", "source_nth", "start", "size", "source_size", "target")
            .agg(F.coalesce(F.sum(overlap * F.coalesce("uses", F.lit(0))), F.lit(0)).cast("long").alias("taken"))
            .drop("source_nth", "start", "row_key")
        )
        # rows without words share their start with their equals, and are not grouped
        silent = self.rows.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
        return spoken.unionByName(silent.select(*spoken.columns))

    def copies(self) -> DataFrame:
        """How many copies of each whole document a mix of documents holds: `doc_id`, `row_key`, `source`, `copies`.

        A document goes with the block in which it begins, so a source's expected words are its
        target's. Without words it is in no block and stays once.
        """
        return (
            self.rows.withColumn("block", F.floor(F.col("start") / F.lit(self.block_words)))
            .join(self.uses().hint("merge"), ["source_nth", "block"], "left")
            .select("doc_id", "row_key", "source", F.when(F.col("size") == 0, 1).otherwise(F.coalesce("uses", F.lit(0))).alias("copies"))
        )


def mixed_words(docs: DataFrame, **options) -> DataFrame:
    """`doc_id`, `source`, `size`, `source_size`, `target`, `taken` of every document."""
    return Mix(docs, **options).taken()


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents, whole, as often as the mix holds them; all columns are kept.

    Equal rows (of one id, text and source) share the copies that the mix holds of all of them as
    evenly as whole copies go, so sources have the words that their blocks give them.
    """
    id_col, text_col, source_col = (options.get(f"{c}_col", n) for c, n in (("id", "doc_id"), ("text", "text"), ("source", "source")))
    with Scratch(docs.sparkSession) as scratch:
        often = Mix(docs, **options).copies().groupBy(row_hash("row_key", "source").alias("_pick"))
        often = scratch.keep(often.agg(F.count(F.lit(1)).alias("_rows"), F.sum("copies").alias("_copies")).where("_copies > 0"))
        # a table of its own, so that Spark knows how few they are
        several = scratch.keep(often.where("_rows > 1"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(row, row_hash(row_hash(id_col, text_col), source_col).alias("_pick"))
    single = keyed.join(often.where("_rows = 1"), "_pick").select("_row", "_copies")
    equals = _share_out(keyed.join(several, "_pick"))
    return (
        single.unionByName(equals)
        .select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"))
        .select("_row.*")
    )


def _share_out(rows: DataFrame) -> DataFrame:
    """`_row` and its part of the `_copies` of its `_rows` equals; rows are numbered within their partition after those of earlier ones."""
    rows = materialize(rows.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()))
    parts = rows.groupBy("_pick", "_part").agg(F.count(F.lit(1)).alias("_many"))
    earlier = Window.partitionBy("_pick").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("_pick", "_part", F.coalesce(F.sum("_many").over(earlier), F.lit(0)).alias("_before"))
    # numbers are found without the texts
    inside = F.row_number().over(Window.partitionBy("_pick", "_part").orderBy("_id"))
    nth = rows.select("_id", "_pick", "_part", "_rows", "_copies", inside.alias("_inside")).join(before, ["_pick", "_part"])
    upto = F.col("_before") + F.col("_inside")
    part = F.floor(upto * F.col("_copies") / F.col("_rows")) - F.floor((upto - 1) * F.col("_copies") / F.col("_rows"))
    shared = nth.select("_id", part.cast("long").alias("_part_of")).where("_part_of > 0")
    return rows.select("_id", "_row").join(shared, "_id").select("_row", F.col("_part_of").alias("_copies"))
