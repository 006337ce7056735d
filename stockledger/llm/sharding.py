"""Shards of near-equal bytes by sampled splitters.

Records are ordered by a key: the hash of their text, so equal texts lie together, then a hash of
the whole row. Splitters come from a sample drawn with probability proportional to size; ranges
that turn out overfull, such as one text with many copies, are subdivided on the second part of
the key and on the number of a row among its equals. Exact sizes of all ranges then decide which neighbouring ranges make up a shard.

NULL text has no bytes and checksum 0; NULL ids and repeated rows are rows like any other, an
empty table gives an empty result, and extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockledger.functions.distributed import materialize
from stockledger.llm.common import row_hash, unit_interval

CELL_BITS = 12


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    overhead: int = 8,
    ranges_per_shard: int = 256,
    sample_per_range: int = 8,
) -> DataFrame:
    """One row per document: `doc_id`, `size`, `text_crc32`, `law`, `shard`, `slot`, `grown_shard`.

    `ranges_per_shard` bounds the error of a shard's bytes (one range at either end) and, with
    `sample_per_range`, the size of the sample; neither depends on the number of rows.
    """
    text = F.col(text_col)
    records = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + overhead).alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            row_hash(text).alias("_key"),
            row_hash(id_col, text).alias("_tie"),
            F.spark_partition_id().alias("_part"),
        )
    )
    records = _numbered(records)
    total = records.agg(F.sum("size")).first()[0] or 0
    ranges = shards * ranges_per_shard
    ranged = _with_range(records, _splitters(records, total, ranges, ranges * sample_per_range))
    fair = max(1.0, total / ranges)
    full = ranged.groupBy("_range").agg(F.sum("size").alias("_bytes"))
    # one row per range, and their number is a parameter; so is that of the units below, give or take the pieces
    pieces = full.select("_range", F.ceil(F.col("_bytes") / (2 * fair)).alias("_pieces"))
    units = ranged.join(F.broadcast(pieces), "_range").withColumn(
        "_piece", F.when(F.col("_pieces") > 1, F.pmod(F.xxhash64("_tie") + F.col("_equal"), F.col("_pieces"))).otherwise(F.lit(0))
    )
    in_order = Window.orderBy("_range", "_piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        units.groupBy("_range", "_piece")
        .agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_bytes").over(in_order), F.lit(0)))
        .withColumn(
            "shard",
            F.least(F.floor((F.col("_before") + F.col("_bytes") / 2) * shards / max(total, 1)), F.lit(shards - 1)).cast("int"),
        )
    )
    in_shard = Window.partitionBy("shard").orderBy("_range", "_piece").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.select(
        "_range", "_piece", "shard", F.coalesce(F.sum("_rows").over(in_shard), F.lit(0)).alias("_first")
    )
    in_unit = Window.partitionBy("_range", "_piece").orderBy("_key", "_tie", "_equal")
    return (
        units.withColumn("_nth", F.row_number().over(in_unit))
        .join(F.broadcast(first), ["_range", "_piece"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("_first") + F.col("_nth") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def _numbered(records: DataFrame) -> DataFrame:
    """Adds `_equal`, the number of a row among its equals, which the rows of a partition have in a row.

    Equal rows have one hash, so only their numbers can divide them; no task gets more of them than
    one partition holds.
    """
    parts = records.groupBy("_tie", "_part").agg(F.count(F.lit(1)).alias("_many"))
    earlier = Window.partitionBy("_tie").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("_tie", "_part", F.coalesce(F.sum("_many").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_tie", "_part").orderBy("_key")
    return (
        records.withColumn("_nth", F.row_number().over(within))
        .join(before, ["_tie", "_part"])
        .withColumn("_equal", F.col("_before") + F.col("_nth") - 1)
        .drop("_part", "_before", "_nth")
    )


def _splitters(records: DataFrame, total: int, ranges: int, sample: int) -> list[int]:
    """At most `ranges` - 1 keys that cut the bytes of a sample into equal parts.

    A record larger than total / sample is certain to be drawn and counts by its size.
    """
    if not total:
        return []
    share = F.col("size") * F.lit(sample / total)
    drawn = records.where(unit_interval(F.xxhash64("_tie", F.lit("splitter"))) < share).select(
        "_key", F.greatest(F.round(share), F.lit(1)).cast("long").alias("_weight")
    )
    cuts = [i / ranges for i in range(1, ranges)]
    row = drawn.agg(F.percentile("_key", F.lit(cuts), F.col("_weight")).alias("cuts")).first()
    return sorted({int(x) for x in row["cuts"] or []})


def _with_range(records: DataFrame, splitters: list[int]) -> DataFrame:
    """Adds `_range`, the number of splitters not above the key.

    The key's first bits pick a cell; the cell knows how many splitters lie before it and which
    lie in it, so each record is compared with a handful of them.
    """
    spark = records.sparkSession
    cells, width = 1 << CELL_BITS, 1 << (64 - CELL_BITS)
    known = F.lit(splitters) if splitters else F.array().cast("array<bigint>")
    low = (F.col("id") - cells // 2) * F.lit(width)
    cell_table = spark.range(cells).select(
        (F.col("id") - cells // 2).alias("_cell"), F.transform(F.array(low), lambda x: x)[0].alias("_low"), known.alias("_known")
    )
    cell_table = cell_table.select(
        "_cell",
        F.size(F.filter("_known", lambda b: b < F.col("_low"))).alias("_base"),
        F.filter("_known", lambda b: F.shiftright(b, 64 - CELL_BITS) == F.col("_cell")).alias("_in_cell"),
    )
    # the cells and splitters are fixed in number, whatever the table's size
    return (
        records.withColumn("_cell", F.shiftright("_key", 64 - CELL_BITS))
        .join(F.broadcast(cell_table), "_cell")
        .withColumn("_range", F.col("_base") + F.size(F.filter("_in_cell", lambda b: b <= F.col("_key"))))
        .drop("_cell", "_base", "_in_cell")
    )
