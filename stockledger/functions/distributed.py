"""Exact statistics that stay distributed when one group holds much of the data.

* `frequency_profile`: mode, mean, deviation and range of a group from the histogram of its
  values. Both aggregations combine on the map side.
* `grouped_medians`: medians next to other aggregates. A mergeable sketch holds the middle of a group of few rows
  and brackets that of a larger one, whose rows are counted per slice; only the slices of the middle are sorted.
* `running_total`: a running sum over one global order without putting all rows in one task.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar, Token
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.functions.exprs import as_is, null_safe_join


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a scratch one only in local mode where none is named."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="stockledger-checkpoint-"))
    return context.getCheckpointDir()


class Scratch:
    """Owner of the tables written while it is entered; it deletes them when it is left.

    What is read after that must have been written elsewhere, with `keep`, or collected. Without an
    owner, tables stay in the shared folder until that is cleared, as checkpoints do.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        self._token = _owner.set(self)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        """Writes `df` as a table that outlives this owner; the one around it, if any, deletes it."""
        around = self._token.old_value
        token = _owner.set(None if around is Token.MISSING else around)
        try:
            return materialize(df)
        finally:
            _owner.reset(token)

    def __exit__(self, *_) -> None:
        _owner.reset(self._token)
        self.release()

    def release(self) -> None:
        """Deletes the tables through the file system they are in."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        while self.paths:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            path.getFileSystem(conf).delete(path, True)


_owner: ContextVar[Scratch | None] = ContextVar("owner of written tables", default=None)


def materialize(df: DataFrame) -> DataFrame:
    """Writes the rows as a table in the shared folder and reads them from there on.

    For frames that are read several times and must be the same each time, or are too dear to
    compute again; the files outlive lost executors, and readers take only the columns they need.
    Inside a `Scratch` the table is deleted with it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stockledger-{uuid.uuid4().hex}"
    owner = _owner.get()
    if owner is not None:
        owner.paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def frequency_profile(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """`mode`, `highest`, `mean`, `std` (sample, NULL below two values) and `lowest` per group.

    The mode is the smallest of the most frequent values; NULL counts as a value and comes first.
    Whole numbers are squared as decimals, so their deviation has no rounding before the root.
    """
    whole = isinstance(df.schema[value].dataType, T.IntegralType)
    exact = F.col(value).cast("decimal(18,0)" if whole else "double")
    hist = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_rows"), F.count(value).alias("_n"))
    sums = hist.groupBy(*keys).agg(
        F.min(F.struct(-F.col("_rows"), F.col(value).alias("v"))).getField("v").alias("mode"),
        F.max(value).alias("highest"),
        F.min(value).alias("lowest"),
        F.sum("_n").alias("_size"),
        F.sum(exact * F.col("_n")).alias("_sum"),
        F.sum(exact * exact * F.col("_n")).alias("_squares"),
    )
    size, total = F.col("_size"), F.col("_sum")
    kind = "decimal(38,0)" if whole else "double"
    spread = (size.cast(kind) * F.col("_squares").cast(kind) - total.cast(kind) * total.cast(kind)).cast("double")
    return sums.select(
        *keys,
        "mode",
        "highest",
        F.try_divide(total.cast("double"), size).alias("mean"),
        F.when(size > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (size.cast("double") * (size - 1)))).alias("std"),
        "lowest",
    )


SKETCH_ACCURACY = 10000
# Ten times the sketch's rank error to either side of the middle.
BRACKET = 10 / SKETCH_ACCURACY
SLICES = 1024
# A sketch leaves out nothing below half its accuracy in values; up to here 1 / SKETCH_ACCURACY above the middle is the next rank at most.
HELD_WHOLE = SKETCH_ACCURACY // 5


def grouped_medians(
    df: DataFrame,
    keys: list[str],
    medians: dict[str, str],
    aggs: list[Column] | None = None,
    keep: Callable[[DataFrame], DataFrame] = as_is,
) -> DataFrame:
    """`aggs` and the interpolated median of each column of `medians` (column -> name) per group.

    Without `keep`, nothing runs before the result is read. A mergeable sketch next to `aggs` holds every
    value of a group of up to `HELD_WHOLE`, and so both its middle ones. It brackets the middle of larger
    groups, of which there is at most one in `HELD_WHOLE` rows: their values are counted per slice of the
    bracket; running counts over a group's slices, of which there are a fixed number, carry the ranks over
    their ends, and only values of the slices that hold the middle are ranked. `keep` is applied to
    the groups, which are read for their brackets and for the result.
    """
    quantiles = [0.5 - BRACKET, 0.5, 0.5 + 1 / SKETCH_ACCURACY, 0.5 + BRACKET]
    sketches = []
    for column, name in medians.items():
        value = F.col(column).cast("double")
        sketches.append(F.percentile_approx(value, quantiles, SKETCH_ACCURACY).alias(f"_q_{name}"))
        sketches.append(F.count(column).alias(f"_n_{name}"))
    groups = keep(df.groupBy(*keys).agg(*(aggs or []), *sketches))
    found = _ranked_medians(df, groups, keys, medians).withColumnsRenamed({n: f"_m_{n}" for n in medians.values()})
    held = {
        n: F.when(F.col(f"_n_{n}") > HELD_WHOLE, F.col(f"_m_{n}")).otherwise((F.col(f"_q_{n}")[1] + F.col(f"_q_{n}")[2]) / 2)
        for n in medians.values()
    }
    spent = [f"_{kind}_{n}" for n in medians.values() for kind in ("q", "n", "m")]
    return null_safe_join(groups, F.broadcast(found), keys).withColumns(held).drop(*spent)


def _ranked_medians(df: DataFrame, groups: DataFrame, keys: list[str], medians: dict[str, str]) -> DataFrame:
    """The medians of those `groups` that the sketch does not hold whole, from counts within its bracket.

    The counts below and above the bracket come from the same rows, so ranks are exact whatever the
    sketch returned; a middle outside it is an error. Equal values are one row with their count.
    """

    def stacked(source: DataFrame, entries: list[Column]) -> DataFrame:
        return source.select(*keys, F.explode(F.array(*entries)).alias("m")).select(*keys, "m.*")

    values = stacked(
        df, [F.struct(F.lit(n).alias("metric"), F.col(c).cast("double").alias("v")) for c, n in medians.items()]
    ).where(F.col("v").isNotNull())
    large = reduce(lambda a, b: a | b, [F.col(f"_n_{n}") > HELD_WHOLE for n in medians.values()])
    brackets = stacked(
        groups.where(large),
        [
            F.when(
                F.col(f"_n_{n}") > HELD_WHOLE,
                F.struct(F.lit(n).alias("metric"), F.col(f"_q_{n}")[0].alias("low"), F.col(f"_q_{n}")[3].alias("high")),
            )
            for n in medians.values()
        ],
    ).where(F.col("low").isNotNull())
    by, v, low, high = [*keys, "metric"], F.col("v"), F.col("low"), F.col("high")
    # grows with the value, and so do the slices
    inside = F.coalesce(F.floor(F.try_divide(v - low, high - low) * SLICES), F.lit(0)).cast("int")
    place = F.when(v < low, -1).when(v > high, SLICES + 1).otherwise(inside)
    # sent to the values, so that those of the other groups are not shuffled
    counted = (
        null_safe_join(values, F.broadcast(brackets), by, "inner")
        .select(*by, place.alias("slice"), F.when((v >= low) & (v <= high), v).alias("v"))
        .groupBy(*by, "slice", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    group = Window.partitionBy(*by)
    upto = group.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = (
        counted.groupBy(*by, "slice")
        .agg(F.sum("n").alias("n"))
        .withColumns({"total": F.sum("n").over(group), "upto": F.sum("n").over(upto)})
        .select(*by, "slice", "total", (F.col("upto") - F.col("n")).alias("before"), "upto")
        # those from the one that holds the lower middle to the one that holds the upper middle
        .where((F.col("upto") * 2 >= F.col("total")) & (F.col("before") * 2 <= F.col("total")))
        .drop("upto")
    )
    within = Window.partitionBy(*by, "slice").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = null_safe_join(counted, slices, [*by, "slice"], "inner").withColumn("rank", F.col("before") + F.sum("n").over(within))
    lower, upper = F.col("rank") * 2 >= F.col("total"), F.col("rank") * 2 > F.col("total")

    def first(holds: Column) -> Column:
        return F.min(F.when(holds, F.struct("rank", "slice", "v")))

    missed = F.col("low.v").isNull() | F.col("high.v").isNull()
    outside = F.raise_error(F.lit("median outside its bracket"))
    middle = (F.col("low.v") + F.col("high.v")) / 2
    return (
        ranked.groupBy(*by)
        .agg(first(lower).alias("low"), first(upper).alias("high"))
        .select(*by, F.when(missed, outside).otherwise(middle).alias("median"))
        .groupBy(*keys)
        .agg(*[F.max(F.when(F.col("metric") == n, F.col("median"))).alias(n) for n in medians.values()])
    )


def running_total(df: DataFrame, order: list[Column], value: str, out: str, total: str, partitions: int | None = None) -> DataFrame:
    """Adds the running sum of `value` over the global `order` and the sum of all rows.

    Rows are range-partitioned on the whole order, so equal values still spread. The partition
    number must not change between its two uses, hence the checkpoint. One row per partition
    then carries the offset; each partition is summed on its own.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = materialize(df.repartitionByRange(n, *order).withColumn("_slice", F.spark_partition_id()))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slices.groupBy("_slice")
        .agg(F.sum(value).alias("_s"))
        .select(
            "_slice",
            F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"),
            F.sum("_s").over(Window.partitionBy()).alias(total),
        )
    )
    within = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most n rows on the broadcast side
    return (
        slices.join(F.broadcast(offsets), "_slice")
        .withColumn(out, F.col("_before") + F.sum(value).over(within))
        .drop("_slice", "_before")
    )
