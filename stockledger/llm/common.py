"""Column expressions and small helpers shared by the text operators."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_hash(*columns: str | Column) -> Column:
    """A 64-bit hash of the columns; NULLs count by their position, unlike in a plain hash."""
    return F.xxhash64(*[x for c in columns for x in (F.isnull(c), c)])


def unit_interval(hashed: Column) -> Column:
    """A hash as a double in [0, 1)."""
    return F.shiftrightunsigned(hashed, 11).cast("double") / F.lit(float(1 << 53))


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def ship(module: str) -> None:
    """Sends what a module defines to the Python workers by value, so that they need no copy of this library."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
