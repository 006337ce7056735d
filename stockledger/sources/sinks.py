"""Writing reports: one folder per report, one dataset per table, published together.

A job writes its tables in a folder of the run's own. When all are written, one append to the log of
publications makes them the current ones; a reader goes by the log. A run that fails leaves
no entry, so what was published before stays whole, and a run that is repeated overwrites nothing.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def safe_text(text: str) -> str:
    """Replaces what a path must not contain."""
    return re.sub(r'[<>:"/\\|?*]+', "-", str(text))


def period_name(start: str, end: str | None = None) -> str:
    """`<start>_<end>`; one date gives a single-day period."""
    return safe_text(start) if end is None else f"{safe_text(start)}_{safe_text(end)}"


def report_path(base: str, report: str, start: str, end: str | None = None) -> str:
    """`base/report/period=<start>_<end>`."""
    return f"{base.rstrip('/')}/{report}/period={period_name(start, end)}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", order: list[Column] | None = None) -> str:
    """Writes one table; an empty one keeps its schema. `order` sorts the whole dataset."""
    out = df.orderBy(*order) if order else df
    writer = out.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)
    return path


def write_report(
    tables: Mapping[str, DataFrame], path: str, fmt: str = "parquet", orders: Mapping[str, list[Column]] | None = None
) -> dict[str, str]:
    """Writes every table of a report below `path`; returns table name -> dataset path."""
    orders = orders or {}
    return {name: write_table(df, f"{path}/{name}", fmt, orders.get(name)) for name, df in tables.items()}


PUBLISHED = "period string, report string, name string, path string, format string, run string, at timestamp"


def _log(base: str) -> str:
    return f"{base.rstrip('/')}/published"


def publish(spark: SparkSession, base: str, period: str, run: str, reports: Mapping[str, Mapping[str, str]], fmt: str) -> None:
    """Makes the tables (report -> name -> path) the current ones of their period, all by one commit."""
    rows = [(period, report, name, path, fmt, run) for report, tables in reports.items() for name, path in tables.items()]
    entries = spark.createDataFrame(rows, PUBLISHED.rsplit(",", 1)[0]).withColumn("at", F.current_timestamp())
    entries.coalesce(1).write.mode("append").json(_log(base))


def published(spark: SparkSession, base: str) -> DataFrame:
    """The current tables of each period: those of the last run that published it."""
    entries = spark.read.schema(PUBLISHED).json(_log(base))
    latest = F.max(F.struct("at", "run")).over(Window.partitionBy("period"))
    return entries.withColumn("_last", latest).where(F.col("run") == F.col("_last.run")).drop("_last")


def read_published(spark: SparkSession, base: str, period: str, report: str, name: str) -> DataFrame:
    """A current table of a period."""
    found = published(spark, base).where((F.col("period") == period) & (F.col("report") == report) & (F.col("name") == name)).first()
    if found is None:
        raise KeyError(f"{report} {name} of {period} is not published in {base}")
    reader = spark.read.format(found["format"])
    return (reader.option("header", "true") if found["format"] == "csv" else reader).load(found["path"])
