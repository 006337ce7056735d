"""Raw totals against the totals of the net consumption report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger import vocab
from stockledger.functions.exprs import sum0

TOLERANCE = 1000.01
OUT_VOUCHERS = [vocab.DISPENSED, *vocab.INTERNAL_OUT]
IN_VOUCHERS = [vocab.RETURNED, *vocab.INTERNAL_IN]
SIDES = ["total_consumos", "total_entradas", "total_procesado"]


def _side(df: DataFrame, side: str, amount: Column) -> DataFrame:
    return df.select(F.lit(side).alias("_side"), amount.alias("_amount"))


def _raw(df: DataFrame, vouchers: list[str], money: str) -> tuple[DataFrame, Column]:
    if "ValorTotal" not in df.columns:
        raise KeyError("ValorTotal is not among the columns of the extract")
    return df.where(F.col("Comprobante").isin(vouchers)), F.col("ValorTotal").try_cast(money)


def reconcile(
    raw_out: DataFrame,
    raw_in: DataFrame,
    report: DataFrame | dict[str, DataFrame],
    tolerance: float = TOLERANCE,
    money: str = "double",
) -> DataFrame:
    """One row: raw out, raw in, their difference, the report's total, what is left, and whether
    that is within the tolerance (the limit itself included).

    `report` is the net report in one frame, or its tables by name.
    """
    out_lines, out_amount = _raw(raw_out, OUT_VOUCHERS, money)
    in_lines, in_amount = _raw(raw_in, IN_VOUCHERS, money)
    tables = report if isinstance(report, dict) else {"the report": report}
    for name, table in tables.items():
        if "ValorNeto" not in table.columns:
            raise KeyError(f"ValorNeto is not among the columns of {name}")
    processed = reduce(DataFrame.unionByName, [t.select("ValorNeto") for t in tables.values()])
    sides = [
        _side(out_lines, "total_consumos", out_amount),
        _side(in_lines, "total_entradas", in_amount),
        _side(processed, "total_procesado", F.col("ValorNeto").cast(money)),
    ]
    totals = reduce(DataFrame.unionByName, sides).agg(
        *[sum0(F.when(F.col("_side") == s, F.col("_amount"))).alias(s) for s in SIDES]
    )
    return (
        totals.withColumn("total_limpio", F.col("total_consumos") - F.col("total_entradas"))
        .withColumn("diferencia", F.col("total_limpio") - F.col("total_procesado"))
        .withColumn("conciliacion_exitosa", F.abs("diferencia") <= F.lit(tolerance))
        .select(
            "total_consumos", "total_entradas", "total_limpio", "total_procesado", "diferencia",
            "conciliacion_exitosa",
        )
    )
