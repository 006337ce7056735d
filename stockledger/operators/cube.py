"""The ledger summed to a cube that later periods are merged into.

All purchase, loan, movement and monthly reports are sums over the classified ledger, so they give
the same from lines that agree in everything a report groups or filters by summed to one. Such a
cube is smaller than the lines, is read instead of them, and two cubes add up to the cube of both periods.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger import vocab

COUNT = "registros"
MEASURES = ["Cantidad", "ValorTotal"]
DIMENSIONS = [
    "Fecha", "Año", "Mes", "Dia", "Bodega", *vocab.PRODUCT, "Tercero", "Comprobante", "Comprobante_corregido", "family",
    "sign", "monthly_sign",
]


def _summed(df: DataFrame, count) -> DataFrame:
    sums = [F.sum(c).cast(_wide(df, c)).alias(c) for c in MEASURES]
    return df.groupBy(*DIMENSIONS).agg(*sums, count.alias(COUNT))


def _wide(df: DataFrame, measure: str) -> str:
    """Decimals keep their scale with all digits, so that merging does not change the type."""
    kind = df.schema[measure].dataType.simpleString()
    return f"decimal(38,{kind.split(',')[1]}" if kind.startswith("decimal") else kind


def ledger_cube(lines: DataFrame) -> DataFrame:
    """A classified ledger by day, warehouse, product, third party and voucher, with `registros` lines each.

    A measure that is missing in all of them stays missing.
    """
    return _summed(lines, F.count(F.lit(1)))


def merge_cubes(*cubes: DataFrame) -> DataFrame:
    """The cube of all periods. Periods may overlap where no line is in two of them."""
    return _summed(reduce(DataFrame.unionByName, cubes), F.sum(COUNT))
