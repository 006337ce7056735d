"""Signed movement totals of all voucher families, side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger import vocab
from stockledger.functions.exprs import signed, sum0
from stockledger.operators.ledger import filled_keys

BY_PRODUCT = [f for f in vocab.FAMILIES if f != "transfers"]


def signed_totals(family: str) -> list[Column]:
    """Quantity and value of one family, each voucher with its sign; absent vouchers count 0."""
    word = vocab.FAMILY_WORDS[family]
    here = F.col("family") == family
    return [
        sum0(F.when(here, signed(measure, F.col("sign")))).alias(f"{measure}_total_{word}")
        for measure in ("Cantidad", "ValorTotal")
    ]


def _movement(ledger: DataFrame, keys: list[str], families: list[str]) -> DataFrame:
    columns = [c for f in families for c in signed_totals(f)]
    return filled_keys(ledger.where(F.col("family").isin(families))).groupBy(*keys).agg(*columns)


def movement_by_product(ledger: DataFrame) -> DataFrame:
    """Per product, without transfers, which cancel out between warehouses."""
    return _movement(ledger, vocab.PRODUCT, BY_PRODUCT)


def movement_by_warehouse_product(ledger: DataFrame) -> DataFrame:
    """Per warehouse and product, transfers included."""
    return _movement(ledger, ["Bodega", *vocab.PRODUCT], vocab.FAMILIES)
