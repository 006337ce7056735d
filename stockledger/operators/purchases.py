"""Purchases: net of returns, per supplier, per product and per month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger import vocab
from stockledger.functions.exprs import mean, ratio, round_cents, signed, sum0, zero_nulls
from stockledger.operators.monthly import present_months

PRICE = "valor_unitario_calculado"
GRAIN = ["Fecha", "Bodega", *vocab.PRODUCT, "Tercero", "Mes"]
PRODUCT_ORDER = ["GrupoInventario", "CodigoGenerico", "Generico"]


def net_purchases(ledger: DataFrame, year_month: bool = False) -> DataFrame:
    """Purchases less purchase returns per day, warehouse, product and supplier, with unit price.

    Months carry no year unless `year_month`, which makes them numbers like 202403.
    """
    lines = ledger.where(
        F.col("Comprobante_corregido").isin(vocab.PURCHASE_VOUCHER, vocab.PURCHASE_RETURN_VOUCHER)
    )
    if year_month:
        lines = lines.withColumn("Mes", F.year("Fecha") * 100 + F.month("Fecha"))
    sign = F.when(F.col("Comprobante_corregido") == vocab.PURCHASE_VOUCHER, 1).otherwise(-1)
    netted = (
        lines.groupBy(*GRAIN)
        .agg(
            sum0(signed("Cantidad", sign)).alias("Cantidad_neta"),
            sum0(signed("ValorTotal", sign)).alias("ValorTotal_neto"),
        )
    )
    price = F.when(F.col("Cantidad_neta") == 0, F.lit(0.0)).otherwise(
        round_cents(ratio("ValorTotal_neto", "Cantidad_neta"))
    )
    return zero_nulls(netted, GRAIN).withColumn(PRICE, price)


def _mean_price() -> Column:
    """The prices have two decimals, so their sum is taken exactly."""
    return mean(F.col(PRICE).cast("decimal(18,2)"))


def purchases_by_supplier(net: DataFrame) -> DataFrame:
    """Unit price figures per day, warehouse, product and supplier.

    Net purchases already have this grain, so each group is one row and needs no aggregation.
    """
    price = F.col(PRICE)
    return net.select(
        "Fecha", "Mes", "Bodega", *PRODUCT_ORDER, "Tercero",
        price.alias("suma valor unitario"),
        F.lit(1).cast("bigint").alias("cantidad compras"),
        price.alias("valor unitario minimo"),
        price.alias("valor unitario maximo"),
        price.alias("valor unitario promedio"),
    )


def _totals() -> list[Column]:
    return [
        sum0("Cantidad_neta").alias("cantidad_comprada_neta"),
        sum0("ValorTotal_neto").alias("valor_total_comprado_neto"),
        _mean_price().alias("valor_unitario_calculado_promedio"),
        F.max(PRICE).alias("valor_unitario_calculado_maximo"),
        F.min(PRICE).alias("valor_unitario_calculado_minimo"),
    ]


def largest_purchases(net: DataFrame) -> DataFrame:
    """Totals and unit prices per product and supplier."""
    return net.groupBy(*PRODUCT_ORDER, "Tercero").agg(*_totals(), F.count(PRICE).alias("cantidad_registros"))


def most_purchased_products(net: DataFrame) -> DataFrame:
    """Totals and unit prices per product. `cantidad_proveedores` counts rows with a supplier."""
    return net.groupBy(*PRODUCT_ORDER).agg(*_totals(), F.count("Tercero").alias("cantidad_proveedores"))


def monthly_purchase_behaviour(net: DataFrame, months: list[int] | None = None) -> DataFrame:
    """Mean price, quantity, value and row count per product and month of the year.

    Columns run month by month with the counts last. Products with a missing text key are left
    out. `months` defaults to those in the data (one small query).
    """
    months = present_months(net) if months is None else months
    keyed = net.dropna(subset=vocab.PRODUCT)
    wide = (
        keyed.groupBy(*PRODUCT_ORDER)
        .pivot("Mes", months)
        .agg(
            _mean_price().alias("p"),
            sum0("Cantidad_neta").alias("q"),
            sum0("ValorTotal_neto").alias("v"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    named = [
        F.col(f"{m}_{c}").alias(name)
        for m in months
        for c, name in (("p", f"{m}"), ("q", f"Cantidad_neta_{m}"), ("v", f"ValorTotal_neto_{m}"))
    ] + [F.col(f"{m}_n").alias(f"{m}_cant_registros") for m in months]
    return zero_nulls(wide.select(*PRODUCT_ORDER, *named))
