"""Billed against consumed net of returns, per admission, invoice and product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.functions.exprs import joined_key, spread_null_key, sum0, zero_nulls
from stockledger.operators.consumption import KEY, MEET

KEYS = ["field_1", "idadmision", "nofactura", "CodigoGenerico", "Nombre"]


def profitability(returns: DataFrame, consumption: DataFrame, once: bool = False) -> DataFrame:
    """Net consumption, billing and their difference.

    Pairing every return line with a consumption group counts the group once per return line.
    That is the default; it is computed from the number of return lines and their sums, so no
    pairs are made. `once` counts each group one time. Returns without consumption share the
    row of empty keys.

    Frames that hold `MEET` are partitioned by it, so they are summed and joined where they are; it tells
    rows without a key apart, which changes no sum.
    """
    met = MEET in consumption.columns and MEET in returns.columns
    groups = (
        consumption.groupBy("Clasificacion_consumo", KEY, *KEYS, *([MEET] if met else []))
        .agg(
            *[sum0(c).alias(c) for c in ("Cantidad", "ValorTotal", "billed_qty", "billed_value")],
        )
    )
    back = (
        returns.withColumn("_key", joined_key("field_1", "CodigoGenerico"))
        .groupBy("_key", *([MEET] if met else []))
        .agg(
            F.count(F.lit(1)).alias("_lines"),
            sum0("Cantidad").alias("_back_qty"),
            sum0("ValorTotal").alias("_back_value"),
        )
    )
    if met:
        # rows without a key share their fillers on both sides, and match nothing all the same
        back = back.withColumnRenamed(MEET, "_back_k").drop("_key")
        same = (F.col(MEET) == F.col("_back_k")) & F.col(KEY).isNotNull()
        paired = groups.join(back, same, "full").drop(MEET, "_back_k")
    else:
        groups = groups.withColumn("_k", spread_null_key(KEY, "consumption", KEYS))
        back = back.withColumn("_k", spread_null_key("_key", "returns", ["_key"])).drop("_key")
        paired = groups.join(back, "_k", "full").drop("_k")
    paired = zero_nulls(paired)
    times = F.lit(1) if once else F.greatest(F.col("_lines"), F.lit(1))

    def net(measure: str, returned: str) -> Column:
        return F.col(measure) * times - F.col(returned)

    qty, value = net("Cantidad", "_back_qty"), net("ValorTotal", "_back_value")
    billed_qty, billed_value = F.col("billed_qty") * times, F.col("billed_value") * times
    return paired.groupBy(*KEYS).agg(
        sum0(qty).alias("Cantidad_Consumida"),
        sum0(value).alias("Total_Consumido"),
        sum0(billed_qty).alias("Cantidad_Facturada"),
        sum0(billed_value).alias("Total_Facturado"),
        sum0(billed_qty - qty).alias("Diferencia_Cantidad_Total"),
        sum0(billed_value - value).alias("Diferencia_Total_Total"),
    )
