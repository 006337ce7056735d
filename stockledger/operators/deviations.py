"""Lines whose quantity departs from what is usual for their product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.functions.distributed import frequency_profile
from stockledger.functions.exprs import split_key
from stockledger.schemas import DEVIATION_COLUMNS

THRESHOLD = 1e-6


def quantity_deviations(df: DataFrame, key: str = "CodigoGenerico", x: str = "Cantidad", threshold: float = THRESHOLD) -> DataFrame:
    """Lines that differ from the smallest mode of their product, with all deviations and flags.

    The statistics come from the histogram of quantities per product and join back to the lines;
    a product that holds much of them can be split there.
    """
    keyed = df.where(F.col(key).isNotNull())
    split = split_key(key).alias("_split")
    stats = frequency_profile(keyed, [key], x).select(
        key,
        split,
        F.col("mode").alias(f"{x}_moda"),
        F.col("highest").alias(f"{x}_maximo"),
        F.col("mean").alias(f"{x}_media"),
        F.coalesce("std", F.lit(0.0)).alias(f"{x}_std"),
        F.col("lowest").alias(f"{x}_minimo"),
    )
    names = ["moda", "media", "std", "maximo", "minimo"]
    lines = keyed.withColumn("_split", split).join(stats, [key, "_split"]).withColumns(
        {f"Desviacion_{n}": F.abs(F.col(x) - F.col(f"{x}_{n}")) for n in names}
    )
    flags = {
        f"Alerta_desviacion_{n}": F.when(F.col(f"Desviacion_{n}") > threshold, "ALERTA").otherwise("OK")
        for n in ("moda", "media", "std")
    }
    columns = [c.replace("Cantidad", x).replace("CodigoGenerico", key) for c in DEVIATION_COLUMNS]
    return lines.withColumns(flags).where(F.col("Alerta_desviacion_moda") == "ALERTA").select(*columns)


def dropped_null_keys(df: DataFrame, key: str = "CodigoGenerico") -> DataFrame:
    """How many lines the analysis leaves out for want of a product code."""
    return df.agg(F.count_if(F.col(key).isNull()).alias("registros_sin_codigo"))
