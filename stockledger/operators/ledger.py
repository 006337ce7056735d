"""Ledger preparation: relabel, confirm, date, classify, net by voucher."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger import vocab
from stockledger.functions.exprs import first_match, sum0, zero_nulls

BUILT_IN = "built_in_vouchers"
INDEX = ["Fecha", "Bodega", *vocab.PRODUCT, "Tercero", "Comprobante_corregido"]


def voucher_dimension(spark: SparkSession) -> DataFrame:
    """The fixed voucher table: `voucher, family, sign, monthly_sign` (23 rows)."""

    def literal(v: str | int | None) -> str:
        return "CAST(NULL AS INT)" if v is None else f"'{v}'" if isinstance(v, str) else str(v)

    rows = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in vocab.VOUCHERS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(voucher, family, sign, monthly_sign)")


def relabel_transfers(df: DataFrame) -> DataFrame:
    """Splits the transfer voucher by direction into `Comprobante_corregido`."""
    transfer = F.col("Comprobante") == vocab.TRANSFER_VOUCHER
    return df.withColumn(
        "Comprobante_corregido",
        first_match(
            [
                ((F.col("TipoMovimiento") == "SALIDA") & transfer, vocab.TRANSFER_OUT),
                ((F.col("TipoMovimiento") == "ENTRADA") & transfer, vocab.TRANSFER_IN),
            ],
            otherwise=F.col("Comprobante"),
        ),
    )


def confirmed_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("Estado") == vocab.CONFIRMED)


def with_calendar(df: DataFrame) -> DataFrame:
    """Parses the first ten characters of `Fecha` (dd/MM/yyyy, strict) and adds year, month, day."""
    return df.withColumn("Fecha", F.to_date(F.substring("Fecha", 1, 10), "dd/MM/yyyy")).withColumns(
        {"Año": F.year("Fecha"), "Mes": F.month("Fecha"), "Dia": F.dayofmonth("Fecha")}
    )


def coerce_measures(df: DataFrame, money: str = "double") -> DataFrame:
    """Quantity to bigint and value to `money`, unreadable values to NULL.

    `decimal(18,2)` makes every later sum independent of the order of the rows.
    """
    return df.withColumns(
        {"Cantidad": F.col("Cantidad").try_cast("bigint"), "ValorTotal": F.col("ValorTotal").try_cast(money)}
    )


def prepare_ledger(df: DataFrame, money: str = "double") -> DataFrame:
    """Relabelled, confirmed, dated and typed ledger lines."""
    return coerce_measures(with_calendar(confirmed_only(relabel_transfers(df))), money)


def classify_vouchers(df: DataFrame, vouchers: DataFrame | None = None) -> DataFrame:
    """Adds `family`, `sign` and `monthly_sign` in one pass; all NULL for unknown vouchers.

    The built-in table has 23 rows and is broadcast. A table of your own is joined without a
    hint, so Spark broadcasts it only when its size allows.
    """
    dim = F.broadcast(voucher_dimension(df.sparkSession)) if vouchers is None else vouchers
    joined = df.join(dim, F.col("Comprobante_corregido") == F.col("voucher"), "left").drop("voucher")
    return joined.withMetadata("family", {BUILT_IN: vouchers is None})


def classified_ledger(df: DataFrame, money: str = "double", vouchers: DataFrame | None = None) -> DataFrame:
    """Raw ledger to the frame all purchase, loan, movement and monthly operators read.

    Missing numeric codes stay NULL here: the netted tables group them apart from 0 and then make
    them 0, and what adds netted rows up again takes both as 0 (`filled_keys`).
    """
    return classify_vouchers(prepare_ledger(df, money), vouchers)


def filled_keys(ledger: DataFrame) -> DataFrame:
    """The lines with missing numeric codes as 0."""
    return zero_nulls(ledger, [*vocab.PRODUCT, "Bodega", "Tercero"])


def landed_vouchers(family: str) -> list[str]:
    """The vouchers of a family as the input has them, transfers under both of their names."""
    names = vocab.family_vouchers(family)
    return [*names, vocab.TRANSFER_VOUCHER] if {vocab.TRANSFER_IN, vocab.TRANSFER_OUT} & set(names) else names


def of_family(ledger: DataFrame, family: str) -> DataFrame:
    """The lines of one family.

    With the built-in vouchers the landed voucher is filtered too, which reaches the scan, where
    the family is known only after the join.
    """
    lines = ledger.where(F.col("family") == family)
    if ledger.schema["family"].metadata.get(BUILT_IN) and "Comprobante" in ledger.columns:
        lines = lines.where(F.col("Comprobante").isin(landed_vouchers(family)))
    return lines


def family_counts(ledger: DataFrame) -> DataFrame:
    """Confirmed lines per family; the NULL family holds those still to be classified."""
    return ledger.groupBy("family").agg(F.sum(_lines_in(ledger)).alias("registros"))


def unclassified_count(ledger: DataFrame) -> DataFrame:
    return ledger.agg(sum0(F.when(F.col("family").isNull(), _lines_in(ledger))).alias("pendientes"))


def _lines_in(ledger: DataFrame) -> Column:
    """How many lines a row stands for: one, or its count in a cube."""
    return F.col("registros") if "registros" in ledger.columns else F.lit(1).cast("bigint")


def net_by_voucher(ledger: DataFrame, family: str) -> DataFrame:
    """Quantity and value per voucher of one family, one column pair per voucher.

    The voucher is part of the grain, so a row has one non-zero voucher: one aggregation and a
    projection do the pivot, and the columns do not depend on the data.
    """
    netted = (
        of_family(ledger, family)
        .groupBy(*INDEX)
        .agg(sum0("Cantidad").alias("_q"), sum0("ValorTotal").alias("_v"))
    )
    vouchers = vocab.family_vouchers(family)

    def cells(measure: str, total: str) -> list:
        zero = F.lit(0).cast(netted.schema[total].dataType)
        return [
            F.when(F.col("Comprobante_corregido") == v, F.col(total)).otherwise(zero).alias(f"{measure}_{v}")
            for v in vouchers
        ]

    return zero_nulls(netted.select(*INDEX, *cells("Cantidad", "_q"), *cells("ValorTotal", "_v")), INDEX)
