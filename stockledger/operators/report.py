"""Net consumption per site and service."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger import vocab
from stockledger.functions.exprs import first_match, joined_key, sum0
from stockledger.operators.consumption import override_specialty

# Report table -> article class and the sources that go into it.
TABLES = {
    "consumos_medicamentos": (vocab.MEDICINES, ["internal", "billed"]),
    "consumos_dispositivos_formulados": (vocab.DEVICES, ["billed"]),
    "consumo_dispositivos": (vocab.DEVICES, ["internal"]),
    "consumos_suministros": (vocab.SUPPLIES, ["internal", "billed"]),
}
TABLE = "tabla"
CLASSES = [vocab.MEDICINES, vocab.DEVICES, vocab.SUPPLIES]


def corrected_specialty() -> Column:
    """The service for services kept as they are, else the specialty, else the service again."""
    service, specialty = F.col("Servicio_Corregido"), F.col("Especialidad")
    return first_match(
        [
            (service.isin(vocab.SERVICES_KEPT), service),
            ((specialty == "") | specialty.isNull(), service),
        ],
        otherwise=specialty,
    )


def class_totals(
    billed: DataFrame,
    returns: DataFrame,
    internal_out: DataFrame,
    internal_in: DataFrame,
    symmetric: bool = False,
) -> DataFrame:
    """Value per source, direction, class, site and service, each total cut to whole units.

    All four inputs go through one aggregation. `signo` is 1 for what goes out, -1 for what
    comes back; cutting before netting keeps the rounding of the single totals.

    Billed rows come with the specialty their service has overridden, returns with their own, so
    outside consultations the two can land under different names. `symmetric` treats returns
    like billed rows.
    """
    if symmetric:
        returns = override_specialty(returns)

    def side(df: DataFrame, source: str, sign: int, service: Column) -> DataFrame:
        return df.where(F.col("Clasificacion_consumo").isin(CLASSES)).select(
            F.lit(source).alias("origen"),
            F.lit(sign).alias("signo"),
            "Clasificacion_consumo",
            "Municipio",
            service.alias("Servicio"),
            "ValorTotal",
        )

    lines = reduce(
        DataFrame.unionByName,
        [
            side(internal_out, "internal", 1, F.col("Servicio")),
            side(internal_in, "internal", -1, F.col("Servicio")),
            side(billed, "billed", 1, corrected_specialty()),
            side(returns, "billed", -1, corrected_specialty()),
        ],
    )
    return (
        lines.groupBy("origen", "signo", "Clasificacion_consumo", "Municipio", "Servicio")
        .agg(sum0("ValorTotal").cast("bigint").alias("ValorTotal"))
        .withColumn("Centro Costo", joined_key("Municipio", "Servicio"))
    )


def net_report(totals: DataFrame) -> DataFrame:
    """Out less in per report table (`tabla`), site and service: all four tables in one frame.

    Each class and source goes into exactly one table.
    """
    table = first_match(
        [
            ((F.col("Clasificacion_consumo") == article_class) & F.col("origen").isin(sources), name)
            for name, (article_class, sources) in TABLES.items()
        ],
        otherwise=F.lit(None).cast("string"),
    )
    return (
        totals.withColumn(TABLE, table)
        .groupBy(TABLE, "Municipio", "Servicio")
        .agg(sum0(F.col("ValorTotal") * F.col("signo")).alias("ValorNeto"))
    )


def report_table(net: DataFrame, name: str) -> DataFrame:
    return net.where(F.col(TABLE) == name).drop(TABLE)


def consumption_report(billed: DataFrame, returns: DataFrame, internal_out: DataFrame, internal_in: DataFrame) -> dict[str, DataFrame]:
    """The four report tables."""
    net = net_report(class_totals(billed, returns, internal_out, internal_in))
    return {name: report_table(net, name) for name in TABLES}
