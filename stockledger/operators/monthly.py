"""Monthly consumption: quantities, values, ABC classes, variability."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger import vocab
from stockledger.functions.distributed import running_total
from stockledger.functions.exprs import first_match, ratio, signed, sum0
from stockledger.operators.ledger import filled_keys, of_family

WAREHOUSE_PRODUCT = ["Bodega", *vocab.PRODUCT]
A_LIMIT, B_LIMIT = 0.80, 0.95
STABLE_LIMIT, VARIABLE_LIMIT = 0.25, 0.50


def monthly_lines(ledger: DataFrame, year_month: bool = False) -> DataFrame:
    """Consumption lines with their monthly sign applied.

    Months carry no year unless `year_month`, which makes them numbers like 202403.
    """
    sign = F.col("monthly_sign")
    lines = filled_keys(of_family(ledger, "consumption")).withColumns(
        {"Cantidad_Total": signed("Cantidad", sign), "Valor_Total": signed("ValorTotal", sign)}
    )
    if year_month:
        lines = lines.withColumn("Mes", F.year("Fecha") * 100 + F.month("Fecha"))
    return lines.select(*WAREHOUSE_PRODUCT, "Mes", "Cantidad_Total", "Valor_Total")


def present_months(df: DataFrame) -> list[int]:
    """The months in the data, the only action here: one row per month comes back."""
    return sorted(r.Mes for r in df.select("Mes").distinct().collect() if r.Mes is not None)


def _month_columns(df: DataFrame, keys: list[str], measure: str, months: list[int], *aggs: Column) -> DataFrame:
    """Sums with months as columns named by their number, absent ones 0, in one aggregation."""
    cells = [sum0(F.when(F.col("Mes") == m, F.col(measure))).alias(str(m)) for m in months]
    return df.groupBy(*keys).agg(*cells, *aggs)


def _total(months: list[int]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(f"`{m}`") for m in months])


def _mean(months: list[int]) -> Column:
    """Over every month of the data set, those in which the row has nothing included."""
    return ratio(_total(months), F.lit(len(months)))


def _extreme(months: list[int], pick) -> Column:
    columns = [F.col(f"`{m}`") for m in months]
    return pick(*columns) if len(columns) > 1 else columns[0]


def _monthly(lines: DataFrame, measure: str, months: list[int] | None, total: str, suffix: str) -> DataFrame:
    months = present_months(lines) if months is None else months
    wide = _month_columns(lines, vocab.PRODUCT, measure, months)
    return wide.select(
        "*",
        _total(months).alias(total),
        _mean(months).alias(f"Promedio_{suffix}"),
        _extreme(months, F.least).alias(f"Minimo_{suffix}"),
        _extreme(months, F.greatest).alias(f"Maximo_{suffix}"),
    )


def monthly_qty(lines: DataFrame, months: list[int] | None = None) -> DataFrame:
    """Quantity per product and month with total, mean, minimum and maximum over the months."""
    return _monthly(lines, "Cantidad_Total", months, "Total_Cantidad", "Mensual")


def monthly_value(lines: DataFrame, months: list[int] | None = None) -> DataFrame:
    """Value per product and month with total, mean, minimum and maximum over the months."""
    return _monthly(lines, "Valor_Total", months, "Total_Valor", "Valor")


def abc_pareto(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """Share and cumulative share of value per product, largest first, and its ABC class.

    Equal values are taken in key order. Shares are quotients of exact sums, so a cumulative
    share of exactly 0.80 or 0.95 stays in its class.
    """
    value = "Valor_Total_Consumido"
    per_product = lines.groupBy(*vocab.PRODUCT).agg(sum0("Valor_Total").alias(value))
    order = [F.col(value).desc_nulls_first(), *[F.col(k).asc() for k in vocab.PRODUCT]]
    summed = running_total(per_product, order, value, out="_upto", total="_all", partitions=partitions)
    has_value = F.col("_all") > 0
    shares = summed.withColumns(
        {
            "Porcentaje_Participacion": F.when(has_value, ratio(value, "_all")).otherwise(F.lit(0.0)),
            "Porcentaje_Acumulado": F.when(has_value, ratio("_upto", "_all")).otherwise(F.lit(0.0)),
        }
    )
    upto = F.col("Porcentaje_Acumulado")
    return shares.withColumn(
        "Clasificacion_ABC",
        first_match([(~has_value, "C"), (upto <= A_LIMIT, "A"), (upto <= B_LIMIT, "B")], otherwise="C"),
    ).drop("_upto", "_all")


def demand_variability(lines: DataFrame, months: list[int] | None = None) -> DataFrame:
    """Monthly quantity per warehouse and product with its coefficient of variation.

    The deviation looks at the months in which the product moved, the mean at all months.
    """
    months = present_months(lines) if months is None else months
    by_month = lines.groupBy(*WAREHOUSE_PRODUCT, "Mes").agg(sum0("Cantidad_Total").alias("x"))
    wide = _month_columns(by_month, WAREHOUSE_PRODUCT, "x", months, F.stddev_samp("x").alias("_std"))
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in WAREHOUSE_PRODUCT])
    average, std, cv = F.col("Promedio_Mensual"), F.col("Desviacion_Estandar"), F.col("Coeficiente_Variacion")
    return (
        wide.withColumns(
            {
                "Promedio_Mensual": _mean(months),
                # a missing key never found its deviation
                "Desviacion_Estandar": F.when(keyed, F.coalesce("_std", F.lit(0.0))).otherwise(F.lit(0.0)),
            }
        )
        .drop("_std")
        .withColumn("Coeficiente_Variacion", F.when(average > 0, std / average).otherwise(F.lit(0.0)))
        .withColumn(
            "Tipo_Demanda",
            first_match([(cv <= STABLE_LIMIT, "Estable"), (cv <= VARIABLE_LIMIT, "Variable")], otherwise="Erratica"),
        )
    )


def consumption_by_warehouse(lines: DataFrame, months: list[int] | None = None) -> DataFrame:
    """Quantity per warehouse, product and month with total and mean."""
    months = present_months(lines) if months is None else months
    wide = _month_columns(lines, WAREHOUSE_PRODUCT, "Cantidad_Total", months)
    return wide.select("*", _total(months).alias("Total_Cantidad"), _mean(months).alias("Promedio_Mensual"))
