"""Supplier prices, stock efficiency, billing gap and purchase margins.

Where two frames meet per key, both are stacked and aggregated once with one column set per
side: the result of aggregating each and joining them in full, with one shuffle and no join.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.functions.distributed import grouped_medians
from stockledger.functions.exprs import (
    as_is,
    first_match,
    mean,
    n_unique,
    n_unique_small,
    null_safe_join,
    ratio,
    ratio_if_positive,
    split_key,
    sum0,
    zero_nulls,
)

REFERENCE, COALESCED = "reference", "coalesced"
STOCK_KEYS = ["Municipio", "Servicio", "Clasificacion_consumo", "CodigoGenerico", "Nombre"]
Keep = Callable[[DataFrame], DataFrame]
GAP_KEYS = ["idadmision", "CodigoGenerico", "Nombre"]
GAP_BILLED = ["billed_value", "billed_qty", "billed_unit_price"]
GAP_CONSUMED = ["ValorTotal", "Cantidad", "ValorUnitario"]
GAP_ATTRIBUTES = {
    "Especialidad": "Especialidad",
    "Servicio_Corregido": "Servicio_Corregido",
    "Municipio": "Municipio",
    "MedicoRealiza": "MedicoRealiza",
    "No_Factura": "nofactura",
}
SITE_PRODUCT = ["CodigoGenerico", "Nombre", "Municipio", "Servicio"]


def _outer_aggregate(
    left: DataFrame, right: DataFrame, keys: list[str], left_aggs: list[Column], right_aggs: list[Column], mode: str
) -> DataFrame:
    """Full join of two aggregates as one aggregation over the stacked, narrowed inputs.

    Aggregates read columns only their side has, so the other side's NULLs do not count. Rows
    with a NULL key never match and keep a group per side. In `reference` mode the keys are the
    left ones and the right ones follow as `<key>_right`; `coalesced` has one set of keys.
    Missing numbers become 0, numeric keys included.
    """
    if mode not in (REFERENCE, COALESCED):
        raise ValueError(f"keys must be {REFERENCE} or {COALESCED}, not {mode}")
    unmatched = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    stacked = left.withColumn("_left", F.lit(True)).unionByName(
        right.withColumn("_left", F.lit(False)), allowMissingColumns=True
    )
    grouped = (
        stacked.withColumn("_alone", F.when(unmatched, F.col("_left")))
        .groupBy(*keys, "_alone")
        .agg(
            F.count_if("_left").alias("_nl"),
            F.count_if(~F.col("_left")).alias("_nr"),
            *left_aggs,
            *right_aggs,
        )
    )
    values = [c for c in grouped.columns if c not in (*keys, "_alone", "_nl", "_nr")]
    if mode == COALESCED:
        return zero_nulls(grouped.select(*keys, *values))
    left_keys = [F.when(F.col("_nl") > 0, F.col(k)).alias(k) for k in keys]
    right_keys = [F.when(F.col("_nr") > 0, F.col(k)).alias(f"{k}_right") for k in keys]
    return zero_nulls(grouped.select(*left_keys, *values, *right_keys))


# --- supplier prices -------------------------------------------------------------------------

SUPPLIER_KEYS = ["CodigoGenerico", "Nombre", "Proveedor", "Municipio", "Servicio"]


def supplier_price_variance(consumption: DataFrame, keep: Keep = as_is) -> DataFrame:
    """Price spread per product and supplier at a site, against the product's market median.

    The market median is the median of the group medians of one product. `keep` is applied to the
    groups, which are read several times: a caller may write or persist them.
    """
    price = "ValorUnitario"
    priced = consumption.where(F.col("Proveedor").isNotNull() & (F.col("Proveedor") != "") & (F.col(price) > 0))
    groups = grouped_medians(
        priced,
        SUPPLIER_KEYS,
        {price: "Costo_Mediano"},
        [
            mean(price).alias("Costo_Promedio"),
            F.stddev_samp(price).alias("Desv_Estandar"),
            F.min(price).cast("double").alias("Costo_Minimo"),
            F.max(price).cast("double").alias("Costo_Maximo"),
            sum0("Cantidad").alias("Volumen_Total"),
            sum0("ValorTotal").alias("Valor_Total_Comprado"),
            n_unique_small("Comprobante").alias("Num_Transacciones"),
        ],
        keep,
    )
    product = ["CodigoGenerico", "Nombre"]
    markets = grouped_medians(groups.select(*product, "Costo_Mediano"), product, {"Costo_Mediano": "Mediana_Mercado"})
    median, market = F.col("Costo_Mediano"), F.col("Mediana_Mercado")
    spread = F.col("Costo_Maximo") - F.col("Costo_Minimo")
    # a product without code or name finds no market to compare with
    compared = (
        groups.withColumn("_split", split_key("Nombre"))
        .join(markets.withColumn("_split", split_key("Nombre")), [*product, "_split"], "left")
        .drop("_split")
        .withColumns(
            {
                "CV_Costo": ratio("Desv_Estandar", median),
                "Rango_Porcentual": ratio(spread, median),
                "Diferencia_Absoluta": spread,
                "Precio_Promedio_Proveedor": F.col("Costo_Promedio"),
            }
        )
    )
    off_market = F.col("Costo_Promedio") - market
    away = F.abs(F.col("Desviacion_Vs_Mercado_Pct"))
    cv, volume = F.col("CV_Costo"), F.col("Volumen_Total")
    return (
        compared.withColumns({"Desviacion_Vs_Mercado_Pct": ratio(off_market, market), "Desviacion_Vs_Mercado_Abs": off_market})
        .withColumns(
            {
                "Nivel_Riesgo_Variabilidad": first_match([(cv > 0.3, "ALTO_RIESGO"), (cv > 0.15, "MEDIO_RIESGO")], "NORMAL"),
                "Alerta_Precio_Mercado": first_match(
                    [(away > 0.25, "PRECIO_ANOMALO"), (away > 0.10, "PRECIO_ALERTA")], "PRECIO_NORMAL"
                ),
                "Clasificacion_Volumen": first_match(
                    [(volume < 10, "BAJO_VOLUMEN"), (volume < 100, "VOLUMEN_MEDIO")], "ALTO_VOLUMEN"
                ),
            }
        )
    )


# --- stock efficiency ------------------------------------------------------------------------

STOCK_STATES = [
    "DESABASTECIMIENTO", "SIN_COMPRAS", "SOBRE_STOCK_CRITICO", "SOBRE_STOCK", "STOCK_ELEVADO", "OPTIMO",
    "DESABASTECIMIENTO_LEVE",
]


def stock_efficiency_detail(consumption: DataFrame, receipts: DataFrame, keys: str = REFERENCE) -> DataFrame:
    """Consumed against received per site, service, class and product, with the stock's state."""

    def measures(df: DataFrame, side: str) -> DataFrame:
        return df.select(
            *STOCK_KEYS,
            F.col("ValorTotal").alias(f"_{side}_value"),
            F.col("Cantidad").alias(f"_{side}_qty"),
            F.col("ValorUnitario").alias(f"_{side}_price"),
        )

    def totals(side: str, word: str, singular: str) -> list[Column]:
        return [
            sum0(f"_{side}_value").alias(f"{word}_Valor"),
            sum0(f"_{side}_qty").alias(f"{word}_Cantidad"),
            mean(f"_{side}_price").alias(f"Costo_Promedio_{singular}"),
        ]

    both = _outer_aggregate(
        measures(consumption, "c"),
        measures(receipts, "r"),
        STOCK_KEYS,
        totals("c", "Consumo", "Consumo"),
        totals("r", "Entradas", "Entrada"),
        keys,
    )
    detail = both.withColumns(
        {
            "Consumo_Neto_Valor": F.col("Consumo_Valor"),
            "Consumo_Neto_Cantidad": F.col("Consumo_Cantidad"),
            "Compras_Totales_Valor": F.col("Entradas_Valor"),
            "Compras_Totales_Cantidad": F.col("Entradas_Cantidad"),
            "Ratio_Eficiencia_Valor": ratio_if_positive("Consumo_Valor", "Entradas_Valor"),
            "Ratio_Eficiencia_Cantidad": ratio_if_positive("Consumo_Cantidad", "Entradas_Cantidad"),
            "Diferencia_Valor": F.col("Consumo_Valor") - F.col("Entradas_Valor"),
            "Diferencia_Cantidad": F.col("Consumo_Cantidad") - F.col("Entradas_Cantidad"),
            "Diff_Costo_Unitario": F.col("Costo_Promedio_Consumo") - F.col("Costo_Promedio_Entrada"),
        }
    )
    efficiency, gap, price_gap = (
        F.col("Ratio_Eficiencia_Valor"),
        F.col("Diferencia_Valor"),
        F.col("Diff_Costo_Unitario"),
    )
    return detail.withColumns(
        {
            "Estado_Inventario": first_match(
                [
                    (F.col("Consumo_Neto_Valor") > F.col("Compras_Totales_Valor"), "DESABASTECIMIENTO"),
                    (efficiency.isNull(), "SIN_COMPRAS"),
                    (efficiency < 0.5, "SOBRE_STOCK_CRITICO"),
                    (efficiency < 0.7, "SOBRE_STOCK"),
                    (efficiency < 0.9, "STOCK_ELEVADO"),
                    (efficiency <= 1.1, "OPTIMO"),
                ],
                "DESABASTECIMIENTO_LEVE",
            ),
            "Valor_Stock_Muerto": F.when(gap < 0, F.abs(gap)).otherwise(F.lit(0)),
            "Alerta_Costo_Unitario": first_match(
                [(price_gap < -0.05, "COMPRA_CARA"), (price_gap > 0.05, "CONSUMO_CARO")], "NORMAL"
            ),
        }
    )


def stock_efficiency_summary(detail: DataFrame) -> DataFrame:
    """The detail per site, service and class. Percentages of purchases of 0 are NULL.

    The predominant state is the first by name among equals. Its counts are columns, which Spark sums
    by hash; a histogram per group would be sorted with all rows.
    """
    summary = detail.groupBy("Municipio", "Servicio", "Clasificacion_consumo").agg(
        sum0("Consumo_Neto_Valor").alias("Total_Consumo_Valor"),
        sum0("Compras_Totales_Valor").alias("Total_Compras_Valor"),
        sum0("Consumo_Neto_Cantidad").alias("Total_Consumo_Cantidad"),
        sum0("Compras_Totales_Cantidad").alias("Total_Compras_Cantidad"),
        sum0("Valor_Stock_Muerto").alias("Total_Stock_Muerto_Valor"),
        sum0("Diferencia_Valor").alias("Diferencia_Neta_Valor"),
        sum0("Diferencia_Cantidad").alias("Diferencia_Neta_Cantidad"),
        *[F.count_if(F.col("Estado_Inventario") == s).alias(f"_{s}") for s in STOCK_STATES],
        F.count_if(F.col("Alerta_Costo_Unitario") != "NORMAL").alias("Productos_Con_Alerta_Costo"),
        n_unique("CodigoGenerico").alias("Num_Productos_Unicos"),
    )
    most = F.greatest(*[F.col(f"_{s}") for s in STOCK_STATES])
    predominant = F.array_min(F.array(*[F.when((F.col(f"_{s}") == most) & (most > 0), s) for s in STOCK_STATES]))
    first = summary.columns.index(f"_{STOCK_STATES[0]}")
    before, after = summary.columns[:first], summary.columns[first + len(STOCK_STATES) :]
    return summary.select(*before, predominant.alias("Estado_Predominante"), *after).withColumns(
        {
            "Ratio_Eficiencia_Global": ratio_if_positive("Total_Consumo_Valor", "Total_Compras_Valor"),
            "Pct_Stock_Muerto_Sobre_Compras": ratio("Total_Stock_Muerto_Valor", "Total_Compras_Valor") * 100,
        }
    )


# --- billing gap -----------------------------------------------------------------------------

CRITICAL_STATES = ["SUB_FACTURACION_CRITICA", "SIN_FACTURAR"]
ALERT_STATES = ["SUB_FACTURACION_CRITICA", "SUB_FACTURACION", "SOBRE_FACTURACION", "SOBRE_FACTURACION_CRITICA"]


def consumption_admission(consumption: DataFrame) -> Column:
    """Admission of a consumption row, from the first of three columns it may come in."""
    sources = {
        "field_1": F.col("field_1").try_cast("bigint"),
        "ADM-CodGen": F.get(F.split(F.col("ADM-CodGen"), "-"), F.lit(0)).try_cast("bigint"),
        "idadmision": F.col("idadmision"),
    }
    for column, expression in sources.items():
        if column in consumption.columns:
            return expression
    raise KeyError(f"consumption has none of {', '.join(sources)}")


def billing_gap_detail(billing: DataFrame, consumption: DataFrame, keys: str = REFERENCE, first_by: str = "nofactura") -> DataFrame:
    """Billed against consumed per admission and product.

    Specialty, service, site, doctor and invoice come from one row of the group: the first by
    `first_by`, which stands in for the order of the input.
    """
    row = F.struct(F.col(first_by).alias("_first"), *[F.col(c).alias(name) for name, c in GAP_ATTRIBUTES.items()])
    billed = billing.select(*GAP_KEYS, *GAP_BILLED, row.alias("_row"))
    consumed = (
        consumption.withColumn("idadmision", consumption_admission(consumption))
        .where(F.col("idadmision").isNotNull())
        .select(*GAP_KEYS, *GAP_CONSUMED)
    )
    both = _outer_aggregate(
        billed,
        consumed,
        GAP_KEYS,
        [
            sum0("billed_value").alias("Facturado_Valor"),
            sum0("billed_qty").alias("Facturado_Cantidad"),
            mean("billed_unit_price").alias("Precio_Facturado_Prom"),
            F.min("_row").alias("_row"),
        ],
        [
            sum0("ValorTotal").alias("Consumido_Valor"),
            sum0("Cantidad").alias("Consumido_Cantidad"),
            mean("ValorUnitario").alias("Costo_Unitario_Prom"),
        ],
        keys,
    )
    billed_value, used_value = F.col("Facturado_Valor"), F.col("Consumido_Valor")
    gap = both.withColumns({name: F.col(f"_row.{name}") for name in GAP_ATTRIBUTES}).drop("_row").withColumns(
        {
            "Margen_Bruto": billed_value - used_value,
            "Diferencia_Cantidad": F.col("Facturado_Cantidad") - F.col("Consumido_Cantidad"),
            "Ratio_Fact_Consumo": ratio_if_positive(billed_value, used_value),
            "Margen_Porcentual": ratio_if_positive(billed_value - used_value, billed_value) * 100,
            "Spread_Precio_Costo": F.col("Precio_Facturado_Prom") - F.col("Costo_Unitario_Prom"),
        }
    )
    share = F.col("Ratio_Fact_Consumo")
    return gap.withColumns(
        {
            "Estado_Facturacion": first_match(
                [
                    (billed_value == 0, "SIN_FACTURAR"),
                    (used_value == 0, "FACTURADO_SIN_CONSUMO"),
                    (share.isNull(), "INDETERMINADO"),
                    (share < 0.7, "SUB_FACTURACION_CRITICA"),
                    (share < 0.9, "SUB_FACTURACION"),
                    (share <= 1.1, "EQUILIBRADO"),
                    (share <= 1.5, "SOBRE_FACTURACION"),
                ],
                "SOBRE_FACTURACION_CRITICA",
            ),
            "Alerta_Spread": F.when(
                F.abs("Spread_Precio_Costo") > F.col("Costo_Unitario_Prom") * 0.5, "SPREAD_ANOMALO"
            ).otherwise("NORMAL"),
        }
    )


def billing_gap_summary(detail: DataFrame, keep: Keep = as_is) -> DataFrame:
    """The detail per site, corrected service and specialty.

    Totals, bracket and medians each read the detail; `keep` is applied to its narrow columns.
    """
    keys = ["Municipio", "Servicio_Corregido", "Especialidad"]
    detail = keep(
        detail.select(
            *keys, "idadmision", "No_Factura", "Facturado_Valor", "Consumido_Valor", "Margen_Bruto",
            "Ratio_Fact_Consumo", "Margen_Porcentual", "Estado_Facturacion", "Alerta_Spread",
        )
    )
    totals = detail.groupBy(*keys).agg(
        sum0("Facturado_Valor").alias("Total_Facturado"),
        sum0("Consumido_Valor").alias("Total_Consumido"),
        sum0("Margen_Bruto").alias("Margen_Total"),
        F.count_if(F.col("Estado_Facturacion").isin(ALERT_STATES)).alias("Registros_Con_Alerta"),
        F.count_if(F.col("Estado_Facturacion") == "SIN_FACTURAR").alias("Productos_Sin_Facturar"),
        F.count_if(F.col("Alerta_Spread") == "SPREAD_ANOMALO").alias("Spreads_Anomalos"),
    )
    # distinct values alone are narrow rows; next to the sums they would carry all of those
    listed = F.array(
        F.struct(F.lit(True).alias("patient"), F.col("idadmision").cast("string").alias("value")),
        F.struct(F.lit(False).alias("patient"), F.col("No_Factura").alias("value")),
    )
    distinct = detail.select(*keys, F.explode(listed).alias("_v")).select(*keys, "_v.*").distinct()
    unique = distinct.groupBy(*keys).agg(
        F.count_if("patient").alias("Pacientes_Atendidos"), F.count_if(~F.col("patient")).alias("Facturas_Unicas")
    )
    medians = grouped_medians(
        detail, keys, {"Ratio_Fact_Consumo": "Ratio_Mediano", "Margen_Porcentual": "Margen_Mediano_Pct"}
    )
    overall = F.col("Ratio_Global")
    first = totals.columns.index("Registros_Con_Alerta")
    columns = [*totals.columns[:first], "Pacientes_Atendidos", "Facturas_Unicas", *totals.columns[first:]]
    return (
        null_safe_join(null_safe_join(totals, unique, keys).select(*columns), medians, keys)
        .withColumn("Ratio_Global", ratio_if_positive("Total_Facturado", "Total_Consumido"))
        .withColumn(
            "Alerta_Servicio",
            first_match(
                [(overall < 0.8, "SUB_FACTURACION_SERVICIO"), (overall > 1.3, "SOBRE_FACTURACION_SERVICIO")],
                "EQUILIBRADO_SERVICIO",
            ),
        )
    )


def critical_patient_alerts(detail: DataFrame) -> DataFrame:
    """What was not billed or far too little, per admission, site, service, specialty and doctor."""
    return (
        detail.where(F.col("Estado_Facturacion").isin(CRITICAL_STATES))
        .groupBy("idadmision", "Municipio", "Servicio_Corregido", "Especialidad", "MedicoRealiza")
        .agg(
            sum0("Margen_Bruto").alias("Margen_Perdido_Total"),
            sum0("Facturado_Valor").alias("Facturado_Paciente"),
            sum0("Consumido_Valor").alias("Consumido_Paciente"),
            n_unique("CodigoGenerico").alias("Productos_Afectados"),
            F.min("No_Factura").alias("Factura_Principal"),
        )
    )


# --- purchases, sales and consumption --------------------------------------------------------


def detect_purchases(receipts: DataFrame) -> DataFrame:
    """Receipts whose voucher speaks of a purchase or an entry."""
    return receipts.where(F.lower("Comprobante").rlike("compra|entrada"))


def _purchase_figures(purchases: DataFrame) -> DataFrame:
    """Prices, totals and suppliers per product and site.

    The most frequent supplier is the first by name among equals; a missing one counts as a
    supplier and comes first.
    """
    price, supplier = "ValorUnitario", "Proveedor"
    figures = grouped_medians(
        purchases,
        SITE_PRODUCT,
        {price: "Precio_Compra_Mediana"},
        [
            mean(price).alias("Precio_Compra_Prom"),
            F.min(price).cast("double").alias("Precio_Compra_Min"),
            F.max(price).cast("double").alias("Precio_Compra_Max"),
            sum0("Cantidad").alias("Compras_Cantidad"),
            sum0("ValorTotal").alias("Compras_Valor"),
        ],
    )
    lines = purchases.groupBy(*SITE_PRODUCT, supplier).agg(F.count(F.lit(1)).alias("_lines"))
    suppliers = lines.groupBy(*SITE_PRODUCT).agg(
        F.count(F.lit(1)).alias("Num_Proveedores"),
        F.min(F.struct(-F.col("_lines"), supplier)).getField(supplier).alias("Proveedor_Principal"),
    )
    return null_safe_join(figures, suppliers, SITE_PRODUCT)


def purchase_sale_detail(purchases: DataFrame, billing: DataFrame, consumption: DataFrame, keep: Keep = as_is) -> DataFrame:
    """Purchase price, sale price and consumption per product and site, with margins and alerts.

    All three sides are aggregated on the same keys before they are joined. Sales and consumption of what was
    not purchased are in no row of the result, so they are left out before they are aggregated. `keep` is
    applied to the narrow columns of the purchases and of their sales, which are read several times.
    """
    if "ValorUnitario" not in purchases.columns and "PrecioCompra" in purchases.columns:
        purchases = purchases.withColumnRenamed("PrecioCompra", "ValorUnitario")
    purchases = keep(purchases.select(*SITE_PRODUCT, "Proveedor", "ValorUnitario", "Cantidad", "ValorTotal"))
    bought_at = purchases.select(*SITE_PRODUCT).distinct().withColumn("_split", split_key("Nombre"))

    def purchased(lines: DataFrame, *read: str) -> DataFrame:
        keyed = lines.select(*SITE_PRODUCT, *read).withColumn("_split", split_key("Nombre"))
        return keyed.join(bought_at, [*SITE_PRODUCT, "_split"], "left_semi").drop("_split")

    sold = grouped_medians(
        keep(purchased(billing, "billed_unit_price", "billed_value", "billed_qty")),
        SITE_PRODUCT,
        {"billed_unit_price": "Precio_Venta_Mediana"},
        [
            mean("billed_unit_price").alias("Precio_Venta_Prom"),
            sum0("billed_value").alias("Facturacion_Valor"),
            sum0("billed_qty").alias("Facturacion_Cantidad"),
        ],
    )
    used = purchased(consumption, "ValorUnitario", "Cantidad", "ValorTotal").groupBy(*SITE_PRODUCT).agg(
        mean("ValorUnitario").alias("Costo_Consumo_Prom"),
        sum0("Cantidad").alias("Consumo_Cantidad"),
        sum0("ValorTotal").alias("Consumo_Valor"),
    )
    joined = _purchase_figures(purchases).join(sold, SITE_PRODUCT, "left").join(used, SITE_PRODUCT, "left")
    bought, paid = F.col("Compras_Cantidad"), F.col("Precio_Compra_Prom")
    unit_margin = F.col("Precio_Venta_Prom") - paid
    margin = F.col("Facturacion_Valor") - F.col("Compras_Valor")
    figures = zero_nulls(joined).withColumns(
        {
            "Margen_Unitario_Prom": unit_margin,
            "Margen_Unitario_Mediana": F.col("Precio_Venta_Mediana") - F.col("Precio_Compra_Mediana"),
            "Margen_Porcentual_Prom": ratio_if_positive(unit_margin, paid) * 100,
            "Margen_Total": margin,
            "Margen_Total_Pct": ratio_if_positive(margin, "Compras_Valor") * 100,
            "Diff_Cant_Compra_Venta": bought - F.col("Facturacion_Cantidad"),
            "Diff_Cant_Compra_Consumo": bought - F.col("Consumo_Cantidad"),
            "Ratio_Consumo_Compra": ratio_if_positive("Consumo_Cantidad", bought),
            "Ratio_Venta_Compra": ratio_if_positive("Facturacion_Cantidad", bought),
            "Spread_Compra_Consumo": paid - F.col("Costo_Consumo_Prom"),
        }
    )
    pct, used_share, sold_share = (
        F.col("Margen_Porcentual_Prom"),
        F.col("Ratio_Consumo_Compra"),
        F.col("Ratio_Venta_Compra"),
    )
    return figures.withColumns(
        {
            "Alerta_Margen": first_match(
                [(pct.isNull(), "SIN_VENTA"), (pct < 0, "PERDIDA"), (pct < 10, "MARGEN_BAJO"), (pct < 30, "MARGEN_NORMAL")],
                "MARGEN_ALTO",
            ),
            "Alerta_Eficiencia_Compra": first_match(
                [
                    (bought == 0, "SIN_COMPRA"),
                    (used_share.isNull(), "SIN_CONSUMO"),
                    (used_share < 0.5, "SOBRE_COMPRA_CRITICA"),
                    (used_share < 0.8, "SOBRE_COMPRA"),
                    (used_share <= 1.1, "OPTIMO"),
                ],
                "DESABASTECIMIENTO",
            ),
            "Alerta_Rotacion_Venta": first_match(
                [(sold_share.isNull(), "SIN_VENTA"), (sold_share < 0.7, "BAJA_ROTACION_VENTA"), (sold_share <= 1.2, "NORMAL")],
                "VENTA_SUPERIOR_COMPRA",
            ),
            "Valor_Stock_Muerto_Estimado": F.greatest(F.col("Diff_Cant_Compra_Consumo"), F.lit(0)) * paid,
        }
    )


def purchase_summary_by_service(detail: DataFrame, keep: Keep = as_is) -> DataFrame:
    """The detail per site and service; `keep` is applied to its narrow columns, as in the billing gap's."""
    keys = ["Municipio", "Servicio"]
    detail = keep(
        detail.select(
            *keys, "CodigoGenerico", "Compras_Valor", "Facturacion_Valor", "Consumo_Valor", "Margen_Total",
            "Valor_Stock_Muerto_Estimado", "Margen_Porcentual_Prom", "Ratio_Consumo_Compra", "Alerta_Margen",
            "Alerta_Eficiencia_Compra",
        )
    )
    totals = detail.groupBy(*keys).agg(
        sum0("Compras_Valor").alias("Total_Compras"),
        sum0("Facturacion_Valor").alias("Total_Facturacion"),
        sum0("Consumo_Valor").alias("Total_Consumo"),
        sum0("Margen_Total").alias("Margen_Total_Servicio"),
        sum0("Valor_Stock_Muerto_Estimado").alias("Total_Stock_Muerto"),
        F.count_if(F.col("Alerta_Margen").isin("PERDIDA", "MARGEN_BAJO")).alias("Productos_Margen_Bajo"),
        F.count_if(F.col("Alerta_Eficiencia_Compra").isin("SOBRE_COMPRA_CRITICA", "SOBRE_COMPRA")).alias(
            "Productos_Sobre_Compra"
        ),
        n_unique("CodigoGenerico").alias("Num_Productos"),
    )
    medians = grouped_medians(
        detail, keys, {"Margen_Porcentual_Prom": "Margen_Mediano_Pct", "Ratio_Consumo_Compra": "Eficiencia_Mediana"}
    )
    return null_safe_join(totals, medians, keys).withColumns(
        {
            "Ratio_Venta_Compra_Servicio": ratio_if_positive("Total_Facturacion", "Total_Compras"),
            "Ratio_Consumo_Compra_Servicio": ratio_if_positive("Total_Consumo", "Total_Compras"),
        }
    )


TOP_COLUMNS = [
    "CodigoGenerico", "Nombre", "Municipio", "Servicio", "Proveedor_Principal", "Precio_Compra_Prom",
    "Precio_Venta_Prom", "Margen_Unitario_Prom", "Margen_Porcentual_Prom", "Compras_Cantidad",
    "Consumo_Cantidad", "Diff_Cant_Compra_Consumo", "Valor_Stock_Muerto_Estimado",
    "Alerta_Eficiencia_Compra", "Alerta_Margen",
]


def top_dead_stock(detail: DataFrame, n: int = 50) -> DataFrame:
    """The `n` rows with the most estimated dead stock; equal amounts in key order."""
    return (
        detail.where(F.col("Valor_Stock_Muerto_Estimado") > 0)
        .orderBy(F.desc("Valor_Stock_Muerto_Estimado"), *SITE_PRODUCT)
        .limit(n)
        .select(*TOP_COLUMNS)
    )


# --- the whole report ------------------------------------------------------------------------


def stack(*frames: DataFrame) -> DataFrame:
    """Union by name; columns one frame lacks are NULL, columns of differing types become text."""
    types: dict[str, set[str]] = {}
    for df in frames:
        for name, kind in df.dtypes:
            types.setdefault(name, set()).add(kind)
    mixed = {name for name, kinds in types.items() if len(kinds) > 1 and "string" in kinds}
    aligned = [df.withColumns({c: F.col(f"`{c}`").cast("string") for c in df.columns if c in mixed}) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def financial_inputs(datasets: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Consumption, receipts and billing of the financial report from the prepared datasets."""
    return (
        stack(datasets["billed"], datasets["internal_out"]),
        stack(datasets["returns"], datasets["internal_in"]),
        datasets["billed"],
    )


def financial_report(
    consumption: DataFrame,
    receipts: DataFrame,
    billing: DataFrame,
    keys: str = REFERENCE,
    keep: Keep = as_is,
) -> dict[str, DataFrame]:
    """All nine tables; the last three are empty when no receipt is a purchase.

    `keep` is applied to the detail tables and groups that are read several times; a job passes `materialize`.
    """
    stock = keep(stock_efficiency_detail(consumption, receipts, keys))
    gap = keep(billing_gap_detail(billing, consumption, keys))
    margins = keep(purchase_sale_detail(detect_purchases(receipts), billing, consumption, keep))
    return {
        "varianza_proveedor": supplier_price_variance(consumption, keep),
        "eficiencia_stock_detalle": stock,
        "eficiencia_stock_resumen": stock_efficiency_summary(stock),
        "gap_fact_consumo_detalle": gap,
        "gap_fact_consumo_resumen": billing_gap_summary(gap),
        "alertas_pacientes_criticos": critical_patient_alerts(gap),
        "compras_ventas_consumo_detalle": margins,
        "compras_ventas_resumen_servicio": purchase_summary_by_service(margins),
        "top_stock_muerto_estimado": top_dead_stock(margins),
    }
