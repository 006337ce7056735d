"""One query per operator over the whole driver tables.

Every result is made portable: decimals as doubles, dates as text, integers as bigint, and
means, medians and deviations rounded to six places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger import schemas, vocab
from stockledger.functions.distributed import materialize
from stockledger.operators import (
    audit,
    consumption,
    deviations,
    finance,
    ledger,
    loans,
    monthly,
    movements,
    profit,
    purchases,
    reconcile,
    report,
)
from stockledger.sources import demo, landing

Query = Callable[[SparkSession, str], DataFrame]
MONTHS = list(range(1, 13))


def portable(df: DataFrame, rounded: tuple[str, ...] = ()) -> DataFrame:
    def column(name: str, kind: str):
        c = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            c = c.cast("double")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        if name in rounded:
            c = F.round(c.cast("double"), 6)
        return c.alias(name)

    return df.select(*[column(n, k) for n, k in df.dtypes])


# --- shared inputs ---------------------------------------------------------------------------


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.classified_ledger(demo.ledger_lines(spark, sf_dir), demo.MONEY)


def _net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases.net_purchases(_ledger(spark, sf_dir))


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.monthly_lines(_ledger(spark, sf_dir))


def _prepared(spark: SparkSession, sf_dir: str, meet: bool = False) -> dict[str, DataFrame]:
    extract = demo.movement_extract(spark, sf_dir)
    # a list of names; written, Spark knows how short it is and need not shuffle the joined rows to it
    entities = materialize(demo.entities(spark, sf_dir))
    return consumption.prepare_consumption(
        extract,
        extract,
        demo.billing_lines(spark, sf_dir),
        demo.listing(spark, sf_dir),
        entities,
        demo.FINE_MONEY,
        meet=meet,
    )


def _product_lines(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Movement lines with cost centre parts and product: what went out and what came in."""
    items = consumption.product_listing(demo.listing(spark, sf_dir)).withColumn(
        "CodigoGenerico", F.col("CodigoGenerico").cast("bigint")
    )
    fields = consumption.movement_fields(demo.movement_extract(spark, sf_dir))
    lines = fields.join(items, F.col("CodArticulo") == F.col("Codigo"), "left").drop("Codigo")
    voucher = F.col("Comprobante")
    return {
        "out": lines.where(voucher.isin(vocab.DISPENSED, *vocab.INTERNAL_OUT)),
        "in": lines.where(voucher.isin(vocab.RETURNED, *vocab.INTERNAL_IN)),
    }


def _stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _product_lines(spark, sf_dir)
    return finance.stock_efficiency_detail(lines["out"], lines["in"])


def _gap(spark: SparkSession, sf_dir: str, keys: str = finance.REFERENCE) -> DataFrame:
    return finance.billing_gap_detail(
        demo.site_billing(spark, sf_dir), _product_lines(spark, sf_dir)["out"], keys
    )


def _margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _product_lines(spark, sf_dir)
    return finance.purchase_sale_detail(
        finance.detect_purchases(lines["in"]), demo.site_billing(spark, sf_dir), lines["out"], materialize
    )


def _report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _prepared(spark, sf_dir)
    return report.class_totals(data["billed"], data["returns"], data["internal_out"], data["internal_in"])


def _net_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.net_report(_report_totals(spark, sf_dir))


# --- queries ---------------------------------------------------------------------------------


def _ledger_queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "ledger_prepare": lambda s, d: portable(
            ledger.prepare_ledger(demo.ledger_lines(s, d), demo.MONEY)
            .groupBy("Año", "Mes", "Dia", "Comprobante_corregido")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum("Cantidad").alias("qty"),
                F.sum("ValorTotal").alias("val"),
                F.min("Fecha").alias("first_day"),
            )
        ),
        "voucher_family_counts": lambda s, d: portable(ledger.family_counts(_ledger(s, d))),
        "unclassified_count": lambda s, d: portable(ledger.unclassified_count(_ledger(s, d))),
        "net_purchases": lambda s, d: portable(_net(s, d)),
        "purchases_by_supplier": lambda s, d: portable(purchases.purchases_by_supplier(_net(s, d))),
        "largest_purchases": lambda s, d: portable(purchases.largest_purchases(_net(s, d))),
        "most_purchased": lambda s, d: portable(purchases.most_purchased_products(_net(s, d))),
        "monthly_purchase_behaviour": lambda s, d: portable(
            purchases.monthly_purchase_behaviour(_net(s, d), MONTHS)
        ),
        "lent_balance": lambda s, d: portable(loans.lent_balance(_ledger(s, d))),
        "borrowed_balance": lambda s, d: portable(loans.borrowed_balance(_ledger(s, d))),
        "movement_by_product": lambda s, d: portable(movements.movement_by_product(_ledger(s, d))),
        "movement_by_warehouse_product": lambda s, d: portable(
            movements.movement_by_warehouse_product(_ledger(s, d))
        ),
        "monthly_qty": lambda s, d: portable(monthly.monthly_qty(_monthly(s, d), MONTHS)),
        "monthly_value": lambda s, d: portable(monthly.monthly_value(_monthly(s, d), MONTHS)),
        "abc_pareto": lambda s, d: portable(monthly.abc_pareto(_monthly(s, d))),
        "demand_variability": lambda s, d: portable(
            monthly.demand_variability(_monthly(s, d), MONTHS), ("Desviacion_Estandar", "Coeficiente_Variacion")
        ),
        "consumption_by_warehouse": lambda s, d: portable(
            monthly.consumption_by_warehouse(_monthly(s, d), MONTHS)
        ),
    }
    for family in vocab.FAMILIES:
        out[f"net_by_voucher_{family}"] = lambda s, d, f=family: portable(ledger.net_by_voucher(_ledger(s, d), f))
    return out


def _movement_fields(s: SparkSession, d: str) -> DataFrame:
    lines = consumption.movement_fields(demo.movement_extract(s, d))
    keys = ["Clasificacion_consumo", "Municipio", "Servicio", "Tipo_servicio"]
    return portable(
        lines.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("field_1").cast("bigint")).alias("admissions"),
            F.count_if(F.col("field_1") == 0).alias("without_admission"),
        )
    )


def _extract_quality(s: SparkSession, d: str) -> DataFrame:
    return portable(consumption.extract_quality(consumption.movement_fields(demo.movement_extract(s, d))))


def _grain(role: str) -> Query:
    def query(s: SparkSession, d: str) -> DataFrame:
        lines = consumption.movement_fields(demo.movement_extract(s, d))
        return portable(consumption.enrich_and_grain(consumption.split_by_voucher(lines, lines)[role], demo.listing(s, d)))

    return query


def _dataset(name: str, *columns: str) -> Query:
    def query(s: SparkSession, d: str) -> DataFrame:
        df = _prepared(s, d)[name]
        df = df.select(*columns) if columns else df
        # whole numbers that are missing on unbilled rows compare as doubles
        partly = {c: F.col(c).cast("double") for c in ("idadmision", "billed_qty", "requested_qty") if c in df.columns}
        return portable(df.withColumns(partly))

    return query


def _audit(*rules: int) -> Query:
    return lambda s, d: portable(
        audit.audit(_prepared(s, d)["billed"], demo.entities(s, d), list(rules) or None)
    )


def _reconciliation(s: SparkSession, d: str) -> DataFrame:
    extract = demo.movement_extract(s, d)
    return portable(reconcile.reconcile(extract, extract, _net_report(s, d), money=demo.MONEY))


def _profitability(s: SparkSession, d: str) -> DataFrame:
    data = _prepared(s, d, meet=True)
    return portable(profit.profitability(data["returns"], data["profitability_input"]))


CORRECTED = ["ADM-CodGen", "Comprobante", "CentroCosto", "Servicio", "Especialidad", "MedicoRealiza", "Servicio_Corregido", "ValorTotal"]


def _corrected(s: SparkSession, d: str) -> DataFrame:
    data = _prepared(s, d)
    return portable(
        consumption.corrected_service(data["profitability_input"], demo.entities(s, d)).select(*CORRECTED)
    )


def _consumption_queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "movement_fields": _movement_fields,
        "extract_quality": _extract_quality,
        "product_listing": lambda s, d: portable(consumption.product_listing(demo.listing(s, d))),
        "billing_by_admission": lambda s, d: portable(
            consumption.billing_by_admission(demo.billing_lines(s, d), demo.FINE_MONEY)
        ),
        "dispensed_grain": _grain("dispensed"),
        "returns_grain": _grain("returned"),
        "consumption_with_billing": _dataset("profitability_input"),
        "returns_attributed": _dataset("returns"),
        "corrected_service": _corrected,
        "unclosed_billing": _dataset("unclosed"),
        "specialty_override": _dataset("billed", *CORRECTED),
        "control_totals": lambda s, d: portable(consumption.control_totals(_prepared(s, d))),
        "audit_all": _audit(),
        "quantity_deviations": lambda s, d: portable(
            deviations.quantity_deviations(_prepared(s, d)["billed"]),
            ("Cantidad_media", "Cantidad_std", "Desviacion_media", "Desviacion_std"),
        ),
        "class_totals": lambda s, d: portable(_report_totals(s, d)),
        "profitability": _profitability,
        "reconciliation": _reconciliation,
    }
    for rule in vocab.AUDIT_RULES:
        out[f"audit_rule_{rule}"] = _audit(rule)
    tables = {
        "report_medicines": "consumos_medicamentos",
        "report_devices_billed": "consumos_dispositivos_formulados",
        "report_devices_internal": "consumo_dispositivos",
        "report_supplies": "consumos_suministros",
    }
    for name, table in tables.items():
        out[name] = lambda s, d, t=table: portable(report.report_table(_net_report(s, d), t))
    return out


PRICE_ROUNDED = (
    "Costo_Mediano", "Costo_Promedio", "Desv_Estandar", "CV_Costo", "Rango_Porcentual", "Diferencia_Absoluta",
    "Precio_Promedio_Proveedor", "Mediana_Mercado", "Desviacion_Vs_Mercado_Pct", "Desviacion_Vs_Mercado_Abs",
)
MARGIN_ROUNDED = (
    "Precio_Compra_Prom", "Precio_Compra_Mediana", "Precio_Venta_Prom", "Precio_Venta_Mediana",
    "Margen_Unitario_Prom", "Margen_Unitario_Mediana", "Margen_Porcentual_Prom", "Spread_Compra_Consumo",
    "Costo_Consumo_Prom", "Valor_Stock_Muerto_Estimado", "Margen_Total_Pct",
)
SUMMARY_ROUNDED = ("Total_Stock_Muerto", "Margen_Mediano_Pct", "Eficiencia_Mediana")


def _finance_queries() -> dict[str, Query]:
    return {
        "supplier_price_variance": lambda s, d: portable(
            finance.supplier_price_variance(_product_lines(s, d)["out"], materialize), PRICE_ROUNDED
        ),
        "stock_efficiency_detail": lambda s, d: portable(_stock(s, d)),
        "stock_efficiency_summary": lambda s, d: portable(finance.stock_efficiency_summary(_stock(s, d))),
        "billing_gap_detail": lambda s, d: portable(_gap(s, d)),
        "billing_gap_detail_coalesced": lambda s, d: portable(_gap(s, d, finance.COALESCED)),
        "billing_gap_summary": lambda s, d: portable(
            finance.billing_gap_summary(_gap(s, d), materialize), ("Ratio_Mediano", "Margen_Mediano_Pct")
        ),
        "critical_alerts": lambda s, d: portable(finance.critical_patient_alerts(_gap(s, d))),
        "purchase_sale_detail": lambda s, d: portable(_margins(s, d), MARGIN_ROUNDED),
        "purchase_summary": lambda s, d: portable(
            finance.purchase_summary_by_service(_margins(s, d), materialize), SUMMARY_ROUNDED
        ),
        "top_dead_stock": lambda s, d: portable(finance.top_dead_stock(_margins(s, d)), MARGIN_ROUNDED),
    }


def _financial_report_queries() -> dict[str, Query]:
    """Tables of the financial report on the datasets that the consumption job prepares."""

    def inputs(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        return finance.financial_inputs(_prepared(s, d))

    def stock(s: SparkSession, d: str) -> DataFrame:
        used, received, _ = inputs(s, d)
        return finance.stock_efficiency_detail(used, received)

    def gap(s: SparkSession, d: str) -> DataFrame:
        """The billed rows are both sides of the gap, so what it reads of them is written once."""
        data = _prepared(s, d)
        read = [*finance.GAP_KEYS, "field_1", *finance.GAP_BILLED, *finance.GAP_CONSUMED, *finance.GAP_ATTRIBUTES.values()]
        data["billed"] = materialize(data["billed"].select(*read))
        used, _, billed = finance.financial_inputs(data)
        return finance.billing_gap_detail(billed, used)

    prices = ("Precio_Facturado_Prom", "Costo_Unitario_Prom", "Spread_Precio_Costo")
    medians = ("Ratio_Mediano", "Margen_Mediano_Pct")
    return {
        "financial_report_stock_summary": lambda s, d: portable(finance.stock_efficiency_summary(stock(s, d))),
        "financial_report_gap": lambda s, d: portable(gap(s, d), prices),
        "financial_report_gap_summary": lambda s, d: portable(finance.billing_gap_summary(gap(s, d), materialize), medians),
        "financial_report_alerts": lambda s, d: portable(finance.critical_patient_alerts(gap(s, d))),
    }


def _period_normalised(s: SparkSession, d: str) -> DataFrame:
    raw = F.date_format("o_orderdate", "d-M-yyyy")
    days = demo.table(s, d, "orders").select(
        landing.normalize_period(raw).alias("periodo"), landing.period_month(raw).alias("mes")
    )
    return portable(days.groupBy("periodo", "mes").agg(F.count(F.lit(1)).alias("n")))


def _source_lineage(s: SparkSession, d: str) -> DataFrame:
    names = ["lineitem", "orders", "part"]
    lines = [landing.with_source_file(demo.table(s, d, n)).select(landing.SOURCE_FILE) for n in names]
    whole = lines[0].unionByName(lines[1]).unionByName(lines[2])
    return portable(whole.groupBy(landing.SOURCE_FILE).agg(F.count(F.lit(1)).alias("registros")))


def _ledger_from_files(s: SparkSession, d: str) -> DataFrame:
    """Lines read back from files of differing types."""
    ddl = schemas.LEDGER_DDL.replace("double", demo.MONEY)
    lines = landing.ingest_ledger(s, demo.landed_ledger(s, d), ddl=ddl)
    sums = lines.groupBy("Estado", "CodigoGenerico", "GrupoInventario").agg(
        F.count(F.lit(1)).alias("registros"), F.sum("Cantidad").alias("Cantidad"), F.sum("ValorTotal").alias("ValorTotal")
    )
    return portable(sums)


def _billing_rejects(s: SparkSession, d: str) -> DataFrame:
    """What is not accepted of billing lines, by column and text, and what is."""
    landed = landing.read_landed(s, demo.landed_billing(s, d), "csv", T.StructType.fromDDL(schemas.BILLING_DDL))
    column = F.coalesce("column", F.lit("(line)"))
    rejected = landed.rejected().groupBy(
        column.alias("column"), F.when(F.col("column").isNotNull(), F.col("text")).alias("text"), "reason"
    )
    accepted = landed.accepted().agg(
        F.lit("(accepted)").alias("column"),
        F.sum("cantidad").cast("string").alias("text"),
        F.lit(None).cast("string").alias("reason"),
        F.count(F.lit(1)).alias("n"),
    )
    return portable(rejected.agg(F.count(F.lit(1)).alias("n")).unionByName(accepted))


def all_queries() -> dict[str, Query]:
    return {
        **_ledger_queries(),
        **_consumption_queries(),
        **_finance_queries(),
        **_financial_report_queries(),
        "period_normalised": _period_normalised,
        "source_lineage": _source_lineage,
        "ledger_from_files": _ledger_from_files,
        "billing_rejects": _billing_rejects,
    }
