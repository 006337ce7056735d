"""The two report jobs: inputs in, one dataset per report table out."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger import schemas, vocab
from stockledger.functions.distributed import Scratch, materialize
from stockledger.operators import (
    audit,
    consumption,
    cube,
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
from stockledger.sources import landing
from stockledger.sources.sinks import period_name, publish, write_report

log = logging.getLogger(__name__)


def _desc(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_first() for n in names]


def _asc(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_first() for n in names]


def report_orders() -> dict[str, list[Column]]:
    """The order each report table is written in. Sorting is for readers, so only sinks do it.

    Every order ends in the table's keys: rows that tie on the first columns then still spread
    over the range partitions of the sort.
    """
    product, supplier = _asc(*vocab.PRODUCT), _asc(*finance.SUPPLIER_KEYS)
    site = _asc("Municipio", "Servicio")
    stock, gap = finance.STOCK_KEYS, finance.GAP_KEYS
    patient = _asc("idadmision", "Municipio", "Servicio_Corregido", "Especialidad", "MedicoRealiza")
    return {
        "Mayor_compra": _desc("valor_total_comprado_neto") + product + _asc("Tercero"),
        "producto_mas_comprado": _desc("cantidad_comprada_neta") + product,
        "Clasificacion_ABC_Pareto": _desc("Valor_Total_Consumido") + product,
        **{name: site for name in report.TABLES},
        "varianza_proveedor": _desc("Nivel_Riesgo_Variabilidad", "Volumen_Total") + supplier,
        "eficiencia_stock_detalle": _desc("Estado_Inventario", "Valor_Stock_Muerto")
        + _asc(*stock, *[f"{k}_right" for k in stock]),
        "eficiencia_stock_resumen": _desc("Total_Stock_Muerto_Valor") + site + _asc("Clasificacion_consumo"),
        "gap_fact_consumo_detalle": _asc("Estado_Facturacion", "Margen_Bruto", *gap, *[f"{k}_right" for k in gap]),
        "gap_fact_consumo_resumen": _asc("Margen_Total", "Municipio", "Servicio_Corregido", "Especialidad"),
        "alertas_pacientes_criticos": _asc("Margen_Perdido_Total") + patient,
        "compras_ventas_consumo_detalle": _desc("Alerta_Margen", "Margen_Total") + _asc(*finance.SITE_PRODUCT),
        "compras_ventas_resumen_servicio": _desc("Total_Stock_Muerto") + site,
        "top_stock_muerto_estimado": _desc("Valor_Stock_Muerto_Estimado") + _asc(*finance.SITE_PRODUCT),
    }


class Publication:
    """The tables of one run, written aside and published together."""

    def __init__(self, spark: SparkSession, out: str, period: str, fmt: str, orders: Mapping[str, list[Column]]):
        self.spark, self.out, self.period, self.fmt, self.orders = spark, out, period, fmt, orders
        self.run, self.reports = uuid.uuid4().hex, {}

    def write(self, report: str, tables: Mapping[str, DataFrame]) -> dict[str, str]:
        path = f"{self.out.rstrip('/')}/{report}/period={self.period}/run={self.run}"
        self.reports[report] = write_report(tables, path, self.fmt, self.orders)
        return self.reports[report]

    def after(self, status: dict) -> dict:
        """Publishes what a run has written if all its steps succeeded."""
        if status["exitoso"]:
            final = _run([("publicacion", lambda: publish(self.spark, self.out, self.period, self.run, self.reports, self.fmt))])
            status = {**status, "exitoso": final["exitoso"], "error": final["error"]}
        return {**status, "corrida": self.run}


def _run(steps: list[tuple[str, Callable[[], Mapping | None]]]) -> dict:
    """Runs the steps in order; the first failure ends the run and is in the result."""
    status: dict = {"exitoso": False, "pasos": {}, "error": None}
    for name, step in steps:
        try:
            status["pasos"][name] = step()
        except Exception as error:
            log.exception("step %s failed", name)
            status["error"] = f"{name}: {error}"
            return status
    status["exitoso"] = True
    return status


def purchase_tables(lines: DataFrame, months: list[int] | None = None) -> dict[str, DataFrame]:
    net = purchases.net_purchases(lines)
    return {
        "Informe_por_proveedor": purchases.purchases_by_supplier(net),
        "Mayor_compra": purchases.largest_purchases(net),
        "producto_mas_comprado": purchases.most_purchased_products(net),
        "comportamientos_mensuales": purchases.monthly_purchase_behaviour(net, months),
    }


def loan_tables(lines: DataFrame) -> dict[str, DataFrame]:
    return {
        "prestamos_realizados": loans.lent_balance(lines),
        "prestamos_recibidos": loans.borrowed_balance(lines),
    }


def movement_tables(lines: DataFrame) -> dict[str, DataFrame]:
    return {
        "Movimiento_agrupado": movements.movement_by_product(lines),
        "Movimiento_detallado": movements.movement_by_warehouse_product(lines),
    }


def monthly_tables(lines: DataFrame, months: list[int] | None = None) -> dict[str, DataFrame]:
    used = monthly.monthly_lines(lines)
    months = monthly.present_months(used) if months is None else months
    if not months:
        return {}
    return {
        "Consumo_Mensual_Cantidades": monthly.monthly_qty(used, months),
        "Consumo_Mensual_Valores": monthly.monthly_value(used, months),
        "Clasificacion_ABC_Pareto": monthly.abc_pareto(used),
        "Variabilidad_por_Bodega": monthly.demand_variability(used, months),
        "Consumo_por_Bodega": monthly.consumption_by_warehouse(used, months),
    }


def run_inventory_job(
    raw: DataFrame, out: str, day: str, money: str = "decimal(18,2)", fmt: str = "parquet", earlier: Iterable[DataFrame] = ()
) -> dict:
    """Ledger lines to the purchase, loan, movement and monthly reports below `out`.

    The ledger is read from its source once, and summed to a cube that all reports read. The cube is
    published with them as `cubo`. With the cubes of `earlier` periods the reports cover those too,
    and their lines are not read again.
    """
    landing.require_columns(raw, schemas.LEDGER_NEEDED, "the ledger")
    shown = Publication(raw.sparkSession, out, period_name(day), fmt, report_orders())
    with Scratch(raw.sparkSession):
        fresh = cube.ledger_cube(ledger.classified_ledger(raw, money))
        lines = materialize(cube.merge_cubes(fresh, *earlier) if earlier else fresh)

        def classification() -> dict:
            counts = {r.family or "pendientes": r.registros for r in ledger.family_counts(lines).collect()}
            netted = {f"neto_{word}": ledger.net_by_voucher(lines, f) for f, word in vocab.FAMILY_WORDS.items()}
            return {"registros": counts, **shown.write("netos", netted)}

        return shown.after(
            _run(
                [
                    ("clasificacion", classification),
                    ("compras", lambda: shown.write("compras", purchase_tables(lines))),
                    ("prestamos", lambda: shown.write("prestamos", loan_tables(lines))),
                    ("movimientos", lambda: shown.write("movimientos", movement_tables(lines))),
                    ("consumos_mensuales", lambda: shown.write("consumos_mensuales", monthly_tables(lines))),
                    ("cubo", lambda: shown.write("cubo", {"cubo": lines})),
                ]
            )
        )


def run_consumption_job(
    extracts: Mapping[str, DataFrame],
    entities: DataFrame,
    out: str,
    start: str,
    end: str,
    money: str = "decimal(18,2)",
    fmt: str = "parquet",
    with_finance: bool = False,
) -> dict:
    """Extracts (`billing`, `out`, `in`, `listing`) to the consumption reports below `out`.

    Prices and values become `money` first. As decimals their sums do not depend on row order, so
    neither does the net report, which cuts them to whole units.
    """
    shown = Publication(entities.sparkSession, out, period_name(start, end), fmt, report_orders())
    measures = ("ValorUnitario", "TotalBruto", "ValorIVA", "ValorDescuento", "ValorTotal")
    typed = {role: extracts[role].withColumns({c: F.col(c).cast(money) for c in measures}) for role in ("out", "in")}
    extracts = {**extracts, **typed}
    with Scratch(entities.sparkSession):
        data = consumption.prepare_consumption(
            extracts["out"], extracts["in"], extracts["billing"], extracts["listing"], entities, money, materialize
        )
        for name in ("billed", "returns"):
            data[name] = materialize(data[name])
        data["billed_clean"] = data["billed"]
        net: dict[str, DataFrame] = {}

        def one(name: str, df: DataFrame) -> dict[str, str]:
            return shown.write(name, {name: df})

        def totals() -> dict:
            rows = consumption.control_totals(data).collect()
            counts = {r.conjunto: {"filas": r.filas, "ValorTotal": r.ValorTotal} for r in rows}
            return {"totales": counts, **one("medicos_nulos", data["unclosed"])}

        def net_report() -> dict[str, str]:
            net["report"] = materialize(
                report.net_report(
                    report.class_totals(data["billed"], data["returns"], data["internal_out"], data["internal_in"])
                )
            )
            tables = {name: report.report_table(net["report"], name) for name in report.TABLES}
            return shown.write("informe", tables)

        def reconciliation() -> dict:
            return reconcile.reconcile(extracts["out"], extracts["in"], net["report"], money=money).first().asDict()

        def financial() -> dict[str, str]:
            used, received, billed = finance.financial_inputs(data)
            tables = finance.financial_report(used, received, billed, keep=materialize)
            return shown.write("analisis_financiero", tables)

        steps: list[tuple[str, Callable[[], Mapping | None]]] = [
            ("carga", totals),
            ("auditoria", lambda: one("inconsistencias", audit.audit(data["billed"], entities))),
            ("desviaciones", lambda: one("desviaciones", deviations.quantity_deviations(data["billed"]))),
            ("informe", net_report),
            ("rentabilidad", lambda: one("rentabilidad", profit.profitability(data["returns"], data["profitability_input"]))),
            ("conciliacion", reconciliation),
        ]
        if with_finance:
            steps.append(("analisis_financiero", financial))
        return shown.after(_run(steps))


def _after_reading(read: Callable[[], object], job: Callable[[object], dict], step: str) -> dict:
    """Reads the inputs as the job's first step, so that a missing source is in the result too."""
    inputs: list = []
    status = _run([(step, lambda: inputs.append(read()))])
    if not status["exitoso"]:
        return status
    result = job(inputs[0])
    return {**result, "pasos": {**status["pasos"], **result["pasos"]}}


def run_inventory_from_folder(spark: SparkSession, folder: str, out: str, day: str, fmt: str = "parquet", **job) -> dict:
    """`run_inventory_job` over the ledger files of a folder.

    A folder without ledger lines, or a ledger without a column the reports need, ends the run
    before anything is written.
    """

    def read() -> DataFrame:
        raw = landing.ingest_ledger(spark, folder, fmt, needed=schemas.LEDGER_NEEDED)
        if raw.isEmpty():
            raise ValueError(f"no ledger lines in {folder}")
        return raw

    return _after_reading(
        read,
        lambda raw: run_inventory_job(raw, out, day, **job),
        "consolidacion",
    )


def run_consumption_from_files(
    spark: SparkSession, paths: Mapping[str, str], entities: str, out: str, start: str, end: str, fmt: str = "parquet", **job
) -> dict:
    """`run_consumption_job` over the four extract files and the list of external entities."""
    return _after_reading(
        lambda: (landing.ingest_extracts(spark, paths, fmt, needed=schemas.NEEDED_OF_EXTRACTS), landing.read_entities(spark, entities)),
        lambda inputs: run_consumption_job(*inputs, out, start, end, **job),
        "lectura",
    )
