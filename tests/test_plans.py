"""What the plans must and must not contain."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from row_values import rows_of
from stockledger.catalog.queries import all_queries
from stockledger.functions.distributed import Scratch, materialize
from stockledger.functions.exprs import spread_null_key
from stockledger.operators import consumption, finance, ledger, loans, monthly
from stockledger.operators.deviations import quantity_deviations
from stockledger.schemas import DEVIATION_COLUMNS
from stockledger.sources import demo

SMALL = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_pair_joins_and_no_python(spark, name):
    text = plan(all_queries()[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in text


@pytest.mark.parametrize("name", ["movement_by_product", "net_by_voucher_lent", "monthly_qty", "net_purchases"])
def test_ledger_reports_scan_the_lines_once_with_few_columns(spark, name):
    text = plan(all_queries()[name](spark, SMALL))
    assert text.count("lineitem.parquet") == 1
    assert "l_tax" not in text


def test_confirmed_filter_and_columns_reach_the_files(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    demo.ledger_lines(spark, SMALL).write.parquet(path)
    lines = ledger.classified_ledger(spark.read.parquet(path))
    text = plan(ledger.net_by_voucher(lines, "lent"))
    assert "EqualTo(Estado,CONFIRMADO)" in text
    for report in (text, plan(loans.borrowed_balance(lines)), plan(monthly.monthly_qty(monthly.monthly_lines(lines), [1, 2]))):
        assert "In(Comprobante, [" in report
    assert "BroadcastHashJoin" in text


def test_sides_meet_in_one_aggregation(spark):
    for name in ("stock_efficiency_detail", "billing_gap_detail", "class_totals"):
        assert "FullOuter" not in plan(all_queries()[name](spark, SMALL))


def test_sums_run_in_generated_code(spark):
    text = plan(all_queries()["movement_by_product"](spark, SMALL))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}


@pytest.fixture
def eager_to_split(spark):
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield spark
    for key in SKEW:
        spark.conf.unset(key)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_product_is_split_in_the_deviation_join(eager_to_split):
    spark = eager_to_split
    names = [c for c in DEVIATION_COLUMNS if "_" not in c]
    text = [F.lit("x").alias(c) for c in names if c not in ("CodigoGenerico", "Cantidad", "ValorTotal", "NoDocumento")]
    code = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    lines = spark.range(0, 40000, 1, 8).select(
        code.alias("CodigoGenerico"), (F.col("id") % 10).alias("Cantidad"), F.col("id").alias("ValorTotal"),
        F.col("id").cast("string").alias("NoDocumento"), *text,
    )
    assert "skew=true" in executed(quantity_deviations(lines))


def test_a_hot_admission_is_split_when_billing_is_joined(eager_to_split):
    spark = eager_to_split
    lines = spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "0-7").otherwise(F.concat(F.col("id").cast("string"), F.lit("-1"))).alias("ADM-CodGen"),
        F.col("id").cast("string").alias("NoDocumento"), F.lit("n").alias("Nombre"), F.lit("c").alias("CentroCosto"),
    )
    billing = spark.range(0, 9000).select(
        F.concat(F.col("id").cast("string"), F.lit("-1")).alias("ADM-CodGen"), F.lit("d").alias("MedicoRealiza")
    )
    assert "skew=true" in executed(consumption.consumption_with_billing(lines, billing))


def test_missing_keys_do_not_share_a_partition(eager_to_split):
    spark = eager_to_split
    df = spark.range(0, 40000, 1, 8).select(F.lit(None).cast("string").alias("k"), F.col("id"))
    spread = df.select(spread_null_key("k", "lines", ["id"]).alias("j")).repartition(8, "j")
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_shared_facts_are_read_once_and_give_the_same_datasets(spark):
    extract = demo.movement_extract(spark, SMALL)
    inputs = [extract, extract, demo.billing_lines(spark, SMALL), demo.listing(spark, SMALL), demo.entities(spark, SMALL)]
    kept = []

    def keep(df):
        kept.append(plan(df).count("lineitem.parquet"))
        return materialize(df)

    with Scratch(spark):
        shared = consumption.prepare_consumption(*inputs, demo.FINE_MONEY, keep)
        plain = consumption.prepare_consumption(*inputs, demo.FINE_MONEY)
        # the two extracts, then the billing; the grains and the joined rows come from what was written
        assert kept == [2, 0, 1, 0]
        for name, df in shared.items():
            assert df.columns == plain[name].columns and "lineitem.parquet" not in plan(df)
        totals = [rows_of(consumption.control_totals(x)) for x in (shared, plain)]
        assert totals[0] == totals[1]


def test_lines_without_a_doctor_do_not_share_a_partition(eager_to_split):
    spark = eager_to_split
    lines = spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") % 5 > 1, F.concat(F.lit("d"), F.col("id").cast("string"))).alias("MedicoRealiza"),
        F.col("id").cast("string").alias("NoDocumento"),
    )
    entities = spark.createDataFrame([("d3",), ("d7",)], "entidad string")
    flagged = consumption.flag_entities(lines, entities)
    assert flagged.columns == [*lines.columns, consumption.ENTITY]
    assert rows_of(flagged.groupBy(consumption.ENTITY).count()) == [(None, 16000), (False, 23998), (True, 2)]
    spread = lines.select(spread_null_key("MedicoRealiza", "doctor", ["NoDocumento"]).alias("k")).repartition(8, "k")
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1.5 * min(sizes)


def test_lines_are_shuffled_once_for_their_sum_and_their_billing(eager_to_split):
    spark = eager_to_split
    extract = demo.movement_extract(spark, SMALL)
    inputs = [extract, extract, demo.billing_lines(spark, SMALL), demo.listing(spark, SMALL), demo.entities(spark, SMALL)]
    joined = consumption.prepare_consumption(*inputs, demo.FINE_MONEY)["profitability_input"]
    roles = consumption.split_by_voucher(*[consumption.movement_fields(extract)] * 2)
    grain = consumption.enrich_and_grain(roles["dispensed"], inputs[3])
    billing = consumption.billing_by_admission(inputs[2], demo.FINE_MONEY)
    plain = consumption.consumption_with_billing(grain, billing)
    assert joined.columns == plain.columns and rows_of(joined) == rows_of(plain)
    text = {df: plan(df).count("hashpartitioning") for df in (joined, plain)}
    assert text[joined] == text[plain] - 2


def test_profitability_sums_and_joins_where_lines_met_their_billing(eager_to_split):
    spark = eager_to_split
    text = plan(all_queries()["profitability"](spark, SMALL))
    assert "hashpartitioning(Clasificacion_consumo" not in text and "hashpartitioning(_key" not in text


@pytest.mark.parametrize("name", ["profitability", "financial_report_stock_summary"])
def test_what_the_grain_decides_is_added_behind_the_shuffles(eager_to_split, name):
    text = plan(all_queries()[name](eager_to_split, SMALL))
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: ([^\n]*)\nArguments: (.*?)\n\n", text, re.DOTALL)
    of_lines = [read for read, how in moved if "CentroCosto#" in read and "Nombre_right" not in read and "Nombre#" not in how]
    dealt = [read for read, how in moved if "REPARTITION_BY_COL" in how]
    assert len(of_lines) >= 3 and len(dealt) >= 2
    for read in of_lines + dealt:
        columns = {c.split("#")[0] for c in read.strip("[]").split(", ")}
        assert not columns & {*consumption.TOLD_BY_GRAIN, consumption.MEET}
    # the billing that tells an admission's people is not dealt by product
    assert len(dealt) == 3


def test_fields_added_behind_the_shuffles_are_those_added_before(spark):
    rows = [
        ("01/01/2024", "DOC ADM: 7", "P", "005General-AMB", "1001", 2), ("01/01/2024", "DOC ADM: 7", "P", "005General-AMB", "1001", 3),
        ("01/01/2024", None, None, None, "2001", 1), ("02/01/2024", "none", "P", "x", None, 4), ("02/01/2024", "ADM: 8 ADM: 9", "Q", "006Otro", "3001", None),
    ]
    texts = ["Dependencia", "Bodega", "Unidad", "User", "FechaDigitacion", "CodGrupo", "Grupo"]
    money = ["ValorUnitario", "TotalBruto", "ValorIVA", "ValorDescuento", "ValorTotal"]
    lines = spark.createDataFrame(rows, "Fecha string, NoDocumento string, Proveedor string, CentroCosto string, CodArticulo string, Cantidad bigint").select(
        F.lit("v").alias("Comprobante"), "*", *[F.lit("t").alias(c) for c in texts], *[F.col("Cantidad").cast("decimal(18,2)").alias(c) for c in money]
    )
    listing = spark.createDataFrame(
        [("1001", "a", "5", "ACTIVO"), ("1001", "b", "5", "ACTIVO"), ("2001", None, None, None)], "Codigo string, Nombre string, CodigoGenerico string, EstadoArticulo string"
    )
    for meet in (False, True):
        before = consumption.enrich_and_grain(consumption.movement_fields(lines), listing, meet)
        behind = consumption.enrich_and_grain(lines, listing, meet, bare=True)
        assert before.schema == behind.schema
        assert sorted(before.collect(), key=str) == sorted(behind.collect(), key=str) and before.count() == 5


def test_billed_rows_of_the_report_are_prepared_once(spark):
    text = plan(all_queries()["financial_report_gap"](spark, SMALL))
    # the internal lines alone are not read from what was written
    assert text.count("lineitem.parquet") == 1


PRODUCT_AT = "CodigoGenerico bigint, Nombre string, Municipio string, Servicio string"


def test_only_what_was_purchased_is_summed_on_the_other_sides(spark):
    bought = spark.createDataFrame(
        [(1, "n", "m", "s", "P", 5, 2, 10), (2, None, "m", "s", "P", 3, 1, 3)],
        f"{PRODUCT_AT}, Proveedor string, ValorUnitario bigint, Cantidad bigint, ValorTotal bigint",
    )
    sold = spark.createDataFrame(
        [(1, "n", "m", "s", 8, 8, 1), (1, "n", "m", "s", 10, 10, 1), (1, "n", "m", "t", 9, 9, 1), (2, None, "m", "s", 7, 7, 1)],
        f"{PRODUCT_AT}, billed_unit_price bigint, billed_value bigint, billed_qty bigint",
    )
    used = spark.createDataFrame(
        [(1, "n", "m", "s", 4, 3, 12), (3, "o", "m", "s", 4, 3, 12)],
        f"{PRODUCT_AT}, ValorUnitario bigint, Cantidad bigint, ValorTotal bigint",
    )
    detail = finance.purchase_sale_detail(bought, sold, used)
    assert str(detail._jdf.queryExecution().optimizedPlan()).count("Join LeftSemi") >= 2
    assert rows_of(detail, "CodigoGenerico", "Facturacion_Valor", "Precio_Venta_Mediana", "Consumo_Valor") == [(1, 18, 9.0, 12), (2, 0, 0.0, 0)]


def test_predominant_state_is_counted_in_generated_code(spark):
    text = plan(all_queries()["financial_report_stock_summary"](spark, SMALL))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_predominant_state_is_the_first_by_name_among_equals(spark):
    states = [("a", s) for s in ("SOBRE_STOCK", "OPTIMO", "SOBRE_STOCK", "OPTIMO", "SIN_COMPRAS")] + [("b", None)]
    numbers = ["Consumo_Neto_Valor", "Compras_Totales_Valor", "Consumo_Neto_Cantidad", "Compras_Totales_Cantidad",
               "Valor_Stock_Muerto", "Diferencia_Valor", "Diferencia_Cantidad"]
    detail = spark.createDataFrame(states, "Municipio string, Estado_Inventario string").select(
        "*", *[F.lit(1).alias(c) for c in (*numbers, "CodigoGenerico")], F.lit("s").alias("Servicio"),
        F.lit("c").alias("Clasificacion_consumo"), F.lit("NORMAL").alias("Alerta_Costo_Unitario"),
    )
    assert rows_of(finance.stock_efficiency_summary(detail), "Municipio", "Estado_Predominante") == [("a", "OPTIMO"), ("b", None)]


def test_distinct_values_of_the_gap_are_counted_apart_from_its_sums(spark):
    rows = [("m", 1, "F1"), ("m", 1, "F2"), ("m", None, "F2"), (None, None, None), (None, 2, None)]
    numbers = ["Facturado_Valor", "Consumido_Valor", "Margen_Bruto", "Ratio_Fact_Consumo", "Margen_Porcentual"]
    detail = spark.createDataFrame(rows, "Municipio string, idadmision bigint, No_Factura string").select(
        "*", *[F.lit(1).alias(c) for c in numbers], *[F.lit("x").alias(c) for c in ("Servicio_Corregido", "Especialidad")],
        *[F.lit("SIN_FACTURAR").alias(c) for c in ("Estado_Facturacion", "Alerta_Spread")],
    )
    summary = finance.billing_gap_summary(detail)
    assert "Expand" not in plan(summary)
    columns = ("Municipio", "Pacientes_Atendidos", "Facturas_Unicas", "Total_Facturado", "Productos_Sin_Facturar")
    assert sorted(summary.select(*columns).collect(), key=str) == [("m", 2, 2, 3, 3), (None, 2, 1, 2, 2)]
