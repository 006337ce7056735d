"""Known results of the deviation alerts and the financial tables on small frames."""

import pytest

from row_values import rows_of
from stockledger.operators import finance
from stockledger.operators.deviations import dropped_null_keys, quantity_deviations
from stockledger.sources.landing import rename_billing

DEVIATION_DDL = (
    "CodigoGenerico bigint, Nombre string, Cantidad bigint, ValorTotal bigint, CentroCosto string, Comprobante string, "
    "Fecha string, NoDocumento string, Dependencia string, Bodega string, CodGrupo string, Grupo string"
)


def dispensed(spark, quantities):
    """One line per (product, quantity), the third of its product on the third day."""
    lines = []
    for code, quantity in quantities:
        nth = sum(line[0] == code for line in lines) + 1
        lines.append((code, f"Producto {code}", quantity, 25 * (quantity or 0), "N1URG-HOS", "dispensado", f"{nth:02}/03/2025", f"D{nth}", "Urgencias", "Central", "G7", "Sueros"))
    return spark.createDataFrame(lines, DEVIATION_DDL)


def test_lines_off_the_usual_quantity(spark):
    # product 71: mode 6, mean 36 / 6 = 6, deviation sqrt((2 * 16 + 64) / 5) = 4.381780, from 2 to 14
    serum = [(71, q) for q in (6, 2, 6, 14, 2, 6)]
    bandage = [(72, 9)] * 4
    found = quantity_deviations(dispensed(spark, serum + bandage))
    measured = [f"{prefix}_{n}" for prefix in ("Cantidad", "Desviacion") for n in ("moda", "media", "std", "maximo", "minimo")]
    usual = (6, 6.0, 4.38178, 14, 2)
    assert rows_of(found, "NoDocumento", "Cantidad", "ValorTotal", *measured) == [
        ("D2", 2, 50, *usual, 4, 4.0, 2.38178, 12, 0),
        ("D4", 14, 350, *usual, 8, 8.0, 9.61822, 0, 12),
        ("D5", 2, 50, *usual, 4, 4.0, 2.38178, 12, 0),
    ]
    flags = {tuple(r) for r in found.select("Alerta_desviacion_moda", "Alerta_desviacion_media", "Alerta_desviacion_std").collect()}
    assert flags == {("ALERTA", "ALERTA", "ALERTA")}


def test_a_flag_of_its_own_for_each_statistic(spark):
    found = quantity_deviations(dispensed(spark, [(5, q) for q in (1, 1, 1, 3, 4, 8)]), threshold=1.5)
    # mean 18 / 6 = 3, deviation sqrt(38 / 5) = 2.756810
    flags = ["Alerta_desviacion_moda", "Alerta_desviacion_media", "Alerta_desviacion_std"]
    assert rows_of(found, "Cantidad", *flags) == [(3, "ALERTA", "OK", "OK"), (4, "ALERTA", "OK", "OK"), (8, "ALERTA", "ALERTA", "ALERTA")]


def test_nothing_to_alert(spark):
    steady, single, nameless = [(8, 4)] * 3 + [(9, 11)], [(31, 2), (32, 7)], [(None, 1), (None, 90), (None, 1)]
    for quantities in (steady, single, nameless, steady + nameless, []):
        found = quantity_deviations(dispensed(spark, quantities))
        assert len(found.columns) == 25 and found.isEmpty()


def test_tied_mode_takes_the_smaller_value(spark):
    found = quantity_deviations(dispensed(spark, [(44, 15), (44, 3)] * 2 + [(44, 1)]))
    assert rows_of(found, "Cantidad", "Cantidad_moda") == [(1, 3), (15, 3), (15, 3)]


def test_missing_quantity_counts_as_a_value(spark):
    assert quantity_deviations(dispensed(spark, [(1, None)] * 3 + [(1, 4), (1, 9)])).count() == 0
    assert quantity_deviations(dispensed(spark, [(1, None), (1, 4), (1, 4), (1, 9)])).count() == 1


def test_lines_without_code_are_counted(spark):
    assert dropped_null_keys(dispensed(spark, [(None, 1), (1, 1)])).first()[0] == 1


def test_threshold_and_column_parameters(spark):
    lines = dispensed(spark, [(1, 10), (1, 10), (1, 12)])
    assert quantity_deviations(lines, threshold=2).count() == 0
    assert quantity_deviations(lines, threshold=1).count() == 1


# --- financial tables ------------------------------------------------------------------------

LINE_DDL = (
    "Municipio string, Servicio string, Clasificacion_consumo string, CodigoGenerico bigint, Nombre string, "
    "Proveedor string, ValorUnitario bigint, Cantidad bigint, ValorTotal bigint, Comprobante string"
)
BILLING_DDL = (
    "idadmision bigint, CodigoGenerico bigint, Nombre string, vrtotal bigint, cantidad bigint, vrunitario bigint, "
    "Especialidad string, Servicio_Corregido string, Municipio string, Servicio string, MedicoRealiza string, "
    "nofactura string"
)
SERUM = ("N1", "URG", "Medicamentos", 71, "Suero oral")
BANDAGE = ("N2", "HOS", "Dispositivos Medicos", 72, "Venda elastica")
GAUZE = ("N2", "HOS", "Suministros", 73, "Gasa esteril")
NEEDLE = ("N2", "HOS", "Suministros", 74, "Aguja")
USED = [
    (*SERUM, "Andina", 40, 6, 240, "dispensado", 501),
    (*SERUM, "Andina", 60, 4, 240, "interno", 502),
    (*SERUM, "Boreal", 100, 150, 15000, "dispensado", 501),
    (*BANDAGE, "Boreal", 90, 10, 900, "interno", 503),
    (*GAUZE, "Cima", 5, 20, 100, "dispensado", 504),
]
BOUGHT = [
    (*SERUM, "Andina", 50, 8, 400, "Entrada de almacen"),
    (*SERUM, "Cima", 70, 12, 840, "Entrada de almacen"),
    (*BANDAGE, "Boreal", 80, 40, 3200, "COMPRA directa"),
    (*NEEDLE, "Cima", 3, 100, 300, "COMPRA directa"),
]
GIVEN_BACK = [(*GAUZE, "Cima", 4, 25, 100, "Devuelto")]
BILLED = [
    (501, 71, "Suero oral", 12000, 150, 80, "URGENCIAS", "farmacia", "N1", "URG", "Ada", "F-20"),
    (501, 71, "Suero oral", 2000, 10, 200, "URGENCIAS", "farmacia", "N1", "URG", "Bea", "F-10"),
    (502, 71, "Suero oral", 130, 2, 65, "URGENCIAS", "farmacia", "N1", "URG", "Ada", "F-30"),
    (505, 72, "Venda elastica", 600, 6, 100, "CIRUGIA", "farmacia", "N2", "HOS", "Cleo", "F-40"),
    (504, 73, "Gasa esteril", 160, 20, 8, "CIRUGIA", "farmacia", "N2", "HOS", "Cleo", "F-50"),
]


def financial_tables(spark, receipts):
    return finance.financial_report(
        spark.createDataFrame(USED, LINE_DDL + ", field_1 bigint"),
        spark.createDataFrame(receipts, LINE_DDL),
        rename_billing(spark.createDataFrame(BILLED, BILLING_DDL)),
    )


@pytest.fixture(scope="module")
def tables(spark):
    return financial_tables(spark, BOUGHT + GIVEN_BACK)


def test_report_has_nine_tables(tables):
    assert len(tables) == 9


def test_supplier_prices(tables):
    columns = ["CodigoGenerico", "Proveedor", "Costo_Mediano", "Mediana_Mercado", "CV_Costo", "Nivel_Riesgo_Variabilidad",
               "Desviacion_Vs_Mercado_Pct", "Alerta_Precio_Mercado", "Volumen_Total", "Clasificacion_Volumen",
               "Num_Transacciones"]
    assert rows_of(tables["varianza_proveedor"], *columns) == [
        (71, "Andina", 50.0, 75.0, 0.282843, "MEDIO_RIESGO", -0.333333, "PRECIO_ANOMALO", 10, "VOLUMEN_MEDIO", 2),
        (71, "Boreal", 100.0, 75.0, None, "NORMAL", 0.333333, "PRECIO_ANOMALO", 150, "ALTO_VOLUMEN", 1),
        (72, "Boreal", 90.0, 90.0, None, "NORMAL", 0.0, "PRECIO_NORMAL", 10, "VOLUMEN_MEDIO", 1),
        (73, "Cima", 5.0, 5.0, None, "NORMAL", 0.0, "PRECIO_NORMAL", 20, "VOLUMEN_MEDIO", 1),
    ]


def test_a_product_without_code_has_no_market(spark):
    rows = [(None, "x", "P", "m", "s", 5.0, 1, 5.0, "v"), (1, "x", "P", "m", "s", 5.0, 1, 5.0, "v"), (1, "x", "Q", "m", "s", 8.0, 200, 5.0, None),
            (1, "x", "Q", "m", "s", 2.0, 0, 5.0, "v"), (1, "x", "", "m", "s", 9.0, 1, 5.0, "v"), (1, "x", "R", "m", "s", 0.0, 1, 5.0, "v")]
    found = finance.supplier_price_variance(
        spark.createDataFrame(
            rows,
            "CodigoGenerico bigint, Nombre string, Proveedor string, Municipio string, Servicio string, "
            "ValorUnitario double, Cantidad bigint, ValorTotal double, Comprobante string",
        )
    )
    columns = ["CodigoGenerico", "Proveedor", "Mediana_Mercado", "CV_Costo", "Nivel_Riesgo_Variabilidad",
               "Alerta_Precio_Mercado", "Clasificacion_Volumen", "Num_Transacciones"]
    assert rows_of(found, *columns) == [
        (None, "P", None, None, "NORMAL", "PRECIO_NORMAL", "BAJO_VOLUMEN", 1),
        (1, "P", 5.0, None, "NORMAL", "PRECIO_NORMAL", "BAJO_VOLUMEN", 1),
        (1, "Q", 5.0, 0.848528, "ALTO_RIESGO", "PRECIO_NORMAL", "ALTO_VOLUMEN", 2),
    ]


def test_stock_efficiency(tables):
    columns = ["CodigoGenerico", "Municipio", "Consumo_Valor", "Entradas_Valor", "Consumo_Cantidad", "Entradas_Cantidad",
               "Ratio_Eficiencia_Valor", "Estado_Inventario", "Diff_Costo_Unitario", "Alerta_Costo_Unitario",
               "Valor_Stock_Muerto"]
    assert rows_of(tables["eficiencia_stock_detalle"], *columns) == [
        (0, None, 0, 300, 0, 100, 0.0, "SOBRE_STOCK_CRITICO", -3.0, "COMPRA_CARA", 300),
        (71, "N1", 15480, 1240, 160, 20, 12.483871, "DESABASTECIMIENTO", 6.666667, "CONSUMO_CARO", 0),
        (72, "N2", 900, 3200, 10, 40, 0.28125, "SOBRE_STOCK_CRITICO", 10.0, "CONSUMO_CARO", 2300),
        (73, "N2", 100, 100, 20, 25, 1.0, "OPTIMO", 1.0, "CONSUMO_CARO", 0),
    ]


def test_billing_gap(tables):
    columns = ["idadmision", "CodigoGenerico", "Facturado_Valor", "Consumido_Valor", "Ratio_Fact_Consumo",
               "Estado_Facturacion", "Alerta_Spread"]
    assert rows_of(tables["gap_fact_consumo_detalle"], *columns) == [
        (0, 0, 0, 900, 0.0, "SIN_FACTURAR", "SPREAD_ANOMALO"),
        (501, 71, 14000, 15240, 0.918635, "EQUILIBRADO", "SPREAD_ANOMALO"),
        (502, 71, 130, 240, 0.541667, "SUB_FACTURACION_CRITICA", "NORMAL"),
        (504, 73, 160, 100, 1.6, "SOBRE_FACTURACION_CRITICA", "SPREAD_ANOMALO"),
        (505, 72, 600, 0, None, "FACTURADO_SIN_CONSUMO", "SPREAD_ANOMALO"),
    ]
    first = tables["gap_fact_consumo_detalle"].where("idadmision = 501")
    assert rows_of(first, "No_Factura", "MedicoRealiza") == [("F-10", "Bea")]


def test_critical_alerts_in_both_key_modes(spark, tables):
    alerts = tables["alertas_pacientes_criticos"]
    assert rows_of(alerts, "idadmision", "Margen_Perdido_Total") == [(0, -900), (502, -110)]
    billing = rename_billing(spark.createDataFrame(BILLED, BILLING_DDL))
    whole = finance.billing_gap_detail(billing, spark.createDataFrame(USED, LINE_DDL + ", field_1 bigint"), finance.COALESCED)
    found = finance.critical_patient_alerts(whole)
    assert rows_of(found, "idadmision", "Margen_Perdido_Total") == [(502, -110), (503, -900)]


def test_gap_keys_can_be_coalesced(spark):
    billing = spark.createDataFrame(
        [(1, 10, "a", 5, 1, 5, "E", "S", "M", "D", "F1")],
        "idadmision bigint, CodigoGenerico bigint, Nombre string, billed_value bigint, billed_qty bigint, "
        "billed_unit_price bigint, Especialidad string, Servicio_Corregido string, Municipio string, "
        "MedicoRealiza string, nofactura string",
    )
    used = spark.createDataFrame(
        [(2, 20, "b", 7, 1, 7), (None, 20, "b", 9, 1, 9), (3, None, None, 4, 1, 4)],
        "field_1 bigint, CodigoGenerico bigint, Nombre string, ValorTotal bigint, Cantidad bigint, ValorUnitario bigint",
    )
    whole = finance.billing_gap_detail(billing, used, finance.COALESCED)
    assert rows_of(whole, "idadmision", "CodigoGenerico", "Nombre", "Consumido_Valor") == [
        (1, 10, "a", 0), (2, 20, "b", 7), (3, 0, None, 4)
    ]
    left = finance.billing_gap_detail(billing, used)
    assert rows_of(left, "idadmision", "idadmision_right", "Nombre_right") == [(0, 2, "b"), (0, 3, None), (1, 0, None)]
    with pytest.raises(ValueError):
        finance.billing_gap_detail(billing, used, "other")


def test_null_keys_of_both_sides_do_not_meet(spark):
    ddl = (
        "Municipio string, Servicio string, Clasificacion_consumo string, CodigoGenerico bigint, Nombre string, "
        "ValorTotal bigint, Cantidad bigint, ValorUnitario bigint"
    )
    used = spark.createDataFrame([("m", "s", "c", None, "x", 5, 1, 5), ("m", "s", "c", 1, "x", 5, 1, 5)], ddl)
    got = spark.createDataFrame([("m", "s", "c", None, "x", 9, 1, 9), ("m", "s", "c", 1, "x", 9, 1, 9)], ddl)
    found = finance.stock_efficiency_detail(used, got)
    assert rows_of(found, "CodigoGenerico", "Consumo_Valor", "Entradas_Valor") == [(0, 0, 9), (0, 5, 0), (1, 5, 9)]


def test_admission_column_fallbacks(spark):
    ddl = "CodigoGenerico bigint, {} string"
    for name, text in (("field_1", "7"), ("ADM-CodGen", "7-12")):
        df = spark.createDataFrame([(1, text)], f"CodigoGenerico bigint, `{name}` string")
        assert df.select(finance.consumption_admission(df)).first()[0] == 7
    df = spark.createDataFrame([(1, 7)], "CodigoGenerico bigint, idadmision bigint")
    assert df.select(finance.consumption_admission(df)).first()[0] == 7
    with pytest.raises(KeyError):
        finance.consumption_admission(spark.createDataFrame([(1, "x")], ddl.format("other")))


def test_purchase_margins(tables):
    columns = ["CodigoGenerico", "Municipio", "Precio_Compra_Prom", "Compras_Cantidad", "Facturacion_Cantidad",
               "Consumo_Cantidad", "Margen_Porcentual_Prom", "Alerta_Margen", "Alerta_Eficiencia_Compra",
               "Alerta_Rotacion_Venta", "Valor_Stock_Muerto_Estimado"]
    assert rows_of(tables["compras_ventas_consumo_detalle"], *columns) == [
        (71, "N1", 60.0, 20, 162, 160, 91.666667, "MARGEN_ALTO", "DESABASTECIMIENTO", "VENTA_SUPERIOR_COMPRA", 0.0),
        (72, "N2", 80.0, 40, 6, 10, 25.0, "MARGEN_NORMAL", "SOBRE_COMPRA_CRITICA", "BAJA_ROTACION_VENTA", 2400.0),
        (74, "N2", 3.0, 100, 0, 0, -100.0, "PERDIDA", "SOBRE_COMPRA_CRITICA", "BAJA_ROTACION_VENTA", 300.0),
    ]


def test_top_dead_stock_order(tables):
    top = [r.Valor_Stock_Muerto_Estimado for r in tables["top_stock_muerto_estimado"].collect()]
    assert top == [2400, 300]


def test_modal_supplier_and_supplier_count(spark):
    rows = [("B", 5), ("B", 6), ("A", 5), ("A", 9), (None, 5), ("C", 1)]
    bought = spark.createDataFrame(
        [(1, "n", "m", "s", p, u, 1, u) for p, u in rows],
        "CodigoGenerico bigint, Nombre string, Municipio string, Servicio string, Proveedor string, "
        "ValorUnitario bigint, Cantidad bigint, ValorTotal bigint",
    )
    figures = finance._purchase_figures(bought).first()
    assert (figures.Proveedor_Principal, figures.Num_Proveedores) == ("A", 4)
    assert (figures.Precio_Compra_Mediana, figures.Precio_Compra_Min, figures.Precio_Compra_Max) == (5.0, 1.0, 9.0)


def test_purchase_price_may_have_its_own_name(spark):
    ddl = "CodigoGenerico bigint, Nombre string, Municipio string, Servicio string, Cantidad bigint, ValorTotal bigint"
    bought = spark.createDataFrame([(1, "n", "m", "s", 2, 10, "P", 5)], f"{ddl}, Proveedor string, PrecioCompra bigint")
    used = spark.createDataFrame([(1, "n", "m", "s", 3, 12, 4)], f"{ddl}, ValorUnitario bigint")
    sold = spark.createDataFrame(
        [(1, "n", "m", "s", 1, 8, 8)],
        "CodigoGenerico bigint, Nombre string, Municipio string, Servicio string, billed_qty bigint, "
        "billed_unit_price bigint, billed_value bigint",
    )
    row = finance.purchase_sale_detail(bought, sold, used).first()
    assert (row.Precio_Compra_Prom, row.Margen_Porcentual_Prom, row.Alerta_Margen) == (5.0, 60.0, "MARGEN_ALTO")
    assert (row.Alerta_Eficiencia_Compra, row.Valor_Stock_Muerto_Estimado) == ("DESABASTECIMIENTO", 0.0)


def test_no_purchases_gives_empty_tables(spark):
    receipts = spark.createDataFrame([("DEVOLUCION",), ("Registro de COMPRA",), (None,)], "Comprobante string")
    assert finance.detect_purchases(receipts).count() == 1
    found = financial_tables(spark, GIVEN_BACK)
    for name in ("compras_ventas_consumo_detalle", "compras_ventas_resumen_servicio", "top_stock_muerto_estimado"):
        assert found[name].columns and found[name].count() == 0
    assert found["eficiencia_stock_detalle"].count() == 3


def test_share_of_purchases_of_zero_is_null(spark):
    ddl = (
        "Municipio string, Servicio string, Clasificacion_consumo string, CodigoGenerico bigint, Nombre string, "
        "ValorTotal double, Cantidad bigint, ValorUnitario double"
    )
    used = spark.createDataFrame([("m", "s", "c", 1, "x", 5.0, 1, 5.0)], ddl)
    summary = finance.stock_efficiency_summary(finance.stock_efficiency_detail(used, used.limit(0)))
    row = summary.first()
    assert (row.Ratio_Eficiencia_Global, row.Pct_Stock_Muerto_Sobre_Compras) == (None, None)
    assert row.Estado_Predominante == "DESABASTECIMIENTO"
