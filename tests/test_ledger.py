"""Ledger preparation, netting, purchases, loans, movements and monthly consumption."""

import datetime

import pytest
from pyspark.sql import functions as F

from row_values import rows_of
from stockledger import vocab
from stockledger.operators import ledger, loans, monthly, movements, purchases

DDL = (
    "Fecha string, TipoMovimiento string, Comprobante string, Estado string, Bodega string, CodigoGenerico bigint, "
    "GrupoInventario string, Generico string, Tercero string, Cantidad string, ValorTotal string"
)
RMC, DC = vocab.PURCHASE_VOUCHER, vocab.PURCHASE_RETURN_VOUCHER
TEXT = {text.split(" - ")[0]: text for text, *_ in vocab.VOUCHERS}


def entry(voucher, qty, value, day="05/03/2024", code=1, name="A", warehouse="W1", third="T", kind="ENTRADA", state="CONFIRMADO"):
    return (day, kind, voucher, state, warehouse, code, "G", name, third, str(qty), str(value))


@pytest.fixture
def lines(spark):
    return lambda *rows, money="double": ledger.classified_ledger(spark.createDataFrame(list(rows), DDL), money)


def test_relabel_confirm_and_dates(spark):
    raw = spark.createDataFrame(
        [
            entry(vocab.TRANSFER_VOUCHER, 1, 1, kind="SALIDA"),
            entry(vocab.TRANSFER_VOUCHER, 1, 1, kind="ENTRADA", day="31/12/2023 10:20"),
            entry(vocab.TRANSFER_VOUCHER, 1, 1, kind="OTRO"),
            entry(RMC, "x", "y"),
            entry(RMC, 1, 1, state="ANULADO"),
        ],
        DDL,
    )
    found = ledger.prepare_ledger(raw)
    assert rows_of(found, "Comprobante_corregido", "Fecha", "Año", "Mes", "Dia") == [
        (vocab.TRANSFER_IN, datetime.date(2023, 12, 31), 2023, 12, 31),
        (RMC, datetime.date(2024, 3, 5), 2024, 3, 5),
        (vocab.TRANSFER_OUT, datetime.date(2024, 3, 5), 2024, 3, 5),
        (vocab.TRANSFER_VOUCHER, datetime.date(2024, 3, 5), 2024, 3, 5),
    ]
    assert rows_of(found.where(F.col("Comprobante") == RMC), "Cantidad", "ValorTotal") == [(None, None)]


def test_unreadable_date_fails(spark):
    with pytest.raises(Exception):
        ledger.prepare_ledger(spark.createDataFrame([entry(RMC, 1, 1, day="2024-03-05")], DDL)).collect()


def test_family_counts_add_up(lines):
    every = [entry(v, 1, 1) for v in TEXT.values() if "TRASLADO" not in v]
    moved = [entry(vocab.TRANSFER_VOUCHER, 1, 1, kind=k) for k in ("ENTRADA", "SALIDA")]
    found = lines(*every, *moved, entry("OTR - OTRO", 1, 1))
    counts = dict(rows_of(ledger.family_counts(found)))
    assert counts == {
        None: 1, "purchases": 4, "initial": 2, "adjustments": 4, "lent": 3, "borrowed": 3, "transfers": 2, "consumption": 5
    }
    assert ledger.unclassified_count(found).first()[0] == 1


def test_net_by_voucher_columns_do_not_depend_on_the_data(lines):
    found = ledger.net_by_voucher(lines(entry(RMC, 3, 30), entry(RMC, 2, 20), entry(DC, 1, 10)), "purchases")
    assert rows_of(found, f"Cantidad_{RMC}", f"Cantidad_{DC}", f"ValorTotal_{RMC}", f"ValorTotal_{DC}") == [
        (0, 1, 0.0, 10.0), (5, 0, 50.0, 0.0)
    ]
    assert len(found.columns) == len(ledger.INDEX) + 8
    assert ledger.net_by_voucher(lines(entry(RMC, 3, 30)), "lent").count() == 0


def test_missing_numeric_code_becomes_zero(lines):
    found = movements.movement_by_product(lines(entry(RMC, 3, 30, code=None), entry(RMC, 4, 40, code=0)))
    assert rows_of(found, "CodigoGenerico", "Cantidad_total_compras") == [(0, 7)]


def test_missing_code_and_code_zero_are_two_netted_rows(lines):
    both = lines(entry(RMC, 3, 30, code=None), entry(RMC, 4, 40, code=0), entry(RMC, 5, 50, code=None))
    found = ledger.net_by_voucher(both, "purchases")
    assert rows_of(found, "CodigoGenerico", f"Cantidad_{RMC}") == [(0, 4), (0, 8)]
    net = purchases.net_purchases(both)
    assert rows_of(net, "CodigoGenerico", "Cantidad_neta") == [(0, 4), (0, 8)]


def test_own_vouchers_are_not_filtered_by_the_built_in_ones(spark):
    dim = spark.createDataFrame([("X - NEW", "lent", 1, None)], "voucher string, family string, sign int, monthly_sign int")
    found = ledger.classified_ledger(spark.createDataFrame([entry("X - NEW", 2, 4)], DDL), vouchers=dim)
    assert ledger.of_family(found, "lent").count() == 1


def test_own_voucher_table(spark):
    dim = spark.createDataFrame([("X - NEW", "purchases", 1, None)], "voucher string, family string, sign int, monthly_sign int")
    found = ledger.classified_ledger(spark.createDataFrame([entry("X - NEW", 2, 4)], DDL), vouchers=dim)
    assert rows_of(found, "family", "sign") == [("purchases", 1)]


def test_purchases(lines):
    net = purchases.net_purchases(
        lines(
            entry(RMC, 10, 100.0), entry(DC, 4, 30.0), entry(RMC, 3, 10.0, third="U"), entry(RMC, 5, 5.0, third="V"),
            entry(DC, 5, 9.0, third="V"), entry("EDO - ENTRADAS DONACIONES", 9, 9.0), entry(RMC, 2, 7.0, day="05/03/2025"),
        )
    )
    columns = ["Tercero", "Mes", "Cantidad_neta", "ValorTotal_neto", "valor_unitario_calculado"]
    assert rows_of(net, *columns) == [
        ("T", 3, 2, 7.0, 3.5), ("T", 3, 6, 70.0, 11.67), ("U", 3, 3, 10.0, 3.33), ("V", 3, 0, -4.0, 0.0)
    ]
    per_supplier = purchases.purchases_by_supplier(net)
    assert rows_of(per_supplier, "Tercero", "cantidad compras", "suma valor unitario")[0] == ("T", 1, 11.67)
    largest = purchases.largest_purchases(net).where("Tercero = 'T'")
    assert rows_of(largest, "cantidad_comprada_neta", "cantidad_registros", "valor_unitario_calculado_promedio") == [(8, 2, 7.585)]
    most = purchases.most_purchased_products(net)
    assert rows_of(most, "cantidad_comprada_neta", "cantidad_proveedores") == [(11, 4)]
    months = purchases.monthly_purchase_behaviour(net)
    # March of both years falls together
    assert months.columns[3:] == ["3", "Cantidad_neta_3", "ValorTotal_neto_3", "3_cant_registros"]
    assert rows_of(months, "3", "Cantidad_neta_3", "3_cant_registros") == [(4.625, 11, 4)]


def test_purchase_months_of_different_years(lines):
    net = purchases.net_purchases(lines(entry(RMC, 1, 1.0), entry(RMC, 1, 1.0, day="05/03/2025")), year_month=True)
    assert monthly.present_months(net) == [202403, 202503]


def test_monthly_purchases_leave_out_missing_text_keys(lines):
    net = purchases.net_purchases(lines(entry(RMC, 1, 1.0, name=None), entry(RMC, 1, 1.0), entry(RMC, 1, 1.0, code=None)))
    assert rows_of(purchases.monthly_purchase_behaviour(net, [3, 4]), "CodigoGenerico", "4") == [(0, 0.0), (1, 0.0)]
    assert purchases.most_purchased_products(net).count() == 3


def test_loans(lines):
    found = lines(
        entry(TEXT["SPOE"], 10, 100), entry(TEXT["EDP"], 3, 30), entry(TEXT["EPS"], 2, 20),
        entry(TEXT["SDP"], 4, 40), entry(TEXT["SPS"], 1, "n/a"),
    )
    assert rows_of(loans.lent_balance(found), "SaldoPrestamos_realizados", "Saldo_Prestamos_Realizados") == [(5, 50.0)]
    assert rows_of(loans.borrowed_balance(found), "SaldoPrestamos_recibidos", "Saldo_Prestamos_Recibidos") == [(-5, -40.0)]


def test_movements_and_the_two_signs_of_internal_warehouse_issues(lines):
    found = lines(
        entry(TEXT["SDF"], 10, 10), entry(TEXT["SIA"], 4, 4), entry(TEXT["SAFC"], 2, 2),
        entry(vocab.TRANSFER_VOUCHER, 5, 5, kind="SALIDA"), entry(vocab.TRANSFER_VOUCHER, 5, 5, warehouse="W2"),
    )
    product = movements.movement_by_product(found)
    assert not [c for c in product.columns if "traslados" in c]
    assert rows_of(product, "Cantidad_total_consumos", "Cantidad_total_ajustes", "ValorTotal_total_compras") == [(6, -2, 0.0)]
    site = movements.movement_by_warehouse_product(found)
    assert rows_of(site, "Bodega", "Cantidad_total_traslados", "Cantidad_total_consumos") == [("W1", -5, 6), ("W2", 5, 0)]
    used = monthly.monthly_lines(found)
    assert rows_of(monthly.monthly_qty(used), "3", "Total_Cantidad") == [(14, 14)]


def test_product_movements_are_the_sum_over_warehouses(lines):
    every = [entry(v, i + 1, i, warehouse=f"W{i % 3}", code=i % 4) for i, v in enumerate(TEXT.values()) if "TRASLADO" not in v]
    found = lines(*every)
    product, site = movements.movement_by_product(found), movements.movement_by_warehouse_product(found)
    measures = [c for c in product.columns if "_total_" in c]
    summed = site.groupBy("CodigoGenerico").agg(*[F.sum(c).alias(c) for c in measures])
    assert rows_of(product, "CodigoGenerico", *measures) == rows_of(summed, "CodigoGenerico", *measures)


def test_monthly_quantities(lines):
    sdf, back = TEXT["SDF"], TEXT["SADF"]
    used = monthly.monthly_lines(
        lines(entry(sdf, 10, 1), entry(back, 4, 1), entry(sdf, 3, 1, day="01/05/2024"), entry(sdf, 1, 1, day="01/05/2023", code=2))
    )
    found = monthly.monthly_qty(used)
    assert rows_of(found, "CodigoGenerico", "3", "5", "Total_Cantidad", "Promedio_Mensual", "Minimo_Mensual", "Maximo_Mensual") == [
        (1, 6, 3, 9, 4.5, 3, 6), (2, 0, 1, 1, 0.5, 0, 1)
    ]
    assert rows_of(monthly.monthly_value(used), "CodigoGenerico", "Total_Valor", "Maximo_Valor") == [(1, 1.0, 1.0), (2, 1.0, 1.0)]
    assert rows_of(monthly.consumption_by_warehouse(used), "Bodega", "CodigoGenerico", "Total_Cantidad") == [("W1", 1, 9), ("W1", 2, 1)]
    dated = monthly.monthly_lines(lines(entry(sdf, 1, 1), entry(sdf, 1, 1, day="05/03/2025")), year_month=True)
    assert monthly.present_months(dated) == [202403, 202503]


def abc(lines, *values, money="decimal(18,2)"):
    rows = [entry(TEXT["SDF"], 1, v, code=i) for i, v in enumerate(values) if v >= 0]
    rows += [entry(TEXT["SADF"], 1, -v, code=i) for i, v in enumerate(values) if v < 0]
    found = monthly.abc_pareto(monthly.monthly_lines(lines(*rows, money=money)), partitions=3)
    return rows_of(found, "CodigoGenerico", "Porcentaje_Acumulado", "Clasificacion_ABC")


def test_abc_limits_belong_to_the_better_class(lines):
    assert abc(lines, 80, 15, 5) == [(0, 0.8, "A"), (1, 0.95, "B"), (2, 1.0, "C")]
    assert abc(lines, 80.01, 14.99, 5) == [(0, 0.8001, "B"), (1, 0.95, "B"), (2, 1.0, "C")]


def test_abc_without_value_is_all_c(lines):
    assert abc(lines, -5, 3) == [(0, 0.0, "C"), (1, 0.0, "C")]


def test_abc_with_a_negative_product(lines):
    assert abc(lines, 100, -20) == [(0, 1.25, "C"), (1, 1.0, "C")]


def test_abc_ties_follow_the_keys(lines):
    assert abc(lines, 25, 25, 25, 25) == [(0, 0.25, "A"), (1, 0.5, "A"), (2, 0.75, "A"), (3, 1.0, "C")]


def test_demand_limits(lines):
    sdf = TEXT["SDF"]

    def rows(code, *quantities):
        return [entry(sdf, q, 1, code=code, day=f"01/{m + 1:02d}/2024") for m, q in enumerate(quantities) if q]

    used = monthly.monthly_lines(
        lines(*rows(1, 3, 5, 4), *rows(2, 2, 6, 4), *rows(3, 1, 1, 10), *rows(4, 7, 0, 0))
    )
    found = monthly.demand_variability(used)
    assert rows_of(found, "CodigoGenerico", "Desviacion_Estandar", "Promedio_Mensual", "Coeficiente_Variacion", "Tipo_Demanda") == [
        (1, 1.0, 4.0, 0.25, "Estable"), (2, 2.0, 4.0, 0.5, "Variable"), (3, 5.196152, 4.0, 1.299038, "Erratica"),
        (4, 0.0, 2.333333, 0.0, "Estable"),
    ]


def test_deviation_of_a_missing_key_is_zero(lines):
    sdf = TEXT["SDF"]
    used = monthly.monthly_lines(lines(entry(sdf, 1, 1, name=None), entry(sdf, 9, 1, name=None, day="01/04/2024")))
    assert rows_of(monthly.demand_variability(used), "Desviacion_Estandar", "Tipo_Demanda") == [(0.0, "Estable")]


def test_results_do_not_depend_on_the_partitioning(spark, lines):
    rows = [entry(v, i % 7, f"{i}.{i % 100:02d}", code=i % 5, day=f"{i % 28 + 1:02d}/{i % 12 + 1:02d}/2024")
            for i in range(500) for v in (TEXT["SDF"], TEXT["SADF"], RMC, DC)]
    raw = spark.createDataFrame(rows, DDL)
    results = []
    for n in (1, 7):
        found = ledger.classified_ledger(raw.repartition(n), "decimal(18,2)")
        results.append(
            (
                rows_of(purchases.largest_purchases(purchases.net_purchases(found))),
                rows_of(monthly.abc_pareto(monthly.monthly_lines(found))),
            )
        )
    assert results[0] == results[1]
