"""Dispensing lines with billing, returns, audit, net report, profitability, reconciliation."""

import random

import pytest
from pyspark.sql import functions as F

from row_values import rows_of
from stockledger import vocab
from stockledger.functions.exprs import joined_key
from stockledger.operators import audit, consumption, profit, reconcile, report
from stockledger.schemas import UNCLOSED_COLUMNS

EXTRACT = (
    "Comprobante string, Fecha string, NoDocumento string, Proveedor string, CentroCosto string, Dependencia string, "
    "Bodega string, CodGrupo string, Grupo string, CodArticulo string, Cantidad bigint, ValorUnitario double, "
    "TotalBruto double, ValorIVA double, ValorDescuento double, ValorTotal double, Unidad string, User string, "
    "FechaDigitacion string"
)
BILLING = (
    "idadmision bigint, nofactura string, idusuario string, nomtiposervicio string, codigo string, billed_name string, "
    "billed_qty string, requested_qty string, billed_unit_price string, billed_value string, Especialidad string, "
    "MedicoRealiza string"
)
ENTITY = "CLINICA  UNO "


def moved(voucher=vocab.DISPENSED, document="DOC ADM: 7", centre="001consultas generales-AMB", article="1001", qty=2, value=20.0):
    return (voucher, "01/01/2024", document, "P", centre, "D", "B", "G", "GR", article, qty, 10.0, value, 1.0, 0.0, value, "U", "US", "x")


def billed(admission=7, code="1", invoice="F1", qty="2", value="30", specialty="MEDICINA GENERAL", doctor="Dr", kind="FARMACIA"):
    return (admission, invoice, "CC123", kind, code, "n", qty, qty, "15", value, specialty, doctor)


@pytest.fixture
def prepare(spark):
    def run(out_lines, in_lines=(), bills=(), listing=(("1001", "Item", "1", "ACTIVO"),)):
        return consumption.prepare_consumption(
            spark.createDataFrame(list(out_lines), EXTRACT),
            spark.createDataFrame(list(in_lines), EXTRACT),
            spark.createDataFrame(list(bills), BILLING),
            spark.createDataFrame(list(listing), "Codigo string, Nombre string, CodigoGenerico string, EstadoArticulo string"),
            spark.createDataFrame([(ENTITY,), (ENTITY,), (None,)], "entidad string"),
        )

    return run


def test_extracted_fields(spark):
    documents = ["DOC ADM: 12", "ADM: 5 ADM: 9", "no admission", "ADM: abc", "ADM: 3000000000", "ADM:  8 \t", None]
    df = spark.createDataFrame([(d,) for d in documents], "NoDocumento string")
    assert [r[0] for r in df.select(consumption.extract_admission()).collect()] == [12, 5, 0, 0, 0, 8, 0]
    codes = spark.createDataFrame([("1a",), ("2",), ("3",), ("41",), (None,)], "CodArticulo string")
    assert [r[0] for r in codes.select(consumption.classify_article()).collect()] == [
        "Medicamentos", "Dispositivos Medicos", "Suministros", "OTRO", "OTRO"
    ]
    centres = spark.createDataFrame([("001 pym - AMB -x",), ("002FAR",), ("1-2",)], "CentroCosto string")
    found = consumption.split_cost_centre(centres)
    assert [tuple(r)[1:] for r in found.collect()] == [("001", "pym", "AMB"), ("002", "FAR", None), ("1-2", "", "2")]


def test_key_needs_both_parts(prepare):
    data = prepare([moved(), moved(article="9999")], bills=[billed()])
    assert rows_of(data["billed"], "ADM-CodGen", "billed_value") == [(None, None), ("7-1", 30.0)]


def test_lines_are_summed_to_the_grain_and_invoices_repeat_them(prepare):
    data = prepare([moved(), moved(qty=3, value=25.0)], bills=[billed(), billed(invoice="F2"), billed(value="5")])
    found = data["billed"]
    assert rows_of(found, "Cantidad", "ValorTotal", "nofactura", "billed_value") == [
        (5, 45.0, "F1", 35.0), (5, 45.0, "F2", 30.0)
    ]
    assert rows_of(found, "# Identificacion") == [("123",), ("123",)]


def test_other_services_are_not_billing_and_bad_numbers_fail(prepare):
    assert rows_of(prepare([moved()], bills=[billed(kind="LABORATORIO")])["billed"], "nofactura") == [(None,)]
    with pytest.raises(Exception):
        prepare([moved()], bills=[billed(qty="two")])["billed"].collect()


def test_a_code_listed_twice_doubles_its_lines(prepare):
    data = prepare([moved()], listing=[("1001", "Item", "1", "A"), ("1001", "Item", "1", "A")])
    assert rows_of(data["billed"], "Cantidad") == [(4,)]


CASES = [
    ("servicio farmaceutico", "X", ENTITY, "servicio farmaceutico"),
    ("consultas generales", "CARDIOLOGIA", "Dr", "consultas especializadas"),
    ("consultas generales", "ENFERMERIA", "Dr", "consultas especializadas"),
    ("consultas generales", "CARDIOLOGIA", ENTITY, "consultas generales"),
    ("consultas generales", "CARDIOLOGIA", ENTITY.strip(), "consultas especializadas"),
    ("consultas generales", "CARDIOLOGIA", None, "consultas generales"),
    ("consultas generales", None, "Dr", "consultas generales"),
    ("consultas especializadas", "ODONTOLOGIA", "Dr", "consultas generales"),
    ("consultas especializadas", "ENFERMERIA", "Dr", "pym"),
    ("cronicos", "ONCOLOGIA", "Dr", "terapias oncologicas"),
    ("cronicos", "ONCOLOGIA", ENTITY, "cronicos"),
    ("pym", "CARDIOLOGIA", "Dr", "pym"),
]


@pytest.mark.parametrize("service,specialty,doctor,expected", CASES)
def test_corrected_service(spark, service, specialty, doctor, expected):
    df = spark.createDataFrame([(service, specialty, doctor)], "Servicio string, Especialidad string, MedicoRealiza string")
    entities = spark.createDataFrame([(ENTITY,)], "entidad string")
    assert consumption.corrected_service(df, entities).first().Servicio_Corregido == expected


def test_specialty_override_and_unclosed_billing(prepare):
    data = prepare(
        [moved(), moved(document="ADM: 8", centre="001pym-AMB"), moved(document="ADM: 9")],
        bills=[billed(), billed(8, specialty="CARDIOLOGIA"), billed(9, doctor=None)],
    )
    assert rows_of(data["billed"], "field_1", "Especialidad") == [
        (7, "MEDICINA GENERAL"), (8, "pym"), (9, "MEDICINA GENERAL")
    ]
    assert data["unclosed"].columns == UNCLOSED_COLUMNS
    assert rows_of(data["unclosed"], "idadmision") == [(9,)]


def test_returns_take_every_doctor_of_their_admission(prepare):
    back = moved(vocab.RETURNED)
    data = prepare([], [back], [billed(), billed(code="2", doctor="Dr2", specialty="CARDIOLOGIA")])
    assert rows_of(data["returns"], "MedicoRealiza", "Servicio_Corregido", "MedicoRealiza_right") == [
        ("Dr", "consultas generales", "Dr"), ("Dr2", "consultas especializadas", "Dr")
    ]


def test_roles_and_control_totals(prepare):
    data = prepare(
        [moved(), moved(vocab.INTERNAL_OUT[0], value=5.0), moved("OTRO")],
        [moved(vocab.RETURNED), moved(vocab.INTERNAL_IN[1], value=3.0), moved(vocab.INTERNAL_IN[2], value=4.0)],
        [billed()],
    )
    totals = {r.conjunto: (r.filas, r.ValorTotal) for r in consumption.control_totals(data).collect()}
    assert totals == {
        "billed": (1, 20.0), "unclosed": (0, 0.0), "billed_clean": (1, 20.0), "internal_out": (1, 5.0),
        "returns": (1, 20.0), "internal_in": (2, 7.0), "profitability_input": (1, 20.0),
    }


def test_quality_counts(spark):
    lines = consumption.movement_fields(spark.createDataFrame([moved(), moved(centre="001FAR", document="x")], EXTRACT))
    assert tuple(consumption.extract_quality(lines).first()) == (1, 1)


# --- audit -----------------------------------------------------------------------------------


def test_audit_rules(spark):
    cases = [
        ("consultas generales", "CARDIOLOGIA", "Dr", 1),
        ("consultas generales", "ODONTOLOGIA", "Dr", None),
        ("consultas generales", None, "Dr", None),
        ("consultas especializadas", "HIGIENE ORAL", "Dr", 2),
        ("pym", "CARDIOLOGIA", None, 3),
        ("pym", "GINECOLOGIA", "Dr", None),
        ("cronicos", "ONCOLOGIA", "Dr", 4),
        ("servicio farmaceutico", "X", "Dr", 5),
        ("servicio farmaceutico", "X", ENTITY, None),
        ("servicio farmaceutico", "X", None, None),
        ("otro", "X", "Dr", None),
    ]
    df = spark.createDataFrame(
        [(f"C{i}", *c[:3]) for i, c in enumerate(cases)] * 2,
        "CentroCosto string, Servicio string, Especialidad string, MedicoRealiza string",
    )
    entities = spark.createDataFrame([(ENTITY,)], "entidad string")
    want = [(f"C{i}", c[3], 2) for i, c in enumerate(cases) if c[3]]
    assert rows_of(audit.audit(df, entities, keep_rule=True), "CentroCosto", audit.RULE, "Cantidad Registros") == want
    single = [audit.audit(df, entities, [rule]) for rule in vocab.AUDIT_RULES]
    assert sum(f.count() for f in single) == audit.audit(df, entities).count()


# --- net report ------------------------------------------------------------------------------


def side(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "Clasificacion_consumo string, Municipio string, Servicio string, Servicio_Corregido string, Especialidad string, "
        "ValorTotal double",
    )


def test_totals_are_cut_before_netting(spark):
    med, dev = vocab.MEDICINES, vocab.DEVICES
    billed_lines = side(
        spark,
        (med, "001", "x", "pym", "CARDIOLOGIA", 10.6),
        (med, "001", "x", "consultas generales", "CARDIOLOGIA", 5.9),
        (med, "001", "x", "consultas generales", "", 1.0),
        (dev, "001", "x", "consultas generales", None, 7.9),
        ("OTRO", "001", "x", "pym", None, 99.0),
    )
    returned = side(spark, (med, "001", "x", "consultas generales", "CARDIOLOGIA", 2.9), (med, "009", "x", "pym", None, 1.5))
    out = side(spark, (med, "001", "pym", None, None, 3.7), (med, "001", "pym", None, None, 0.7), (dev, "001", None, None, None, 4.0))
    back = side(spark, (med, "001", "pym", None, None, 1.9))
    tables = report.consumption_report(billed_lines, returned, out, back)
    assert rows_of(tables["consumos_medicamentos"]) == [
        ("001", "CARDIOLOGIA", 3), ("001", "consultas generales", 1), ("001", "pym", 13), ("009", "pym", -1)
    ]
    assert rows_of(tables["consumos_dispositivos_formulados"]) == [("001", "consultas generales", 7)]
    assert rows_of(tables["consumo_dispositivos"]) == [("001", None, 4)]
    assert rows_of(tables["consumos_suministros"]) == []


def test_returns_can_be_filed_like_what_they_return(spark):
    row = (vocab.MEDICINES, "001", "x", "urgencias")
    billed_lines, returned = side(spark, (*row, "urgencias", 9.0)), side(spark, (*row, "CARDIOLOGIA", 4.0))
    none = side(spark, (*row, None, 0.0)).limit(0)

    def medicines(**options):
        net = report.net_report(report.class_totals(billed_lines, returned, none, none, **options))
        return rows_of(report.report_table(net, "consumos_medicamentos"), "Servicio", "ValorNeto")

    assert medicines() == [("CARDIOLOGIA", -4), ("urgencias", 9)]
    assert medicines(symmetric=True) == [("urgencias", 5)]


# --- profitability and reconciliation --------------------------------------------------------

CONSUMED = (
    "field_1 int, Clasificacion_consumo string, `ADM-CodGen` string, idadmision bigint, nofactura string, "
    "CodigoGenerico bigint, Nombre string, Cantidad bigint, ValorTotal double, billed_qty bigint, billed_value double"
)
RETURNED = "field_1 int, CodigoGenerico bigint, Cantidad bigint, ValorTotal double"


def by_pairs(consumed, returned):
    """The figures by pairing every group with every return line of its key."""
    groups = {}
    for a, cl, key, i, f, c, n, q, v, bq, bv in consumed:
        g = groups.setdefault((a, cl, key, i, f, c, n), [0, 0.0, 0, 0.0])
        for j, x in enumerate((q, v, bq, bv)):
            g[j] += x or 0
    pairs, used = [], set()
    for (a, _, key, i, f, c, n), sums in groups.items():
        mates = [k for k, r in enumerate(returned) if key is not None and r[1] is not None and f"{r[0]}-{r[1]}" == key]
        used.update(mates)
        for k in mates or [None]:
            pairs.append(((a or 0, i or 0, f, c or 0, n), sums, returned[k][2:] if k is not None else (0, 0.0)))
    pairs += [((0, 0, None, 0, None), [0, 0.0, 0, 0.0], r[2:]) for k, r in enumerate(returned) if k not in used]
    out = {}
    for key, (q, v, bq, bv), (rq, rv) in pairs:
        o = out.setdefault(key, [0, 0.0, 0, 0.0, 0, 0.0])
        nq, nv = q - (rq or 0), v - (rv or 0)
        for j, x in enumerate((nq, nv, bq, bv, bq - nq, bv - nv)):
            o[j] += x
    return [(*k, *v) for k, v in out.items()]


def test_profitability_equals_pairing_lines(spark):
    rng = random.Random(4)
    consumed = []
    for _ in range(300):
        adm, code = rng.choice([0, 1, 2, 3]), rng.choice([10, 11, None])
        key = None if code is None else f"{adm}-{code}"
        invoice = rng.choice([None, "F1", "F2"])
        consumed.append(
            (adm, rng.choice("MD"), key, adm if invoice else None, invoice, code, None if code is None else f"n{code}",
             rng.randint(1, 9), float(rng.randint(1, 90)), rng.choice([None, 3]), rng.choice([None, 8.0]))
        )
    returned = [(rng.choice([0, 1, 2, 8]), rng.choice([10, 11, 12, None]), rng.choice([None, 1, 2]), float(rng.randint(1, 9))) for _ in range(60)]
    found = profit.profitability(spark.createDataFrame(returned, RETURNED), spark.createDataFrame(consumed, CONSUMED))
    want = spark.createDataFrame(
        by_pairs(consumed, returned),
        "a int, i bigint, f string, c bigint, n string, q bigint, v double, bq bigint, bv double, dq bigint, dv double",
    )
    assert rows_of(found) == rows_of(want)


def test_profitability_by_what_rows_met_by(spark):
    """Rows without a key share their fillers on both sides; they must not meet."""
    rng = random.Random(6)
    consumed, returned = [], []
    for _ in range(200):
        adm, code = rng.choice([0, 1, None]), rng.choice([0, 10, None])
        key = None if code is None or adm is None else f"{adm}-{code}"
        consumed.append((adm, rng.choice("MD"), key, rng.choice([None, adm]), rng.choice([None, "F1"]), code, None, rng.randint(1, 9), 2.0, 3, 8.0))
        returned.append((rng.choice([0, 1, 8, None]), rng.choice([0, 10, None]), rng.randint(1, 9), 1.0))
    filler = lambda: F.concat(F.lit("\x00lines\x00"), (F.rand(1) * 3).cast("int").cast("string"))
    left, right = spark.createDataFrame(consumed, CONSUMED), spark.createDataFrame(returned, RETURNED)
    met_left = left.withColumn(consumption.MEET, F.coalesce(F.col(consumption.KEY), filler()))
    met_right = right.withColumn(consumption.MEET, F.coalesce(joined_key("field_1", "CodigoGenerico"), filler()))
    for once in (False, True):
        assert rows_of(profit.profitability(met_right, met_left, once)) == rows_of(profit.profitability(right, left, once))


def test_profitability_can_count_groups_once(spark):
    consumed = spark.createDataFrame([(1, "M", "1-5", 1, "F", 5, "n", 10, 100.0, 9, 120.0)], CONSUMED)
    returned = spark.createDataFrame([(1, 5, 2, 20.0), (1, 5, 1, 10.0)], RETURNED)
    figures = ["Cantidad_Consumida", "Total_Consumido", "Cantidad_Facturada", "Diferencia_Total_Total"]
    assert rows_of(profit.profitability(returned, consumed), *figures) == [(17, 170.0, 18, 70.0)]
    assert rows_of(profit.profitability(returned, consumed, once=True), *figures) == [(7, 70.0, 9, 50.0)]


def test_reconciliation_limit_is_inclusive(spark):
    ddl = "Comprobante string, ValorTotal string"
    out = spark.createDataFrame([(vocab.DISPENSED, "2000.01"), (vocab.INTERNAL_OUT[0], "x"), ("OTRO", "9")], ddl)
    back = spark.createDataFrame([(vocab.INTERNAL_IN[1], "100")], ddl)

    def run(net):
        tables = {"a": spark.createDataFrame([(net,)], "ValorNeto bigint"), "b": spark.createDataFrame([], "ValorNeto bigint")}
        return reconcile.reconcile(out, back, tables, money="decimal(18,2)").first()

    row = run(900)
    assert float(row.total_limpio) == 1900.01 and float(row.diferencia) == 1000.01 and row.conciliacion_exitosa
    assert not run(899).conciliacion_exitosa
    with pytest.raises(KeyError):
        reconcile.reconcile(out.select("Comprobante"), back, {"a": out.select(F.lit(1).alias("ValorNeto"))})
    with pytest.raises(KeyError):
        reconcile.reconcile(out, back, {"a": out})
