"""The entities of `schemas`, mapped from the TPC-H-like tables the queries run on.

Money is exact decimal and unit prices are whole ten-thousandths, so sums do not depend on the
order of rows. Only the 25 nations are hinted to broadcast; for the other tables Spark decides
by their size.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger import schemas, vocab
from stockledger.functions.distributed import shared_folder
from stockledger.sources.landing import rename_billing

MONEY = "decimal(18,2)"
FINE_MONEY = "decimal(18,4)"
SERVICES = [vocab.GENERAL, vocab.SPECIALISED, vocab.PREVENTION, vocab.CHRONIC, vocab.PHARMACY]
SEGMENT_SPECIALTIES = {
    "HOUSEHOLD": "MEDICINA GENERAL",
    "MACHINERY": "ODONTOLOGIA",
    "FURNITURE": "ENFERMERIA",
    "BUILDING": "ONCOLOGIA",
    "AUTOMOBILE": "CARDIOLOGIA",
}
UNKNOWN_VOUCHER = "OTR - OTRO MOVIMIENTO"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def _pick(options: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), index.cast("int") + 1)


def _money(column: str, kind: str = MONEY) -> Column:
    return F.col(column).cast(kind)


def _date_text(column: str) -> Column:
    return F.date_format(column, "dd/MM/yyyy")


def ledger_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger lines: one per line item, all 24 kinds of voucher, about a third not confirmed."""
    kinds = [
        (vocab.TRANSFER_VOUCHER if v in (vocab.TRANSFER_IN, vocab.TRANSFER_OUT) else v, s)
        for v, _, s, _ in vocab.VOUCHERS
    ] + [(UNKNOWN_VOUCHER, 1)]
    kind = F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(24))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return (
        line_items(spark, sf_dir)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(_date_text("l_shipdate"), F.lit(" 00:00:00")).alias("Fecha"),
            _pick(["ENTRADA" if s > 0 else "SALIDA" for _, s in kinds], kind).alias("TipoMovimiento"),
            _pick([v for v, _ in kinds], kind).alias("Comprobante"),
            F.when(F.col("o_orderstatus") == "P", "ANULADO").otherwise(vocab.CONFIRMED).alias("Estado"),
            F.col("n_name").alias("Bodega"),
            F.col("l_partkey").alias("CodigoGenerico"),
            F.col("p_type").alias("GrupoInventario"),
            F.col("p_name").alias("Generico"),
            F.col("s_name").alias("Tercero"),
            F.col("l_quantity").cast("bigint").alias("Cantidad"),
            _money("l_extendedprice").alias("ValorTotal"),
        )
    )


def article_code(part_key: str) -> Column:
    """Class digit and part number, so a quarter of the parts is in none of the three classes."""
    number = F.lpad(F.col(part_key).cast("string"), 12, "0")
    return F.concat((F.lit(1) + F.pmod(F.col(part_key), F.lit(4))).cast("string"), number)


def _site() -> Column:
    return F.lpad(F.col("s_nationkey").cast("string"), 3, "0")


def _service() -> Column:
    return _pick(SERVICES, F.pmod(F.col("l_suppkey"), F.lit(5)))


def _ten_thousandths(units: Column) -> Column:
    return (units.cast("decimal(18,0)") * F.lit("0.0001").cast("decimal(5,4)")).cast(FINE_MONEY)


def _cents() -> Column:
    return (_money("l_extendedprice") * 100).cast("bigint")


def _per_unit(amount: Column) -> Column:
    """Whole-number quotient, which both sides of a comparison compute alike."""
    return _ten_thousandths(F.floor(amount / F.col("l_quantity").cast("bigint")))


def movement_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispensed, returned and internal lines; every fiftieth admission is missing."""
    number = F.col("l_linenumber")
    order = F.col("l_orderkey")
    voucher = (
        F.when(number <= 3, vocab.DISPENSED)
        .when(number == 4, vocab.RETURNED)
        .when(number == 5, vocab.INTERNAL_OUT[0])
        .when(number == 6, vocab.INTERNAL_OUT[1])
        .otherwise(_pick(vocab.INTERNAL_IN, F.pmod(order, F.lit(3))))
    )
    document = F.when(F.pmod(order, F.lit(50)) == 49, "DOC SIN ADMISION").otherwise(
        F.concat(F.lit("DOC ADM: "), order.cast("string"))
    )
    group = F.pmod(F.col("l_partkey"), F.lit(10)).cast("string")
    kind = _pick(["AMB", "HOS"], F.pmod(F.col("l_suppkey"), F.lit(2)))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return (
        line_items(spark, sf_dir)
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            voucher.alias("Comprobante"),
            order.alias("Numero"),
            _date_text("l_shipdate").alias("Fecha"),
            document.alias("NoDocumento"),
            F.col("s_name").alias("Proveedor"),
            F.concat(_site(), _service(), F.lit("-"), kind).alias("CentroCosto"),
            F.concat(F.lit("DEP "), F.pmod(F.col("l_suppkey"), F.lit(10)).cast("string")).alias("Dependencia"),
            F.concat(F.lit("BODEGA "), F.pmod(F.col("s_nationkey"), F.lit(5)).cast("string")).alias("Bodega"),
            F.concat(F.lit("G"), group).alias("CodGrupo"),
            F.concat(F.lit("GRUPO "), group).alias("Grupo"),
            article_code("l_partkey").alias("CodArticulo"),
            F.col("l_quantity").cast("bigint").alias("Cantidad"),
            _per_unit(_cents() * 100).alias("ValorUnitario"),
            _money("l_extendedprice").alias("TotalBruto"),
            (_money("l_extendedprice") * _money("l_tax", "decimal(4,2)")).cast(FINE_MONEY).alias("ValorIVA"),
            (_money("l_extendedprice") * _money("l_discount", "decimal(4,2)")).cast(FINE_MONEY).alias("ValorDescuento"),
            _money("l_extendedprice").alias("ValorTotal"),
            F.lit("UND").alias("Unidad"),
            F.concat(F.lit("USR"), number.cast("string")).alias("User"),
            _date_text("l_shipdate").alias("FechaDigitacion"),
        )
    )


def _billed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # orders meet their customers first, which are fewer rows than their lines
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return (
        line_items(spark, sf_dir)
        .where(F.pmod(F.col("l_partkey"), F.lit(11)) != 0)
        .join(orders.join(customer, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
    )


def _billing_columns() -> list[Column]:
    segment = F.col("c_mktsegment")
    specialty = F.element_at(
        F.create_map(*[F.lit(x) for pair in SEGMENT_SPECIALTIES.items() for x in pair]), segment
    )
    percent = F.lit(55) + F.pmod(F.col("l_partkey"), F.lit(12)) * 10
    return [
        F.col("l_orderkey").alias("idadmision"),
        F.concat(
            F.lit("F"), F.col("l_orderkey").cast("string"), F.lit("-"), F.pmod("l_linenumber", F.lit(2)).cast("string")
        ).alias("nofactura"),
        F.concat(F.lit("CC"), F.col("c_custkey").cast("string")).alias("idusuario"),
        F.when(F.col("l_linenumber") <= 4, vocab.PHARMACY_BILLING).otherwise("LABORATORIO").alias("nomtiposervicio"),
        F.col("l_partkey").cast("string").alias("codigo"),
        F.col("l_quantity").cast("bigint").alias("cantidad"),
        (F.col("l_quantity").cast("bigint") + 1).alias("CantidadSolicitada"),
        _per_unit(_cents() * percent).alias("vrunitario"),
        _ten_thousandths(_cents() * percent).alias("vrtotal"),
        specialty.alias("Especialidad"),
        F.when(F.col("o_orderstatus") != "P", F.col("c_name")).alias("MedicoRealiza"),
    ]


def billing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing lines at 55 to 165 percent of cost; every eleventh part is never billed."""
    name = F.concat(F.lit("ART "), F.col("l_partkey").cast("string")).alias("nombre")
    return rename_billing(_billed_lines(spark, sf_dir).select(*_billing_columns(), name))


def site_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing lines that carry product, site and service, as the financial report takes them."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    placed = (
        _billed_lines(spark, sf_dir)
        .where(F.col("l_linenumber") <= 4)
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            *_billing_columns(),
            F.col("l_partkey").alias("CodigoGenerico"),
            F.col("p_name").alias("Nombre"),
            _site().alias("Municipio"),
            _service().alias("Servicio"),
            _service().alias("Servicio_Corregido"),
        )
    )
    return rename_billing(placed)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        article_code("p_partkey").alias("Codigo"),
        F.col("p_name").alias("Nombre"),
        F.col("p_partkey").cast("string").alias("CodigoGenerico"),
        F.when(F.pmod("p_size", F.lit(10)) == 0, "INACTIVO").otherwise("ACTIVO").alias("EstadoArticulo"),
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth customer is an external entity."""
    customer = table(spark, sf_dir, "customer")
    return customer.where(F.pmod("c_custkey", F.lit(20)) == 0).select(F.col("c_name").alias("entidad"))


def landed_ledger(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the ledger lines as Parquet files of three layouts: numeric codes, padded text codes, and
    quantities as doubles without the product group."""
    folder = f"{shared_folder(spark)}/landed-{uuid.uuid4().hex}"
    lines, code = ledger_lines(spark, sf_dir), F.col("CodigoGenerico")
    kind = F.pmod(code, F.lit(3))
    lines.where(kind == 0).write.mode("append").parquet(folder)
    lines.where(kind == 1).withColumn("CodigoGenerico", F.lpad(code.cast("string"), 8, "0")).write.mode("append").parquet(folder)
    lines.where(kind == 2).withColumn("Cantidad", F.col("Cantidad").cast("double")).drop("GrupoInventario").write.mode("append").parquet(folder)
    return folder


def landed_billing(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the billing lines as unquoted text, some with an unreadable number and some with a comma in a name."""
    folder = f"{shared_folder(spark)}/landed-{uuid.uuid4().hex}"
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    name = F.concat(F.lit("ART"), F.when(F.pmod(part, F.lit(101)) == 0, ", GRANDE ").otherwise(" "), part.cast("string"))
    lines = _billed_lines(spark, sf_dir).select(*_billing_columns(), name.alias("nombre"))
    admission = F.col("idadmision")
    quantity, value = F.col("cantidad").cast("string"), F.col("vrtotal").cast("string")
    lines = lines.withColumns(
        {
            "cantidad": F.when(F.pmod(admission, F.lit(97)) == 0, F.concat(F.lit("x"), quantity)).otherwise(quantity),
            "vrtotal": F.when(F.pmod(admission, F.lit(89)) == 0, F.lit("1.234.50")).otherwise(value),
        }
    )
    columns = [field.split()[0] for field in schemas.BILLING_DDL.split(", ")]
    # a comma in the name shifts all columns after it
    lines.select(columns).write.options(header="true", quote="\u0000").csv(folder)
    return folder
