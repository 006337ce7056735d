"""Dispensing lines enriched with products and billing, returns attributed to services."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger import vocab
from stockledger.functions.exprs import as_is, first_match, joined_key, mean, split_key, spread_null_key, strip, sum0
from stockledger.schemas import BILLING_GRAIN, GRAIN, UNCLOSED_COLUMNS

KEY = "ADM-CodGen"
# What rows meet their billing by; a frame that has it was summed in the partitions of the join.
MEET = "_k"
# few columns, because those the hash reads cannot be pruned
SPREAD = ["NoDocumento", "Fecha", "Proveedor"]
# of the movement fields, those that columns of the grain decide
TOLD_BY_GRAIN = ["field_1", "Municipio", "Servicio", "Tipo_servicio"]
ENTITY = "_is_entity"


def extract_admission(document: str = "NoDocumento") -> Column:
    """The number after the first `ADM: ` of a document text, 0 when there is none."""
    part = F.get(F.split(F.col(document), "ADM: ", 8), F.lit(1))
    return F.coalesce(strip(part).try_cast("int"), F.lit(0))


def classify_article(code: str = "CodArticulo") -> Column:
    rules = [(F.startswith(F.col(code), F.lit(p)), name) for p, name in vocab.ARTICLE_CLASSES.items()]
    return first_match(rules, otherwise=vocab.OTHER_CLASS)


def split_cost_centre(df: DataFrame, centre: str = "CentroCosto") -> DataFrame:
    """Site, service and service kind from `SSSservice-kind`; the kind is NULL without a hyphen."""
    return df.withColumns(
        {
            "Municipio": F.substring(centre, 1, 3),
            "Servicio": strip(F.get(F.split(F.substr(F.col(centre), F.lit(4)), "-"), F.lit(0))),
            "Tipo_servicio": strip(F.get(F.split(F.col(centre), "-"), F.lit(1))),
        }
    )


def movement_fields(extract: DataFrame) -> DataFrame:
    """Admission, article class and cost centre parts of a movement extract."""
    return split_cost_centre(
        extract.withColumns({"field_1": extract_admission(), "Clasificacion_consumo": classify_article()})
    )


def product_listing(listing: DataFrame) -> DataFrame:
    return listing.select("Codigo", "Nombre", "CodigoGenerico", "EstadoArticulo")


def _dealt(df: DataFrame, key: Column, side: str, over: list[str]) -> DataFrame:
    """Rows dealt by what they meet by, which is added behind the shuffle, as the rows hold what it is made of."""
    meet = spread_null_key(key, side, over)
    return df.repartition(meet).withColumn(MEET, meet)


def billing_by_admission(billing: DataFrame, money: str = "double", meet: bool = False) -> DataFrame:
    """Pharmacy billing per admission, invoice, product and doctor. Unreadable numbers fail.

    With `meet` it is ready to be joined to lines, as in `enrich_and_grain`.
    """
    columns = [*BILLING_GRAIN, "billed_qty", "requested_qty", "billed_unit_price", "billed_value"]
    typed = (
        billing.where(F.col("nomtiposervicio") == vocab.PHARMACY_BILLING)
        .select(*columns)
        .withColumns(
            {
                "billed_qty": F.col("billed_qty").cast("bigint"),
                "requested_qty": F.col("requested_qty").cast("bigint"),
                "billed_unit_price": F.col("billed_unit_price").cast(money),
                "billed_value": F.col("billed_value").cast(money),
            }
        )
    )
    grain = list(BILLING_GRAIN)
    if meet:
        typed = _dealt(typed, joined_key(F.col("idadmision").cast("bigint"), F.col("codigo")), "billing", BILLING_GRAIN)
        grain.append(MEET)
    return (
        typed.groupBy(*grain)
        .agg(
            sum0("billed_qty").alias("billed_qty"),
            sum0("requested_qty").alias("requested_qty"),
            mean("billed_unit_price").alias("billed_unit_price"),
            sum0("billed_value").alias("billed_value"),
        )
        .withColumns(
            {
                "# Identificacion": F.substring(F.col("idusuario").cast("string"), 3, 20),
                "idadmision": F.col("idadmision").cast("bigint"),
            }
        )
        .withColumn(KEY, joined_key("idadmision", "codigo"))
    )


def split_by_voucher(out_lines: DataFrame, in_lines: DataFrame) -> dict[str, DataFrame]:
    """The four roles: dispensed and internal out, returned and internal in."""
    voucher = F.col("Comprobante")
    return {
        "dispensed": out_lines.where(voucher == vocab.DISPENSED),
        "internal_out": out_lines.where(voucher.isin(vocab.INTERNAL_OUT)),
        "returned": in_lines.where(voucher == vocab.RETURNED),
        "internal_in": in_lines.where(voucher.isin(vocab.INTERNAL_IN)),
    }


def enrich_and_grain(lines: DataFrame, listing: DataFrame, meet: bool = False, bare: bool = False) -> DataFrame:
    """Lines with their product, summed to the common grain, and their admission-product key.

    A code listed twice doubles its lines, as in any join. The listing carries no broadcast
    hint: Spark decides by its size. With `meet` the lines are dealt by the key of their billing,
    which the grain decides, before they are summed: one shuffle for the sum and the join. `bare` lines
    have no `movement_fields` yet; they are added behind the shuffles, which need not move them.
    """
    joined = lines.join(product_listing(listing), F.col("CodArticulo") == F.col("Codigo"), "left")
    joined, grain = joined.withColumn("CodigoGenerico", F.col("CodigoGenerico").cast("bigint")), list(GRAIN)
    admission = F.col("field_1")
    if bare:
        joined, admission = joined.withColumn("Clasificacion_consumo", classify_article()), extract_admission()
        grain = [c for c in GRAIN if c not in TOLD_BY_GRAIN]
    if meet:
        joined = _dealt(joined, joined_key(admission, "CodigoGenerico"), "lines", SPREAD)
        grain.append(MEET)
    grained = (
        joined.groupBy(*grain)
        .agg(
            sum0("Cantidad").alias("Cantidad"),
            mean("ValorUnitario").alias("ValorUnitario"),
            *[sum0(c).alias(c) for c in ("TotalBruto", "ValorIVA", "ValorDescuento", "ValorTotal")],
        )
    )
    if bare:
        measures = [c for c in grained.columns if c not in grain]
        fields = split_cost_centre(grained.withColumn("field_1", extract_admission()))
        grained = fields.select(*GRAIN, *([MEET] if meet else []), *measures)
    return grained.withColumn(KEY, joined_key("field_1", "CodigoGenerico"))


def _left_join_on_key(lines: DataFrame, billing: DataFrame, meet: bool = False) -> DataFrame:
    """Billing to the lines of the same admission and product; several invoices repeat the line.

    With `meet` the column the two met by stays, and what is summed by it needs no shuffle.
    """
    left, right = lines, billing.where(F.col(KEY).isNotNull())
    if MEET not in lines.columns:
        spread = [c for c in SPREAD if c in lines.columns] or lines.columns
        left = lines.withColumn(MEET, spread_null_key(KEY, "lines", spread))
    right = right.drop(KEY) if MEET in billing.columns else right.withColumnRenamed(KEY, MEET)
    joined = left.join(right, MEET, "left")
    return joined if meet else joined.drop(MEET)


def consumption_with_billing(dispensed: DataFrame, billing: DataFrame, meet: bool = False) -> DataFrame:
    return _left_join_on_key(dispensed, billing, meet)


def _known_entities(entities: DataFrame) -> DataFrame:
    """The names as they stand, blanks included, once each."""
    name = entities.columns[0]
    names = entities.where(F.col(name).isNotNull()).select(F.col(name).alias("_entity")).distinct()
    return names.withColumn("_entity_split", split_key("_entity"))


def flag_entities(df: DataFrame, entities: DataFrame) -> DataFrame:
    """Adds whether the doctor is an external entity; NULL for a NULL doctor.

    Rows without a doctor meet nobody, and are spread over texts that match nothing.
    """
    over = [c for c in ("NoDocumento", "Fecha", KEY, "idadmision") if c in df.columns] or df.columns
    keyed = df.withColumn("_doctor", spread_null_key("MedicoRealiza", "doctor", over))
    same = (F.col("_doctor") == F.col("_entity")) & (split_key("_doctor") == F.col("_entity_split"))
    joined = keyed.join(_known_entities(entities), same, "left")
    flag = F.when(F.col("MedicoRealiza").isNotNull(), F.col("_entity").isNotNull())
    return joined.withColumn(ENTITY, flag).drop("_entity", "_entity_split", "_doctor")


def corrected_service(df: DataFrame, entities: DataFrame) -> DataFrame:
    """`Servicio_Corregido` from service, specialty and doctor; the first rule that holds.

    A NULL doctor is neither an entity nor not one, so no rule holds.
    """
    service, specialty = F.col("Servicio"), F.col("Especialidad")
    entity = F.col(ENTITY)
    general = specialty.isin(vocab.GENERAL_SPECIALTIES)
    rules = [
        ((service == vocab.PHARMACY) & entity, vocab.PHARMACY),
        ((service == vocab.GENERAL) & ~general & ~entity, vocab.SPECIALISED),
        ((service == vocab.SPECIALISED) & general & ~entity, vocab.GENERAL),
        (service.isin(vocab.SPECIALISED, vocab.GENERAL) & (specialty == vocab.NURSING) & ~entity, vocab.PREVENTION),
        (specialty.isin(vocab.ONCOLOGY_SPECIALTIES) & ~entity, vocab.ONCOLOGY),
    ]
    flagged = flag_entities(df, entities)
    return flagged.withColumn("Servicio_Corregido", first_match(rules, otherwise=service)).drop(ENTITY)


def attribute_returns(
    returned: DataFrame, billing: DataFrame, entities: DataFrame, meet: bool = False, people: DataFrame | None = None
) -> DataFrame:
    """Returns with every specialty and doctor of their admission, and the billing of their product.

    The second join's specialty and doctor stay apart as `Especialidad_right`, `MedicoRealiza_right`. `people` is
    the same billing for the first join, where `billing` has been dealt by product and would be moved for nothing.
    """
    people = (billing if people is None else people).select(F.col("idadmision").alias("_adm"), "Especialidad", "MedicoRealiza")
    admission = F.col("field_1").cast("bigint")
    same = (admission == F.col("_adm")) & (F.xxhash64(admission) == split_key("_adm"))
    attributed = returned.join(people.dropDuplicates(), same, "left").drop("_adm")
    right = billing.withColumnsRenamed(
        {"Especialidad": "Especialidad_right", "MedicoRealiza": "MedicoRealiza_right"}
    )
    return _left_join_on_key(corrected_service(attributed, entities), right, meet)


def unclosed_billing(corrected: DataFrame) -> DataFrame:
    """Dispensed rows without a doctor, whose invoice is to be closed."""
    return corrected.where(F.col("MedicoRealiza").isNull()).select(*UNCLOSED_COLUMNS)


def override_specialty(corrected: DataFrame) -> DataFrame:
    """Outside the two consultation services the corrected service takes the specialty's place."""
    service = F.col("Servicio_Corregido")
    consultation = service.isin(vocab.GENERAL, vocab.SPECIALISED)
    return corrected.withColumn("Especialidad", F.when(consultation, F.col("Especialidad")).otherwise(service))


def prepare_consumption(
    out_extract: DataFrame,
    in_extract: DataFrame,
    billing: DataFrame,
    listing: DataFrame,
    entities: DataFrame,
    money: str = "double",
    keep: Callable[[DataFrame], DataFrame] | None = None,
    meet: bool = False,
) -> dict[str, DataFrame]:
    """The seven datasets of the consumption reports.

    With `meet` the returns and the input of the profitability hold the column `MEET` besides, which they
    are partitioned by.

    For one dataset each role is filtered from its extract alone. A caller that reads several gives
    `keep`, such as `materialize`: it is applied to what they share, which is the movement lines that
    count, their grains in one pass over both roles (the voucher is part of the grain), the billing
    per admission, and the consumption with its billing. Each extract is then read once.
    """
    out_lines, in_lines = movement_fields(out_extract), movement_fields(in_extract)
    if keep is None:
        keep, roles, bare = as_is, split_by_voucher(out_lines, in_lines), split_by_voucher(out_extract, in_extract)
        grains = {role: enrich_and_grain(bare[role], listing, role == "dispensed", bare=True) for role in ("dispensed", "returned")}
        billed_lines, people = billing_by_admission(billing, money, meet=True), billing_by_admission(billing, money)
    else:
        voucher = F.col("Comprobante")
        out_role = F.when(voucher == vocab.DISPENSED, "dispensed").when(voucher.isin(vocab.INTERNAL_OUT), "internal_out")
        in_role = F.when(voucher == vocab.RETURNED, "returned").when(voucher.isin(vocab.INTERNAL_IN), "internal_in")
        out_lines, in_lines = out_lines.withColumn("_role", out_role), in_lines.withColumn("_role", in_role)
        lines = keep(out_lines.unionByName(in_lines, allowMissingColumns=True).where(F.col("_role").isNotNull()))
        columns = {"dispensed": out_lines, "internal_out": out_lines, "returned": in_lines, "internal_in": in_lines}
        roles = {role: lines.where(F.col("_role") == role).select(*df.drop("_role").columns) for role, df in columns.items()}
        both = keep(enrich_and_grain(lines.where(F.col("_role").isin("dispensed", "returned")), listing))
        grains = {"dispensed": both.where(voucher == vocab.DISPENSED), "returned": both.where(voucher == vocab.RETURNED)}
        billed_lines = people = keep(billing_by_admission(billing, money))
    met = keep(consumption_with_billing(grains["dispensed"], billed_lines, meet))
    with_billing = met.drop(MEET)
    corrected = corrected_service(with_billing, entities)
    billed = override_specialty(corrected)
    return {
        "billed": billed,
        "unclosed": unclosed_billing(corrected),
        "billed_clean": billed,
        "internal_out": roles["internal_out"],
        "returns": attribute_returns(grains["returned"], billed_lines, entities, meet, people),
        "internal_in": roles["internal_in"],
        "profitability_input": met if meet else with_billing,
    }


def control_totals(datasets: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and total value of each dataset; one under two names is read once."""
    names: dict[int, list[str]] = {}
    for name, df in datasets.items():
        names.setdefault(id(df), []).append(name)
    totals = []
    for same in names.values():
        df = datasets[same[0]]
        total = df.agg(F.count(F.lit(1)).alias("filas"), sum0("ValorTotal").alias("ValorTotal"))
        label = F.explode(F.array(*[F.lit(n) for n in same]))
        totals.append(total.select(label.alias("conjunto"), "filas", F.lit(len(df.columns)).alias("columnas"), "ValorTotal"))
    return reduce(DataFrame.unionByName, totals)


def extract_quality(lines: DataFrame) -> DataFrame:
    """Counts of lines whose cost centre or document does not have the expected form."""
    return lines.agg(
        F.count_if(F.col("Tipo_servicio").isNull()).alias("sin_tipo_servicio"),
        F.count_if(F.col("field_1") == 0).alias("sin_admision"),
    )
