"""Findings where cost centre, specialty and doctor do not fit together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger import vocab
from stockledger.functions.exprs import first_match
from stockledger.operators.consumption import ENTITY, flag_entities

KEYS = ["CentroCosto", "Especialidad", "MedicoRealiza"]
RULE = "regla"


def _condition(rule: int) -> Column:
    service, specialties, listed_is_wrong = vocab.AUDIT_RULES[rule]
    here = F.col("Servicio") == service
    if specialties is None:
        return here & ~F.col(ENTITY)
    listed = F.col("Especialidad").isin(specialties)
    return here & (listed if listed_is_wrong else ~listed)


def audit(billed: DataFrame, entities: DataFrame, rules: list[int] | None = None, keep_rule: bool = False) -> DataFrame:
    """Counts per cost centre, specialty and doctor for the chosen rules, in one pass.

    Each rule has a service of its own, so a row meets at most one. NULL never meets any.
    """
    rules = list(vocab.AUDIT_RULES) if rules is None else rules
    tag = first_match([(_condition(r), F.lit(r)) for r in rules], otherwise=F.lit(None).cast("int"))
    narrow = billed.select("Servicio", *KEYS)
    flagged = flag_entities(narrow, entities) if 5 in rules else narrow
    found = (
        flagged.withColumn(RULE, tag)
        .where(F.col(RULE).isNotNull())
        .groupBy(RULE, *KEYS)
        .agg(F.count("CentroCosto").alias("Cantidad Registros"))
    )
    return found if keep_rule else found.drop(RULE)
