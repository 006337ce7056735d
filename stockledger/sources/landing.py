"""Reading landed reports: the ledger folder, the four extracts, and period texts."""

from __future__ import annotations

import logging
from collections.abc import Collection, Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger import schemas
from stockledger.functions.distributed import materialize
from stockledger.functions.exprs import as_column, strip
from stockledger.sources.files import (
    FILE,
    LINE,
    NOT_A_LOCK_FILE,
    RECORD,
    SOURCE_FILE,
    Landed,
    conform,
    numbered_records,
    read_layouts,
    relaxed,
    with_place,
)

log = logging.getLogger(__name__)

def with_source_file(df: DataFrame) -> DataFrame:
    """Adds the name of the file each row came from."""
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_name"))


def _declared(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _types_differ(error: Exception) -> bool:
    return "CANNOT_MERGE" in str(error)


def require_columns(df: DataFrame, needed: Iterable[str], what: str) -> DataFrame:
    """The frame itself; an error that names the columns it lacks."""
    absent = [c for c in needed if c not in df.columns]
    if absent:
        raise KeyError(f"{what} has no column {', '.join(absent)}; it has {', '.join(df.columns) or 'none'}")
    return df


def read_landed(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType,
    options: Mapping[str, str] | None = None,
    skip_damaged: bool = False,
    per_file_layout: bool | None = None,
    lenient: Collection[str] = (),
    needed: Iterable[str] = (),
    what: str | None = None,
) -> Landed | None:
    """The rows of a file or folder in the declared types, with what cannot be read; None without any file.

    Parquet and ORC files are read by column name in one scan in their merged schema. Where their types
    do not go together, where damaged files are to be left out, or with `per_file_layout`, one job looks
    at every file first; files whose types agree are then read together and united in the common types.
    Text files are read under their own headers, other formats in the schema Spark finds.
    """
    options, what = dict(options or {}), what or path
    try:
        if fmt == "csv":
            found = numbered_records(spark, path, options)
            layouts = [] if found is None else [found]
        elif fmt in ("parquet", "orc"):
            layouts = None
            if not (skip_damaged or per_file_layout):
                reader = spark.read.format(fmt).options(**{"mergeSchema": "true", **options})
                try:
                    layouts = [with_place(reader.option("pathGlobFilter", NOT_A_LOCK_FILE).load(path), fmt)]
                except Exception as error:
                    if not _types_differ(error):
                        raise
            if layouts is None:
                layouts = [with_place(x, fmt) for x in read_layouts(spark, path, fmt, options, skip_damaged)]
        else:
            found = spark.read.format(fmt).options(**options).option("pathGlobFilter", NOT_A_LOCK_FILE).load(path)
            damaged = [c for c in ("_corrupt_record",) if c in found.columns]
            found = with_place(found, fmt)
            if damaged:  # Spark keeps such texts from queries that read nothing else, but not from written rows
                found = materialize(found.withColumn(RECORD, F.col(damaged[0])).drop(*damaged))
            layouts = [found]
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        log.warning("no files in %s: %s", path, error)
        return None
    if not layouts:
        return None
    require_columns(relaxed([x.limit(0).drop(FILE, LINE, RECORD) for x in layouts]), needed, what)
    return Landed(relaxed([conform(x, schema, lenient) for x in layouts]))


def ingest_ledger(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    ddl: str = schemas.LEDGER_DDL,
    per_file_layout: bool | None = None,
    options: Mapping[str, str] | None = None,
    skip_damaged: bool = False,
    needed: Iterable[str] = (),
    lenient: Collection[str] = schemas.LEDGER_LENIENT,
) -> DataFrame:
    """All ledger files of a folder as one frame with the declared schema and `ArchivoOrigen`.

    Columns the schema does not know keep the common type of the files. A missing or empty folder
    gives an empty frame of the declared schema. Unreadable values in `lenient` columns are NULL; any
    other, a line of another width than its header, and a damaged file are errors that name their
    place. `ledger_landing` gives both sides instead. With `skip_damaged` a damaged file is left out as
    a whole; `files_without_rows` names it. Columns in `needed` that no file has are an error; one
    that only some files lack is NULL in their lines.
    """
    landed = ledger_landing(spark, path, fmt, ddl, per_file_layout, options, skip_damaged, needed, lenient)
    if landed is None:
        return spark.createDataFrame([], T.StructType([*_declared(ddl).fields, T.StructField(SOURCE_FILE, T.StringType())]))
    return landed.strict()


def ledger_landing(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    ddl: str = schemas.LEDGER_DDL,
    per_file_layout: bool | None = None,
    options: Mapping[str, str] | None = None,
    skip_damaged: bool = False,
    needed: Iterable[str] = (),
    lenient: Collection[str] = schemas.LEDGER_LENIENT,
) -> Landed | None:
    """The accepted and rejected rows of a ledger folder; None without any file."""
    return read_landed(spark, path, fmt, _declared(ddl), options, skip_damaged, per_file_layout, lenient, needed)


def files_without_rows(spark: SparkSession, path: str, ledger: DataFrame) -> DataFrame:
    """The files of the folder no ledger line came from: empty ones and those left out."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", NOT_A_LOCK_FILE).load(path)
    names = listed.select(F.col("_metadata.file_name").alias(SOURCE_FILE))
    return names.join(ledger.select(SOURCE_FILE).distinct(), SOURCE_FILE, "left_anti")


def rename_billing(billing: DataFrame) -> DataFrame:
    """Gives the billing columns that clash with the ledger's by case names of their own."""
    return billing.select(*[F.col(c).alias(schemas.BILLING_NAMES.get(c, c)) for c in billing.columns])


def ingest_extracts(
    spark: SparkSession,
    paths: Mapping[str, str],
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    needed: Mapping[str, Iterable[str]] | None = None,
) -> dict[str, DataFrame]:
    """The four extracts by role: `billing`, `out`, `in`, `listing`. Each path must exist.

    Undeclared columns keep the common type of the files. A role's columns in `needed` are an error
    where they are absent, other declared ones are NULL then. A value that is not of its declared type,
    or a line of another width than its header, is an error that names its place when it is read.
    """
    landed = extract_landings(spark, paths, fmt, options, needed)
    return {role: _extract(role, x.strict()) for role, x in landed.items()}


def split_extracts(
    spark: SparkSession,
    paths: Mapping[str, str],
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    needed: Mapping[str, Iterable[str]] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The accepted rows of the four extracts by role, and what was rejected with its `role`."""
    landed = extract_landings(spark, paths, fmt, options, needed)
    rejected = [x.rejected().select(F.lit(role).alias("role"), "*") for role, x in landed.items()]
    return {role: _extract(role, x.accepted()) for role, x in landed.items()}, reduce(DataFrame.unionAll, rejected)


def _extract(role: str, rows: DataFrame) -> DataFrame:
    rows = rows.drop(SOURCE_FILE)
    return rename_billing(rows) if role == "billing" else rows


def extract_landings(
    spark: SparkSession,
    paths: Mapping[str, str],
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    needed: Mapping[str, Iterable[str]] | None = None,
) -> dict[str, Landed]:
    """The four extracts by role with what is accepted and what is not. Each path must exist."""
    ddls = {
        "billing": schemas.BILLING_DDL,
        "out": schemas.EXTRACT_DDL,
        "in": schemas.EXTRACT_DDL,
        "listing": schemas.LISTING_DDL,
    }
    absent = [role for role in ddls if role not in paths]
    if absent:
        raise KeyError(f"no path given for {', '.join(absent)}")
    found = {}
    for role, ddl in ddls.items():
        what = f"{role} extract {paths[role]}"
        landed = read_landed(spark, paths[role], fmt, _declared(ddl), options, needed=(needed or {}).get(role, ()), what=what)
        if landed is None:
            raise FileNotFoundError(f"{role} extract not found: {paths[role]}")
        found[role] = landed
    return found


def read_entities(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """External entities, one exact text per row; blanks are part of the name."""
    return spark.read.format(fmt).schema(_declared(schemas.ENTITIES_DDL)).load(path)


def _period_date(period: Column | str) -> Column:
    return F.to_date(F.replace(strip(as_column(period)), F.lit("-"), F.lit("/")), "d/M/yyyy")


def normalize_period(period: Column | str) -> Column:
    """Day/month/year text, with - or / and one- or two-digit parts, as `dd/MM/yyyy`."""
    return F.date_format(_period_date(period), "dd/MM/yyyy")


def period_month(period: Column | str) -> Column:
    """Two-digit month of a day/month/year text."""
    return F.date_format(_period_date(period), "MM")

