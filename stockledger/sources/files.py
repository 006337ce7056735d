"""Files of a folder as rows: layouts that differ, files that are damaged, values that cannot be read.

* `relaxed`: frames of different types united by name, each column in the smallest type that holds all of its.
* `inspect_files`: layout, promised rows, rows read and damage of every file, in one job.
* `numbered_records`: lines of delimited text under the header of their own file, with line numbers.
* `conform`: declared types, with every value that does not fit them; `Landed` parts rows that are accepted
  from those that are not.

Nothing here goes over files on the driver. It holds one entry per distinct layout, with the paths of
the files where Parquet or ORC files differ, as Spark's own reader does.
"""

from __future__ import annotations

import csv
from collections.abc import Collection, Mapping
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.functions.distributed import materialize

SOURCE_FILE = "ArchivoOrigen"
# Everything but the lock files office programs leave behind, which start with "~$".
NOT_A_LOCK_FILE = "{[!~]*,~[!$]*}"
FILE, LINE, RECORD, WIDTH = "_file", "_line", "_record", "_width"
REJECT = "struct<column:string,text:string,reason:string,kept:boolean>"

# from narrow to wide; a wider type holds every value of the narrower ones
NUMBERS = [T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
TIMES = [T.DateType(), T.TimestampNTZType(), T.TimestampType()]


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The smallest type that holds the values of both; text where there is no other."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for ladder in (NUMBERS, TIMES):
        if a in ladder and b in ladder:
            return max(a, b, key=ladder.index)
    floats = (T.FloatType, T.DoubleType)
    if all(isinstance(x, (T.DecimalType, *floats)) or x in NUMBERS for x in (a, b)):
        if isinstance(a, floats) or isinstance(b, floats):
            return T.DoubleType()
        exact = [x if isinstance(x, T.DecimalType) else T.DecimalType(19, 0) for x in (a, b)]
        scale = max(x.scale for x in exact)
        whole = max(x.precision - x.scale for x in exact)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType), a.containsNull or b.containsNull)
    return T.StringType()


def relaxed(frames: list[DataFrame]) -> DataFrame:
    """All rows of the frames, united by column name; what a frame lacks is NULL in its rows."""
    types: dict[str, T.DataType] = {}
    for frame in frames:
        for field in frame.schema:
            types[field.name] = common_type(types.get(field.name, T.NullType()), field.dataType)

    def widened(frame: DataFrame) -> DataFrame:
        present = set(frame.columns)
        return frame.select(
            *[(F.col(f"`{c}`") if c in present else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
        )

    return reduce(DataFrame.unionAll, [widened(f) for f in frames])


def inspect_files(spark: SparkSession, path: str, fmt: str, pattern: str = NOT_A_LOCK_FILE) -> DataFrame:
    """`path`, `layout`, `promised`, `rows`, `damage` of every Parquet or ORC file, in one job over the files.

    `rows` were read to the end or to the damage. A file is one record of the job, so it must be smaller than 2 GB.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")

    def look(batches):
        import pyarrow.orc as orc
        import pyarrow.parquet as parquet

        for batch in batches:
            found = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                layout, promised, rows, damage = None, None, 0, None
                try:
                    source = pa.BufferReader(content.as_buffer())
                    if fmt == "orc":
                        file = orc.ORCFile(source)
                        schema, promised = file.schema, file.nrows
                        parts = (file.read_stripe(i) for i in range(file.nstripes))
                    else:
                        file = parquet.ParquetFile(source)
                        schema, promised = file.schema_arrow, file.metadata.num_rows
                        parts = file.iter_batches()
                    layout = "\n".join(f"{f.name}\t{f.type}" for f in schema)
                    for part in parts:
                        rows += part.num_rows
                except Exception as error:  # whatever the reader says of a damaged file
                    damage = f"{type(error).__name__}: {error}"
                if damage is None and rows != promised:
                    damage = f"{rows} of {promised} rows"
                found.append((name, layout, promised, rows, damage))
            types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*found), types)] if found else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "layout", "promised", "rows", "damage"])

    return files.mapInArrow(look, "path string, layout string, promised long, rows long, damage string")


def _compatible(layouts: list[tuple[str, list[str]]]) -> list[list[str]]:
    """Paths of layouts that agree in the types of the columns they share, which one scan can read."""
    classes: list[tuple[dict[str, str], list[str]]] = []
    for layout, paths in sorted(layouts):
        types = dict(line.split("\t", 1) for line in layout.split("\n") if line)
        for known, held in classes:
            if all(known.get(c, t) == t for c, t in types.items()):
                known.update(types)
                held += paths
                break
        else:
            classes.append((types, list(paths)))
    return [paths for _, paths in classes]


def read_layouts(spark: SparkSession, path: str, fmt: str, options: Mapping[str, str], skip_damaged: bool) -> list[DataFrame]:
    """One frame per set of Parquet or ORC files whose types agree; a damaged file is an error or left out whole."""
    looked = materialize(inspect_files(spark, path, fmt))
    if not skip_damaged:
        bad = looked.where("damage IS NOT NULL").orderBy("path").first()
        if bad:
            raise OSError(f"{bad['path']}: {bad['damage']}")
    layouts = looked.where("damage IS NULL AND layout != ''").groupBy("layout").agg(F.collect_list("path").alias("paths"))
    reader = spark.read.format(fmt).options(**{"mergeSchema": "true", **options})
    return [reader.load(paths) for paths in _compatible([(r["layout"], r["paths"]) for r in layouts.collect()])]


def with_place(df: DataFrame, fmt: str) -> DataFrame:
    """Adds the file of each row and, where the format knows it, the number of its row."""
    line = F.col("_metadata.row_index") + 1 if fmt == "parquet" else F.lit(None).cast("long")
    return df.select("*", F.col("_metadata.file_name").alias(FILE), line.alias(LINE), F.lit(None).cast("string").alias(RECORD))


def numbered_records(spark: SparkSession, path: str, options: Mapping[str, str], pattern: str = NOT_A_LOCK_FILE) -> DataFrame | None:
    """Records of delimited text files, each under the header of its own file; None where there is no header.

    All columns are text. The lines are parsed and written once with their place, so readers take the columns
    they need; a line's number is its place in its part of the file after the lines of the parts before. A
    record of another width than its header has that in `_record`. Blank lines are no records; a name that a
    header repeats gets its place.
    """
    given = {"sep": ",", "quote": '"', **{k: v for k, v in options.items() if k != "header"}}
    at = F.struct("block", "at")
    written = F.trim("value") != ""
    text = (
        spark.read.option("pathGlobFilter", pattern)
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_name").alias(FILE),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
        )
    )
    headers = materialize(text.where(written).groupBy("path").agg(F.min_by("value", at).alias("header")))
    distinct = [r["header"] for r in headers.select("header").distinct().orderBy("header").collect()]
    if not distinct:
        return None
    layouts = []
    for header in distinct:
        names = next(csv.reader([header.lstrip("﻿")], delimiter=given["sep"], quotechar=given["quote"]))
        names = [n if names.index(n) == i else f"{n}{i}" for i, n in enumerate(names)]
        layouts.append(names)
    parsed = [
        F.when(
            F.col("header") == header,
            F.from_csv(
                "value",
                ", ".join(f"`{n}` string" for n in [*names, WIDTH]),
                {**given, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": WIDTH},
            ),
        ).alias(f"_p{i}")
        for i, (header, names) in enumerate(zip(distinct, layouts))
    ]

    def of(name: str) -> Column:
        return F.coalesce(*[F.col(f"_p{i}.`{name}`") for i, names in enumerate(layouts) if name in names or name == WIDTH])

    every = list(dict.fromkeys(n for names in layouts for n in names))
    # one header per file is sent to its lines; its names are none that a table must be able to have
    lines = materialize(
        text.join(F.broadcast(headers), "path")
        .select("path", FILE, "block", "at", written.alias("written"), *parsed)
        .select("path", FILE, "block", "at", "written", *[of(n).alias(f"_c{i}") for i, n in enumerate(every)], of(WIDTH).alias(RECORD))
    )
    file = Window.partitionBy("path")
    earlier = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    top = F.col("block") == F.min(F.when(F.col("begins").isNotNull(), F.col("block"))).over(file)
    parts = (
        lines.groupBy("path", "block")
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("many"), F.min(F.when(F.col("written"), F.col("at"))).alias("begins"))
        .select("path", "block", "first", F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("before"), F.when(top, F.col("begins")).alias("header_at"))
    )
    is_record = ~F.col("at").eqNullSafe(F.col("header_at"))
    # one row per part of a file is sent to its lines, which stay in their order
    records = lines.where("written").join(F.broadcast(parts), ["path", "block"]).where(is_record)
    line = (F.col("at") - F.col("first") + F.col("before") + 1).alias(LINE)
    # a reader's condition may be looked at before the one above, and must not see a header's names as values
    return records.select(*[F.when(is_record, F.col(f"_c{i}")).alias(n) for i, n in enumerate(every)], FILE, line, RECORD)


def _fitted(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """`value` as `target`, NULL where it does not fit."""
    if isinstance(target, T.StringType) or isinstance(source, T.NullType):
        return value.cast(target)
    plain = isinstance(source, (T.StringType, T.NumericType, T.BooleanType)) or source in TIMES and target in TIMES
    return (value if plain else value.cast("string")).try_cast(target)


def conform(df: DataFrame, schema: T.StructType, lenient: Collection[str] = ()) -> DataFrame:
    """Declared columns in their types, absent ones as NULL, others as they are, and `_rejects`.

    A value that does not fit is NULL and an entry of `_rejects`; blank text counts as missing. In
    `lenient` columns the entry is a note, and the row is kept.
    """
    present = {f.name: f.dataType for f in df.schema}
    columns, rejects = [], []
    for field in schema:
        if field.name not in present:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value, source = F.col(f"`{field.name}`"), present[field.name]
        fitted = _fitted(value, source, field.dataType)
        columns.append(fitted.alias(field.name))
        if source != field.dataType and not isinstance(field.dataType, T.StringType):
            filled = value.isNotNull() & fitted.isNull()
            if isinstance(source, T.StringType):
                filled &= F.trim(value) != ""
            if RECORD in present:  # the values of a line of another width are not those of their columns
                filled &= F.col(RECORD).isNull()
            rejects.append(
                F.when(
                    filled,
                    F.struct(
                        F.lit(field.name),
                        value.cast("string"),
                        F.lit(f"no {field.dataType.simpleString()}"),
                        F.lit(field.name in lenient),
                    ).cast(REJECT),
                )
            )
    if RECORD in present:
        rejects.append(
            F.when(
                F.col(RECORD).isNotNull(),
                F.struct(F.lit(None), F.col(RECORD), F.lit("line of another width"), F.lit(False)).cast(REJECT),
            )
        )
    known = {f.name for f in schema} | {FILE, LINE, RECORD}
    others = [F.col(f"`{c}`") for c in df.columns if c not in known]
    place = [F.col(FILE), F.col(LINE)] if FILE in present else []
    found = F.array_compact(F.array(*rejects)) if rejects else F.lit(None).cast(f"array<{REJECT}>")
    return df.select(*columns, *others, *place, found.alias("_rejects"))


@dataclass(frozen=True)
class Landed:
    """Rows as they were read: what is accepted, what is not, and why. The two make up all rows."""

    rows: DataFrame

    def _refused(self) -> Column:
        return F.coalesce(F.exists("_rejects", lambda r: ~r.kept), F.lit(False))

    def _plain(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in (FILE, LINE, "_rejects")], F.col(FILE).alias(SOURCE_FILE))

    def accepted(self) -> DataFrame:
        """The rows in which every value that counts fits its type."""
        return self._plain(self.rows.where(~self._refused()))

    def strict(self) -> DataFrame:
        """All rows; one that is not accepted is an error that names its place when it is read."""
        first = F.get(F.filter("_rejects", lambda r: ~r.kept), F.lit(0))
        what = F.format_string(
            "%s, line %s: %s '%s' is a %s",
            F.col(FILE),
            F.coalesce(F.col(LINE).cast("string"), F.lit("?")),
            F.coalesce(first["column"], F.lit("record")),
            first["text"],
            first["reason"],
        )
        return self._plain(self.rows.where(F.when(self._refused(), F.raise_error(what)).otherwise(F.lit(True))))

    def rejected(self) -> DataFrame:
        """`file`, `line`, `column`, `text`, `reason`, `kept`, one row per value; `kept` rows are accepted without the value."""
        return self.rows.select(F.col(FILE).alias("file"), F.col(LINE).alias("line"), F.explode("_rejects").alias("r")).select("file", "line", "r.*")
