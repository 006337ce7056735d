"""Landed files in, report datasets out."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from row_values import rows_of
from stockledger import schemas
from stockledger.sources import files, landing, sinks


def put(path, name, text):
    (path / name).write_text(text)


def test_csv_files_of_different_layouts_are_united_by_name(spark, tmp_path):
    put(tmp_path, "a.csv", "Fecha,Comprobante,Cantidad,ValorTotal\n01/01/2024,RMC,5,10.5\n")
    put(tmp_path, "b.csv", "Cantidad,Comprobante,Nota\nx,DC,hola\n7,DC,\n")
    put(tmp_path, "~$a.csv", "lock\n")
    put(tmp_path, "~c.csv", "Comprobante,Cantidad\nEDO,1\n")
    found = landing.ingest_ledger(spark, str(tmp_path), "csv")
    assert rows_of(found, "Comprobante", "Cantidad", "ValorTotal", "Nota", "ArchivoOrigen") == [
        ("DC", None, None, "hola", "b.csv"), ("DC", 7, None, None, "b.csv"),
        ("EDO", 1, None, None, "~c.csv"), ("RMC", 5, 10.5, None, "a.csv"),
    ]
    assert dict(found.dtypes)["Cantidad"] == "bigint"


def test_missing_or_empty_folder_gives_an_empty_typed_frame(spark, tmp_path):
    for path in (tmp_path / "none", tmp_path):
        for fmt in ("parquet", "csv"):
            found = landing.ingest_ledger(spark, str(path), fmt)
            assert found.count() == 0
            assert found.columns[:3] == ["Fecha", "TipoMovimiento", "Comprobante"] and "ArchivoOrigen" in found.columns


def test_parquet_files_with_missing_columns_and_a_broken_file(spark, tmp_path):
    spark.createDataFrame([("RMC", 5)], "Comprobante string, Cantidad bigint").coalesce(1).write.parquet(f"{tmp_path}/x")
    spark.createDataFrame([("DC",)], "Comprobante string").coalesce(1).write.parquet(f"{tmp_path}/y")
    landing_dir = tmp_path / "in"
    landing_dir.mkdir()
    for part in ("x", "y"):
        file = next((tmp_path / part).glob("*.parquet"))
        (landing_dir / f"{part}.parquet").write_bytes(file.read_bytes())
    put(landing_dir, "broken.parquet", "not parquet")
    with pytest.raises(Exception, match="broken.parquet"):
        landing.ingest_ledger(spark, str(landing_dir)).count()
    found = landing.ingest_ledger(spark, str(landing_dir), skip_damaged=True)
    assert rows_of(found, "Comprobante", "Cantidad", "ArchivoOrigen") == [("DC", None, "y.parquet"), ("RMC", 5, "x.parquet")]
    assert rows_of(landing.files_without_rows(spark, str(landing_dir), found)) == [("broken.parquet",)]
    with pytest.raises(Exception, match="broken.parquet"):
        landing.ingest_ledger(spark, str(landing_dir), per_file_layout=True)
    each = landing.ingest_ledger(spark, str(landing_dir), per_file_layout=True, skip_damaged=True)
    assert rows_of(each, "Comprobante", "Cantidad") == [("DC", None), ("RMC", 5)]


def test_files_of_other_types_lose_no_line(spark, tmp_path):
    rows = [("RMC", 5, "7.50", "x"), ("DC", 6, "8.25", "y")]
    typed = spark.createDataFrame(rows, "Comprobante string, Cantidad long, ValorTotal string, Extra string")
    for money in ("string", "decimal(18,2)", "double"):
        path = f"{tmp_path}/{money[:3]}"
        typed.selectExpr("Comprobante", "cast(Cantidad as int) Cantidad", "5L AS CodigoGenerico", f"cast(ValorTotal AS {money}) ValorTotal", "Extra").write.parquet(path)
        found = landing.ingest_ledger(spark, path)
        assert rows_of(found.selectExpr("Comprobante", "Cantidad", "cast(ValorTotal AS double) v", "Extra")) == [("DC", 6, 8.25, "y"), ("RMC", 5, 7.5, "x")]
        assert found.where("CodigoGenerico IS NULL").count() == 0


def test_a_file_damaged_inside_is_an_error_or_left_out_whole(spark, tmp_path):
    spark.range(50000).selectExpr("cast(uuid() AS string) Comprobante", "id AS Cantidad").coalesce(1).write.parquet(f"{tmp_path}/x")
    spark.createDataFrame([("RMC", 5)], "Comprobante string, Cantidad bigint").coalesce(1).write.parquet(f"{tmp_path}/y")
    folder = tmp_path / "in"
    folder.mkdir()
    bad = bytearray(next((tmp_path / "x").glob("*.parquet")).read_bytes())
    bad[len(bad) // 4 : len(bad) // 2] = b"\0" * (len(bad) // 2 - len(bad) // 4)
    (folder / "bad.parquet").write_bytes(bad)
    (folder / "good.parquet").write_bytes(next((tmp_path / "y").glob("*.parquet")).read_bytes())
    with pytest.raises(Exception, match="bad.parquet"):
        landing.ingest_ledger(spark, str(folder)).collect()
    found = landing.ingest_ledger(spark, str(folder), skip_damaged=True)
    assert rows_of(found, "Comprobante", "Cantidad") == [("RMC", 5)]
    assert rows_of(landing.files_without_rows(spark, str(folder), found)) == [("bad.parquet",)]


def test_extracts_must_all_exist_and_billing_is_renamed(spark, tmp_path):
    paths = {}
    for role, ddl in (("billing", schemas.BILLING_DDL), ("out", schemas.EXTRACT_DDL), ("in", schemas.EXTRACT_DDL), ("listing", schemas.LISTING_DDL)):
        paths[role] = f"{tmp_path}/{role}"
        spark.createDataFrame([], ddl).write.parquet(paths[role])
    frames = landing.ingest_extracts(spark, paths)
    assert {"billed_qty", "billed_name", "billed_value"} <= set(frames["billing"].columns)
    assert "cantidad" not in frames["billing"].columns
    with pytest.raises(FileNotFoundError):
        landing.ingest_extracts(spark, {**paths, "in": f"{tmp_path}/none"})
    with pytest.raises(KeyError):
        landing.ingest_extracts(spark, {"out": paths["out"]})


def test_csv_extracts_follow_their_header(spark, tmp_path):
    put(tmp_path, "listing.csv", "Nombre,Codigo,EstadoArticulo,CodigoGenerico\nItem,1001,ACTIVO,1\n")
    put(tmp_path, "out.csv", "Cantidad,Comprobante\n4,X\n")
    put(tmp_path, "billing.csv", "idadmision,cantidad,nombre\n7,2,n\n")
    paths = {r: f"{tmp_path}/{f}.csv" for r, f in (("billing", "billing"), ("out", "out"), ("in", "out"), ("listing", "listing"))}
    frames = landing.ingest_extracts(spark, paths, "csv")
    assert rows_of(frames["listing"]) == [("1001", "Item", "1", "ACTIVO")]
    assert rows_of(frames["out"], "Comprobante", "Cantidad") == [("X", 4)]
    assert rows_of(frames["billing"], "idadmision", "billed_qty", "billed_name") == [(7, 2, "n")]


def test_entity_names_keep_their_blanks(spark, tmp_path):
    spark.createDataFrame([("CLINICA  UNO ",)], "entidad string").write.parquet(f"{tmp_path}/e")
    assert landing.read_entities(spark, f"{tmp_path}/e").first()[0] == "CLINICA  UNO "


def test_periods(spark):
    df = spark.createDataFrame([("1/9/2026",), (" 01-09-2026 ",), ("31-12-2025",)], "p string")
    assert [tuple(r) for r in df.select(landing.normalize_period("p"), landing.period_month("p")).collect()] == [
        ("01/09/2026", "09"), ("01/09/2026", "09"), ("31/12/2025", "12")
    ]
    for bad in ("1/9", "31/02/2026", "2026"):
        with pytest.raises(Exception):
            spark.createDataFrame([(bad,)], "p string").select(landing.normalize_period("p")).collect()


def test_reports_are_written_one_dataset_per_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "b"), (None, "a"), (3, "c")], "`Cantidad Registros` bigint, `ADM-CodGen` string")
    path = sinks.report_path(str(tmp_path), "compras", "01/02/2024", "28/02/2024")
    assert path.endswith("compras/period=01-02-2024_28-02-2024")
    order = {"x" * 40: [F.col("Cantidad Registros").desc_nulls_first()]}
    written = sinks.write_report({"x" * 40: df, "empty": df.limit(0)}, path, orders=order)
    assert written["x" * 40].endswith("/" + "x" * 40)
    assert rows_of(spark.read.parquet(written["x" * 40])) == [(None, "a"), (1, "b"), (3, "c")]
    empty = spark.read.parquet(written["empty"])
    assert empty.count() == 0 and empty.dtypes == df.dtypes
    longer = sinks.write_report({"x" * 40: df, "x" * 41: df.limit(0)}, path)
    assert spark.read.parquet(longer["x" * 40]).count() == 3 and spark.read.parquet(longer["x" * 41]).count() == 0


def test_sorted_csv_report(spark, tmp_path):
    df = spark.createDataFrame([(1, "b"), (None, "a"), (3, "c")], "n bigint, t string")
    path = sinks.write_table(df, f"{tmp_path}/t", "csv", [F.col("n").desc_nulls_first()])
    parts = [p.read_text().splitlines() for p in sorted((tmp_path / "t").glob("part-*"))]
    assert path == f"{tmp_path}/t" and [line for lines in parts for line in lines if line != "n,t"] == [",a", "3,c", "1,b"]


def parquet_files(spark, folder, frames):
    """One file per frame in a folder."""
    folder.mkdir()
    for name, df in frames.items():
        df.coalesce(1).write.parquet(f"{folder}-{name}")
        file = next((folder.parent / f"{folder.name}-{name}").glob("*.parquet"))
        (folder / f"{name}.parquet").write_bytes(file.read_bytes())


def test_files_of_differing_types_are_united(spark, tmp_path):
    frames = {
        "a": spark.createDataFrame([(1, "RMC", 5), (2, "RMC", 6)], "CodigoGenerico long, Comprobante string, Cantidad int"),
        "b": spark.createDataFrame([("003", 7.0), ("x4", 8.0)], "CodigoGenerico string, Cantidad double"),
        "c": spark.sql("SELECT DATE'2024-01-02' AS Extra, 9L AS Cantidad UNION ALL SELECT NULL, 10"),
        "d": spark.sql("SELECT TIMESTAMP'2024-01-02 03:00:00' AS Extra, '11' AS Cantidad, 1.5BD AS Otro"),
    }
    parquet_files(spark, tmp_path / "in", frames)
    found = landing.ingest_ledger(spark, str(tmp_path / "in"))
    assert rows_of(found, "CodigoGenerico", "Comprobante", "Cantidad", "ArchivoOrigen") == sorted(
        [
            ("1", "RMC", 5, "a.parquet"), ("2", "RMC", 6, "a.parquet"), ("003", None, 7, "b.parquet"), ("x4", None, 8, "b.parquet"),
            (None, None, 9, "c.parquet"), (None, None, 10, "c.parquet"), (None, None, 11, "d.parquet"),
        ], key=lambda r: [(v is not None, str(v)) for v in r],
    )
    kinds = dict(found.dtypes)
    assert kinds["Extra"] == "timestamp" and kinds["Otro"] == "decimal(2,1)" and kinds["CodigoGenerico"] == "string"


@pytest.mark.parametrize(
    "a, b, common",
    [
        ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("decimal(10,2)", "bigint", "decimal(21,2)"),
        ("decimal(30,2)", "decimal(30,20)", "string"), ("boolean", "int", "int"), ("date", "timestamp", "timestamp"),
        ("date", "int", "string"), ("void", "date", "date"), ("array<int>", "array<double>", "array<double>"),
        ("float", "decimal(5,1)", "double"), ("string", "bigint", "string"), ("struct<a:int>", "struct<b:int>", "string"),
    ],
)
def test_common_types(a, b, common):
    x, y = (T.StructType.fromDDL(f"c {t}")[0].dataType for t in (a, b))
    assert files.common_type(x, y).simpleString() == files.common_type(y, x).simpleString() == common


def extract_paths(tmp_path, billing):
    put(tmp_path, "listing.csv", "Nombre,Codigo,EstadoArticulo,CodigoGenerico\nItem,1001,ACTIVO,1\n")
    put(tmp_path, "out.csv", "Cantidad,Comprobante\n4,X\n")
    put(tmp_path, "billing.csv", billing)
    return {r: f"{tmp_path}/{f}.csv" for r, f in (("billing", "billing"), ("out", "out"), ("in", "out"), ("listing", "listing"))}


def test_unreadable_numbers_and_lines_of_another_width_are_never_0(spark, tmp_path):
    billing = 'nombre,idadmision,cantidad,vrtotal\n\nn,1,2,3.5\nn,2,abc,"1.234,50"\nART, GRANDE,3,4,5\n"ART, GRANDE",4,,6\nshort,5\nn,,7, \n'
    paths = extract_paths(tmp_path, billing)
    with pytest.raises(Exception, match=r"billing.csv, line [45]"):
        landing.ingest_extracts(spark, paths, "csv")["billing"].collect()
    assert rows_of(landing.ingest_extracts(spark, paths, "csv")["out"], "Cantidad") == [(4,)]
    accepted, rejected = landing.split_extracts(spark, paths, "csv")
    assert rows_of(accepted["billing"], "billed_name", "idadmision", "billed_qty", "billed_value") == [
        ("ART, GRANDE", 4, None, 6.0), ("n", None, 7, None), ("n", 1, 2, 3.5)
    ]
    assert rows_of(rejected, "role", "file", "line", "column", "text", "reason") == [
        ("billing", "billing.csv", 4, "cantidad", "abc", "no bigint"),
        ("billing", "billing.csv", 4, "vrtotal", "1.234,50", "no double"),
        ("billing", "billing.csv", 5, None, "ART, GRANDE,3,4,5", "line of another width"),
        ("billing", "billing.csv", 7, None, "short,5", "line of another width"),
    ]
    assert accepted["billing"].count() + rejected.select("line").distinct().count() == 6


def test_lenient_values_are_listed_and_kept(spark, tmp_path):
    put(tmp_path, "a.csv", "Comprobante,Cantidad,Costo\nRMC,x,1\nRMC,2,2\n")
    landed = landing.ledger_landing(spark, str(tmp_path), "csv")
    assert rows_of(landed.rejected()) == [("a.csv", 2, "Cantidad", "x", "no bigint", True)]
    assert landed.accepted().count() == landed.strict().count() == 2
    put(tmp_path, "b.csv", "Comprobante,Costo\nRMC,y\n")
    with pytest.raises(Exception, match="b.csv, line 2: Costo 'y'"):
        landing.ingest_ledger(spark, str(tmp_path), "csv").collect()


def test_rejects_of_typed_files_name_their_row(spark, tmp_path):
    df = spark.range(5).selectExpr("cast(id AS string) idadmision", "if(id = 3, 'many', '1') cantidad", "current_date() vrtotal")
    df.coalesce(1).write.parquet(f"{tmp_path}/b")
    landed = landing.read_landed(spark, f"{tmp_path}/b", "parquet", T.StructType.fromDDL(schemas.BILLING_DDL))
    assert rows_of(landed.rejected().where("column = 'cantidad'"), "line", "text") == [(4, "many")]
    assert landed.rejected().where("column = 'vrtotal'").count() == 5 and landed.accepted().count() == 0


def test_line_numbers_hold_over_parts_of_a_file(spark, tmp_path):
    lines = [f"RMC,{i}" if i % 97 else f"RMC,bad{i}" for i in range(2, 4000)]
    put(tmp_path, "long.csv", "\n".join(["Comprobante,Costo", *lines]) + "\n")
    put(tmp_path, "other.csv", "Costo\n1\nbad\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        landed = landing.ledger_landing(spark, str(tmp_path), "csv")
        got = sorted(rows_of(landed.rejected(), "file", "line", "text"))
        assert got == [*[("long.csv", i, f"bad{i}") for i in range(2, 4000) if i % 97 == 0], ("other.csv", 3, "bad")]
        assert landed.accepted().count() == 3998 + 2 - len(got)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_all_files_are_looked_at_in_one_job(spark, tmp_path):
    frames = {"a": spark.range(7).selectExpr("'RMC' AS Comprobante", "id AS Cantidad"), "b": spark.range(2).selectExpr("'DC' AS Comprobante")}
    parquet_files(spark, tmp_path / "in", frames)
    a, b = ((tmp_path / "in" / f"{x}.parquet").read_bytes() for x in "ab")
    for i in range(300):
        (tmp_path / "in" / f"{i:03}.parquet").write_bytes(a if i % 2 else b)
    (tmp_path / "in" / "cut.parquet").write_bytes(a[: len(a) // 2])
    group = "look"
    spark.sparkContext.setJobGroup(group, group)
    looked = rows_of(files.inspect_files(spark, str(tmp_path / "in"), "parquet"), "path", "promised", "rows", "damage")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 1
    assert len(looked) == 303 and sum(r[2] for r in looked) == 151 * 9
    assert [r[0].rsplit("/", 1)[1] for r in looked if r[3]] == ["cut.parquet"]
    found = landing.ingest_ledger(spark, str(tmp_path / "in"), skip_damaged=True)
    assert found.count() == 151 * 9 and found.where("Cantidad IS NOT NULL").count() == 151 * 7


def test_orc_and_json_folders(spark, tmp_path):
    df = spark.createDataFrame([("RMC", "5"), ("DC", "x")], "Comprobante string, Cantidad string")
    df.write.orc(f"{tmp_path}/o")
    df.selectExpr("Comprobante", "7L AS Cantidad").write.mode("append").orc(f"{tmp_path}/o")
    want = [("DC", None), ("DC", 7), ("RMC", 5), ("RMC", 7)]
    assert rows_of(landing.ingest_ledger(spark, f"{tmp_path}/o", "orc"), "Comprobante", "Cantidad") == want
    put(tmp_path, "l.json", '{"Comprobante": "RMC", "Cantidad": 5}\n{"Comprobante": \n')
    landed = landing.ledger_landing(spark, f"{tmp_path}/l.json", "json")
    assert rows_of(landed.accepted(), "Comprobante", "Cantidad") == [("RMC", 5)]
    assert [r.reason for r in landed.rejected().collect()] == ["line of another width"]


def test_lines_are_parsed_once_however_often_they_are_read(spark, tmp_path):
    """Header names no table could have, blank lines before and after the header, and nothing left to parse or shuffle."""
    put(tmp_path, "a.csv", "\n  \nat,path,a b;(c)=\n1,x,2\n\n3,y\n")
    put(tmp_path, "b.csv", "block,at\n5,6\n")
    put(tmp_path, "empty.csv", "\n\n")
    records = files.numbered_records(spark, str(tmp_path), {})
    assert records.columns == ["at", "path", "a b;(c)=", "block", files.FILE, files.LINE, files.RECORD]
    assert rows_of(records) == [
        ("1", "x", "2", None, "a.csv", 4, None), ("3", "y", None, None, "a.csv", 6, "3,y"), ("6", None, None, "5", "b.csv", 2, None)
    ]
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "from_csv" not in plan and "SortMergeJoin" not in plan
