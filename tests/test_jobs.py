"""Both jobs end to end on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from row_values import rows_of
from stockledger.functions.distributed import Scratch, materialize, shared_folder
from stockledger.operators import cube, ledger, report
from stockledger.plans import jobs
from stockledger.schemas import BILLING_NAMES
from stockledger.sources import demo, sinks

SMALL = "/root/testdata/sf0.001"


def test_inventory_job(spark, tmp_path):
    status = jobs.run_inventory_job(demo.ledger_lines(spark, SMALL), str(tmp_path), "2024-01-31")
    assert status["exitoso"] and status["error"] is None
    assert list(status["pasos"]) == ["clasificacion", "compras", "prestamos", "movimientos", "consumos_mensuales", "cubo"]
    paths = [p for step in status["pasos"].values() for k, p in step.items() if k != "registros"]
    assert len(paths) == 7 + 4 + 2 + 2 + 5 + 1
    for path in paths:
        assert spark.read.parquet(path).columns
    shares = spark.read.parquet(status["pasos"]["consumos_mensuales"]["Clasificacion_ABC_Pareto"])
    assert shares.agg({"Porcentaje_Acumulado": "max"}).first()[0] >= 1.0
    counts = status["pasos"]["clasificacion"]["registros"]
    lines = demo.ledger_lines(spark, SMALL).where("Estado = 'CONFIRMADO'").count()
    assert sum(counts.values()) == lines and counts["pendientes"] > 0


def written_tables(spark):
    """Tables that nobody has deleted from the shared folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    return {f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)}


def test_consumption_job(spark, tmp_path):
    before = written_tables(spark)
    extract = demo.movement_extract(spark, SMALL)
    extracts = {
        "out": extract, "in": extract, "billing": demo.billing_lines(spark, SMALL), "listing": demo.listing(spark, SMALL)
    }
    status = jobs.run_consumption_job(
        extracts, demo.entities(spark, SMALL), str(tmp_path), "01/01/2024", "31/01/2024", demo.FINE_MONEY, with_finance=True
    )
    assert status["exitoso"], status["error"]
    steps = status["pasos"]
    assert set(steps["informe"]) == set(report.TABLES)
    assert len(steps["analisis_financiero"]) == 9
    for path in (*steps["informe"].values(), *steps["analisis_financiero"].values(), steps["rentabilidad"]["rentabilidad"]):
        assert spark.read.parquet(path).columns
    assert "conciliacion_exitosa" in steps["conciliacion"]
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    assert before == written_tables(spark)


def test_a_failing_step_ends_the_job(spark, tmp_path):
    bad = demo.ledger_lines(spark, SMALL).drop("Tercero").withColumnRenamed("Bodega", "Tercero")
    with pytest.raises(Exception):
        jobs.run_inventory_job(bad.drop("Estado"), str(tmp_path), "2024-01-31")
    ran = []

    def fail():
        raise RuntimeError("broken")

    status = jobs._run([("one", lambda: ran.append(1) or {}), ("two", fail), ("three", lambda: ran.append(3) or {})])
    assert ran == [1] and not status["exitoso"] and status["error"] == "two: broken"


def test_jobs_from_landed_files(spark, tmp_path):
    ledger_dir = f"{tmp_path}/ledger"
    demo.ledger_lines(spark, SMALL).write.parquet(ledger_dir)  # numbers as codes, decimals as money
    status = jobs.run_inventory_from_folder(spark, ledger_dir, f"{tmp_path}/out", "2024-01-31")
    assert status["exitoso"], status["error"]
    assert list(status["pasos"])[:2] == ["consolidacion", "clasificacion"]
    moved = spark.read.parquet(status["pasos"]["movimientos"]["Movimiento_agrupado"])
    direct = jobs.movement_tables(ledger.classified_ledger(demo.ledger_lines(spark, SMALL), "decimal(18,2)"))
    assert moved.count() == direct["Movimiento_agrupado"].count()

    empty = jobs.run_inventory_from_folder(spark, f"{tmp_path}/none", f"{tmp_path}/out2", "2024-01-31")
    assert not empty["exitoso"] and "no ledger lines" in empty["error"]
    assert not (tmp_path / "out2").exists()
    demo.ledger_lines(spark, SMALL).withColumnRenamed("Estado", "Estdo").write.parquet(f"{tmp_path}/misnamed")
    misnamed = jobs.run_inventory_from_folder(spark, f"{tmp_path}/misnamed", f"{tmp_path}/out2", "2024-01-31")
    assert not misnamed["exitoso"] and "Estado" in misnamed["error"] and not (tmp_path / "out2").exists()
    missing = jobs.run_consumption_from_files(spark, {"out": "x"}, "e", f"{tmp_path}/out3", "1", "2")
    assert not missing["exitoso"] and "no path given" in missing["error"]


def test_consumption_job_from_landed_files(spark, tmp_path):
    names = {new: old for old, new in BILLING_NAMES.items()}
    doubles = ["ValorUnitario", "TotalBruto", "ValorIVA", "ValorDescuento", "ValorTotal", "vrunitario", "vrtotal"]
    landed = {
        "out": demo.movement_extract(spark, SMALL),
        "in": demo.movement_extract(spark, SMALL),
        "billing": demo.billing_lines(spark, SMALL).withColumnsRenamed(names),
        "listing": demo.listing(spark, SMALL),
    }
    paths = {}
    for role, df in landed.items():
        paths[role] = f"{tmp_path}/{role}"
        df.withColumns({c: F.col(c).cast("double") for c in doubles if c in df.columns}).write.parquet(paths[role])
    demo.entities(spark, SMALL).write.parquet(f"{tmp_path}/entities")
    status = jobs.run_consumption_from_files(
        spark, paths, f"{tmp_path}/entities", f"{tmp_path}/out", "01/01/2024", "31/01/2024"
    )
    assert status["exitoso"], status["error"]
    lame = demo.movement_extract(spark, SMALL).drop("NoDocumento")
    lame.write.parquet(f"{tmp_path}/lame")
    refused = jobs.run_consumption_from_files(
        spark, {**paths, "out": f"{tmp_path}/lame"}, f"{tmp_path}/entities", f"{tmp_path}/out4", "01/01/2024", "31/01/2024"
    )
    assert not refused["exitoso"] and "NoDocumento" in refused["error"]
    assert list(status["pasos"])[0] == "lectura" and status["pasos"]["carga"]["totales"]["billed"]["filas"] > 0


def test_two_periods_of_the_cube_equal_the_whole_run(spark):
    lines = ledger.classified_ledger(demo.ledger_lines(spark, SMALL), "decimal(18,2)")
    lines = lines.unionAll(lines.where("Cantidad > 20"))
    early = F.col("Fecha") < "1995-06-17"
    periods = [materialize(cube.ledger_cube(lines.where(c))) for c in (early, ~early)]
    both = materialize(cube.merge_cubes(*periods))
    assert both.dtypes == cube.ledger_cube(lines).dtypes
    assert both.count() < lines.count() and both.agg(F.sum("registros")).first()[0] == lines.count()
    assert rows_of(ledger.family_counts(both)) == rows_of(ledger.family_counts(lines))
    assert rows_of(ledger.unclassified_count(both)) == rows_of(ledger.unclassified_count(lines))
    families = [jobs.purchase_tables, jobs.loan_tables, jobs.movement_tables, jobs.monthly_tables]
    families.append(lambda x: {f: ledger.net_by_voucher(x, f) for f in ("lent", "transfers")})
    for tables in families:
        whole, merged = tables(lines), tables(both)
        for name in whole:
            plain = [F.col(f"`{c}`").cast("string") if t.startswith("decimal") else F.col(f"`{c}`") for c, t in whole[name].dtypes]
            assert rows_of(whole[name].select(plain)) == rows_of(merged[name].select(plain)), name


def test_what_is_published_stays_whole_when_a_step_fails(spark, tmp_path, monkeypatch):
    raw, out = demo.ledger_lines(spark, SMALL), str(tmp_path)
    first = jobs.run_inventory_job(raw, out, "2024-01-31")
    assert first["exitoso"]
    shown = rows_of(sinks.published(spark, out).select("period", "report", "name", "run"))
    assert len(shown) == 21 and {r[3] for r in shown} == {first["corrida"]}

    def fail(lines):
        raise RuntimeError("broken")

    with monkeypatch.context() as m:
        m.setattr(jobs, "movement_tables", fail)
        failed = jobs.run_inventory_job(raw.limit(10), out, "2024-01-31")
    assert not failed["exitoso"] and failed["error"] == "movimientos: broken" and "compras" in failed["pasos"]
    assert rows_of(sinks.published(spark, out).select("period", "report", "name", "run")) == shown
    kept = sinks.read_published(spark, out, "2024-01-31", "movimientos", "Movimiento_agrupado")
    assert kept.count() == spark.read.parquet(first["pasos"]["movimientos"]["Movimiento_agrupado"]).count() > 0
    with pytest.raises(KeyError):
        sinks.read_published(spark, out, "2024-02-29", "movimientos", "Movimiento_agrupado")

    cube_path = first["pasos"]["cubo"]["cubo"]
    again = jobs.run_inventory_job(raw, out, "2024-01-31", earlier=[spark.read.parquet(cube_path)])
    assert again["exitoso"] and {r.run for r in sinks.published(spark, out).collect()} == {again["corrida"]}
    double = {k: 2 * v for k, v in first["pasos"]["clasificacion"]["registros"].items()}
    assert again["pasos"]["clasificacion"]["registros"] == double


def test_scratch_deletes_what_was_written_in_it(spark):
    before = written_tables(spark)
    kept = materialize(spark.range(3))
    with Scratch(spark):
        assert materialize(spark.range(5)).count() == 5
        assert len(written_tables(spark) - before) == 2
    assert len(written_tables(spark) - before) == 1 and kept.count() == 3
