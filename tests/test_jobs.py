"""Stored-table jobs, declared-schema reads, pushdown and pruning."""

from pyspark.sql import functions as F

from supplyscope.operators import history as H
from supplyscope.plans import jobs as J
from supplyscope.plans.catalog import _poll
from supplyscope.plans.forecast_jobs import fleet_forecast_ema
from supplyscope.plans.refresh import refresh_inventory
from supplyscope.session import scratch_path
from supplyscope.sources import fixtures as X
from supplyscope.sources import tables as T

from .conftest import SF_SMALL


def _sorted(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_refresh_job_end_to_end(spark):
    inv_path, poll_path, out_path, log_path = (scratch_path(spark, n) for n in ("inv", "poll", "out", "log"))
    inv = X.inventory_raw(spark, SF_SMALL)
    T.write_class_tables(inv, inv_path)
    poll = _poll(spark, SF_SMALL)
    poll.write.parquet(poll_path)
    n = J.refresh_job(spark, inv_path, poll_path, out_path, log_path)
    want = refresh_inventory(inv, poll)
    got = T.read_class_tables(spark, out_path)
    cols = ["device_id", "device_class", "ip", "toner_negro", "estado", "marca_de_tiempo"]
    assert _sorted(got, cols) == _sorted(want, cols)
    assert n == inv.count() == spark.read.parquet(log_path).count()


def test_refresh_job_one_class_keeps_others(spark):
    inv_path, poll_path, out_path = (scratch_path(spark, n) for n in ("inv1", "poll1", "out1"))
    inv = X.inventory_raw(spark, SF_SMALL)
    T.write_class_tables(inv, inv_path)
    T.write_class_tables(inv, out_path)
    _poll(spark, SF_SMALL).write.parquet(poll_path)
    J.refresh_job(spark, inv_path, poll_path, out_path, classes=["HP Planta"])
    got = T.read_class_tables(spark, out_path)
    assert got.count() == inv.count()
    untouched = got.filter(F.col("device_class") != "HP Planta")
    assert _sorted(untouched, ["device_id", "ip", "estado"]) == _sorted(
        inv.filter(F.col("device_class") != "HP Planta"), ["device_id", "ip", "estado"])


def test_forecast_job_from_stored_log(spark):
    log_path, out_path = scratch_path(spark, "hlog"), scratch_path(spark, "fc")
    raw = X.history_raw(spark, SF_SMALL)
    raw.write.parquet(log_path)
    J.forecast_job(spark, log_path, out_path)
    cols = ["ip", "modelo", "consumible", "porcentaje_actual", "consumo_diario", "metodo", "alerta"]
    assert _sorted(spark.read.parquet(out_path), cols) == _sorted(fleet_forecast_ema(raw), cols)


def test_declared_schema_read_fills_missing_columns(spark):
    path = scratch_path(spark, "old-log")
    spark.createDataFrame([(1, "a", "1.1.1.1", "OK", "2024-01-01 00:00:00")],
                          "seq long, nombre string, ip string, estado string, marca_de_tiempo string").write.parquet(path)
    df = T.read_history(spark, path)
    assert df.columns == [f.name for f in T.HISTORY_SCHEMA.fields]
    assert df.first()["toner_negro"] is None


def test_status_filter_and_projection_reach_the_scan(spark):
    path = scratch_path(spark, "log-pushdown")
    X.history_raw(spark, SF_SMALL).write.parquet(path)
    q = H.filter_status(T.read_history(spark, path), strip=False).select("ip", "toner_negro")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(estado), EqualTo(estado,OK)]" in plan
    assert "ReadSchema: struct<ip:string,toner_negro:string,estado:string>" in plan


def test_overwrite_refuses_same_path(spark):
    import pytest
    p = scratch_path(spark, "same")
    with pytest.raises(ValueError):
        J.forecast_job(spark, p, p)


def test_read_sheet_export_and_refresh(spark):
    import os

    from supplyscope.session import scratch_path as sp

    d = sp(spark, "sheet").replace("file:", "")
    path = os.path.join(d, "hp_admin.csv")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(" Nombre ,IP, Modelo ,Toner Negro,Kit Mant.,Kit Alim.,Estado,Marca de Tiempo\n")
        fh.write("Lobby,192.168.111.210,M1,85%,,0.5,OK,2024-01-01 00:00:00\n")
        fh.write("Store,  ,M2,007,40%,,Fuera de Red,\n")
    sheet = T.read_sheet(spark, path, device_class="HP Admin")
    assert sheet.columns == ["nombre", "ip", "modelo", "toner_negro", "kit_mant", "kit_alim", "estado",
                             "marca_de_tiempo", "device_class"]
    assert {f.dataType.simpleString() for f in sheet.schema.fields} == {"string"}
    rows = {r.nombre: r for r in sheet.collect()}
    assert rows["Store"].toner_negro == "007" and rows["Lobby"].kit_alim == "0.5"
    poll = spark.createDataFrame([("HP Admin", "192.168.111.210", 1, "12.5 %", "", "", "OK", "t1")],
                                 "device_class string, ip string, seq long, toner_negro string, kit_mant string, "
                                 "kit_alim string, estado string, marca_de_tiempo string")
    out = {r.nombre: r for r in refresh_inventory(sheet, poll).collect()}
    assert (out["Lobby"].toner_negro, out["Lobby"].kit_mant, out["Lobby"].estado) == ("12%", "", "OK")
    assert out["Store"].ip is None and out["Store"].toner_negro == "007"


def test_log_days_and_unique_sequence(spark):
    from supplyscope.plans.jobs import with_display_names
    from supplyscope.sources import tables as T

    path = scratch_path(spark, "t-days")
    rows = [("a", "2024-01-01 00:00:00"), ("b", "2024-01-02 10:00:00"), ("c", "no time at all"), ("d", None)]
    assert T.append_log(spark.createDataFrame(rows, "ip string, marca_de_tiempo string"), path) == 4
    got = {r.ip: str(r.fecha_dia) for r in spark.read.parquet(path).collect()}
    assert got == {"a": "2024-01-01", "b": "2024-01-02", "c": "None", "d": "None"}
    shown = with_display_names(spark.createDataFrame([("n", "i", 1.5)], "nombre string, ip string, dias_restantes double"))
    assert shown.columns == ["Nombre", "IP", "Días restantes estimados"]
