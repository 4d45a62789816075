"""Gauge extraction micro-cases and table sinks."""

import os

import pytest

from supplyscope import config as K
from supplyscope.session import scratch_path
from supplyscope.sources import pages as G
from supplyscope.sources import tables as T

PAGE = "page_id long, url string, html string, device_class string"


def test_supply_gauge_ids_in_any_order(spark):
    html = ('<div id="SupplyName0">Black</div><span id="SupplyGauge1" class="g"> 40% </span>'
            '<span id="SupplyGauge0">85%</span><span id="SupplyGauge2">--</span>')
    df = spark.createDataFrame([(1, "u", html, "HP Admin")], PAGE)
    got = [(r.gauge_ix, r.text) for r in G.extract_gauges(df, "supply_gauge").orderBy("gauge_ix").collect()]
    assert got == [(0, "85%"), (1, "40%"), (2, "--")]
    wide = G.gauges_to_supplies(df, "supply_gauge").first()
    assert (wide.toner_negro, wide.kit_mant, wide.kit_alim, wide.estado) == ("85%", "40%", "--", "OK")


def test_missing_gauge_and_null_page(spark):
    html = '<span id="SupplyGauge0">85%</span>'
    df = spark.createDataFrame([(1, "u", html, "HP Admin"), (2, "u", None, "HP Planta"),
                                (3, "u", '<span id="SupplyGauge0"></span>', "HP Planta"),
                                (4, "u", '<span id="SupplyGauge0">5%</span>', "HP Planta")], PAGE)
    out = {r.page_id: r for r in G.gauges_to_supplies(df, "supply_gauge").collect()}
    assert out[1].outcome == "element_missing" and out[1].estado == K.STATUS_NOT_AVAILABLE
    assert out[1].toner_negro == "" and out[1].toner_cian is None
    assert out[2].outcome == "driver_error" and out[2].estado == K.STATUS_OFFLINE
    assert out[3].estado == K.STATUS_NOT_AVAILABLE_RULE and out[3].toner_negro == ""
    assert out[4].estado == "OK" and out[4].toner_negro == "5%"


def test_toner_list_pattern(spark):
    html = ('<table id="toner_list"><tr><td class="x tonervalue_number">60%</td></tr></table>'
            '<table id="imagine_list"><tr><td class="tonervalue_number">30%</td></tr></table>')
    df = spark.createDataFrame([(1, "u", html, "HP Planta")], PAGE)
    got = [r.text for r in G.extract_gauges(df, "toner_list").orderBy("gauge_ix").collect()]
    assert got == ["60%", "30%"]


def test_gauge_map_df(spark):
    gm = G.gauge_map_df(spark)
    assert gm.count() == sum(len(v) for v in K.GAUGE_MAP.values())


def test_class_tables_dynamic_overwrite_keeps_siblings(spark):
    path = scratch_path(spark, "t-classes")
    inv = spark.createDataFrame([(1, "HP Admin", "a"), (2, "Color Admin", "b")],
                                "device_id long, device_class string, nombre string")
    T.write_class_tables(inv, path)
    T.write_class_tables(spark.createDataFrame([(3, "HP Admin", "c")], inv.schema), path)
    got = sorted((r.device_id, r.device_class) for r in T.read_class_tables(spark, path).collect())
    assert got == [(2, "Color Admin"), (3, "HP Admin")]
    only = T.read_class_tables(spark, path, ["Color Admin"]).collect()
    assert [r.device_id for r in only] == [2]


def test_append_log_counts_rows(spark):
    path = scratch_path(spark, "t-log")
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "2024-01-02 00:00:00")],
                               "ip string, marca_de_tiempo string")
    assert T.append_log(df, path) == 2
    assert T.append_log(df, path) == 2
    assert spark.read.parquet(path).count() == 4


def test_schema_check_names_path(spark):
    path = scratch_path(spark, "t-bad")
    spark.createDataFrame([(1,)], "x long").write.parquet(path)
    with pytest.raises(ValueError, match=os.path.basename(path)):
        T.check_schema(spark.read.parquet(path), ["ip"], path)


def test_grid_pattern(spark):
    html = ('<div class="x-grid3-row"><div class="x-column">Negro</div><div class="x-column">70%</div></div>'
            '<div class="x-grid3-row x-grid3-row-alt"><div class="x-column">Cian</div>'
            '<div class="x-column x-wide">55%</div></div>'
            '<div class="x-grid3-row-table"><div class="x-column">no</div><div class="x-column">row</div></div>')
    df = spark.createDataFrame([(1, "u", html, "Impresora CLX-6260")], PAGE)
    got = [(r.gauge_ix, r.text) for r in G.extract_gauges(df, "grid").orderBy("gauge_ix").collect()]
    assert got == [(0, "70%"), (1, "55%")]


def _nested_row(k, toner, ui, tbody=True):
    inner = "".join(f"<tr><td>x</td><td> {v} </td></tr>" for v in (toner, ui))
    wrap = (lambda x: f"<tbody>{x}</tbody>") if tbody else (lambda x: x)
    return (f'<tr id="{k}"><td>label</td><td><table>{wrap("<tr><td><table>" + wrap(inner) + "</table></td></tr>")}'
            f"</table></td></tr>")


def test_row_id_nested_tables(spark):
    html = "<table>" + _nested_row(1, "80%", "60%") + _nested_row(2, "40%", "30%", tbody=False) + "</table>"
    df = spark.createDataFrame([(1, "u", html, "x"), (2, "u", None, "x")], PAGE)
    got = [(r.page_id, r.gauge_ix, r.text) for r in G.extract_gauges(df, "row_id").orderBy("gauge_ix").collect()]
    assert got == [(1, 0, "80%"), (1, 1, "60%"), (1, 2, "40%"), (1, 3, "30%")]


def test_malformed_html_does_not_fail(spark):
    bad = ['<span id="SupplyGauge0">85%', '<<<>>', '<li><a href="/x">unclosed', '<span id="SupplyGauge0">9%</span']
    df = spark.createDataFrame([(i, "u", h, "HP Planta") for i, h in enumerate(bad)], PAGE)
    out = {r.page_id: (r.outcome, r.toner_negro) for r in G.gauges_to_supplies(df, "supply_gauge").collect()}
    assert out[1] == ("element_missing", "") and out[2] == ("element_missing", "")
    assert out[0] == ("element_missing", "") and out[3] == ("ok", "9%")
    assert G.extract_gauges(df, "row_id").count() == 0


def test_gauges_keep_their_positions(spark):
    rows = [(1, "u", '<table id="imagine_list"><tr><td class="tonervalue_number">30%</td></tr></table>', "Impresoras Normales"),
            (2, "u", "<span id='SupplyGauge2'>7%</span><span id='SupplyGauge0'><b>85%</b></span>", "HP Planta - 2"),
            (3, "u", '<span id="SupplyGauge99999999999">1%</span><span id="SupplyGauge0">5%</span>', "HP Planta"),
            (4, "u", '<span id="SupplyGauge0">5%</span>', "Another class"), (5, "u", "<p>" * 3000, "Impresoras a Color"),
            (6, "u", '<span id="SupplyGauge0">5%</span>', None)]
    df = spark.createDataFrame(rows, PAGE)
    out = {r.page_id: r for r in G.gauges_to_supplies(df).collect()}
    assert (out[1].outcome, out[1].toner_negro, out[1].ui_negro) == ("element_missing", "", "")
    assert (out[2].outcome, out[2].toner_negro, out[2].estado) == ("element_missing", "", K.STATUS_NOT_AVAILABLE)
    assert (out[3].outcome, out[3].toner_negro, out[3].estado) == ("ok", "5%", K.STATUS_OK)
    assert (out[4].outcome, out[4].toner_negro, out[4].estado) == ("unknown_class", None, None)
    assert out[5].outcome == "element_missing" and out[6].outcome == "unknown_class"
    assert [(r.page_id, r.gauge_ix, r.text) for r in G.extract_gauges(df, "toner_list").collect()] == [(1, 1, "30%")]
