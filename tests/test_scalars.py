"""Golden micro-cases for the scalar functions (hand-computed)."""

import pytest
from pyspark.sql import functions as F

from supplyscope import config as K
from supplyscope.functions import bands, scalars as S


def col_of(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_format_ip_current(spark):
    cases = {
        None: None, "": None, "  ": None,
        "192.168.111.210": "192.168.111.210",
        "192.168.20.11": "192.168.20.11",
        "192.168.20.6": "192.168.20.6",
        "192.168.1.50": "192.168.15.0",
        "192.168.1.1": "192.168.11",
        "10.0.0.1": "10001",
        "192168111210": "192.168.111.210",
        "1921681112101": "1921681112101",
        "no digits": "",
    }
    got = col_of(spark, list(cases), lambda c: S.format_ip(c))
    assert got == list(cases.values())


def test_format_ip_variants(spark):
    vals = [None, "19216811", "1921681", "192.168.1.50"]
    dots = col_of(spark, vals, lambda c: S.format_ip(c, "dots"))
    assert dots == [None, "192.168.11..", "192.168.1.", "192.168.15.0"]
    v6 = col_of(spark, vals, lambda c: S.format_ip(c, "dots", null_check=False))
    assert v6 == ["", "192.168.11..", "192.168.1.", "192.168.15.0"]
    zero = col_of(spark, vals, lambda c: S.format_ip(c, "zero"))
    assert zero == [None, "192.168.11.0", "192.168.1.0", "192.168.15.0"]


def test_ip_to_url(spark):
    assert col_of(spark, [None, "", "1.2.3.4"], S.ip_to_url) == [None, None, "http://1.2.3.4"]


CLEAN_IN = ["85%", "85 %", " 85", "2.5%", "3.5%", "", "--", None, "<1%", "-5%", "5d", "nan", "inf", "-0.4%",
            "1e3", "\t7 %\n"]


def test_clean_pct_blank_and_zero(spark):
    blank = col_of(spark, CLEAN_IN, lambda c: S.clean_pct(c, ""))
    assert blank == ["85%", "85%", "85%", "2%", "4%", "", "", "", "", "-5%", "", "", "", "0%", "1000%", "7%"]
    zero = col_of(spark, CLEAN_IN, lambda c: S.clean_pct(c, "0%"))
    assert zero == ["85%", "85%", "85%", "2%", "4%", "0%", "0%", "0%", "0%", "-5%", "0%", "0%", "0%", "0%",
                    "1000%", "7%"]


def test_clean_pct_float_and_pct_to_double(spark):
    assert col_of(spark, ["85%", "2.5 %", "", "x", None, "nan"], S.clean_pct_float) == [85.0, 2.5, None, None,
                                                                                        None, None]
    assert col_of(spark, ["85%", "", "--", "1e999"], S.pct_to_double) == [85.0, None, None, None]


def test_fraction_to_pct(spark):
    vals = [None, "0.85", "0,85", "0.29", "85%", "85", "", "x", "-0.001"]
    assert col_of(spark, vals, S.fraction_to_pct) == ["", "85%", "85%", "28%", "85%", "8500%", "", "x", "0%"]


def test_parse_ts(spark):
    import datetime as dt
    got = col_of(spark, ["2024-01-02 03:04:05", "not a date", None], S.parse_ts)
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None]


def test_round_to_half_even(spark):
    df = spark.createDataFrame([(0.25,), (0.35,), (2.5,), (3.5,)], "x double")
    import numpy as np

    xs = [0.25, 0.35, 2.5, 3.5]
    got = [r[0] for r in df.select(S.round_to("x", 1)).collect()]
    assert got == [float(np.round(x, 1)) for x in xs]
    got0 = [r[0] for r in df.select(S.round_to("x", 0)).collect()]
    assert got0 == [0.0, 0.0, 2.0, 4.0]


def test_severity(spark):
    vals = ["0%", "0", " 0% ", "10%", "11%", "10.9%", "-5%", "x%", "OK", None]
    got = col_of(spark, vals, lambda c: bands.severity(c))
    assert got == ["critical", "critical", "critical", "low", None, "low", "low", None, None, None]
    got5 = col_of(spark, ["4%", "5%"], lambda c: bands.severity(c, 5))
    assert got5 == ["low", None]


def test_alert_bands(spark):
    vals = [None, 3.0, 3.1, 7.0, 7.1, 15.0, 15.1, 0.0]
    got = col_of(spark, vals, bands.alert_band, "double")
    assert got == [K.ALERT_INSUFFICIENT, K.ALERT_URGENT, K.ALERT_SOON, K.ALERT_SOON, K.ALERT_LOW_STOCK,
                   K.ALERT_LOW_STOCK, K.ALERT_OK, K.ALERT_URGENT]
    got2 = col_of(spark, vals, bands.alert_band2, "double")
    assert got2 == ["OK", K.ALERT2_SOON, "OK", "OK", "OK", "OK", "OK", K.ALERT2_SOON]


@pytest.mark.parametrize("variant,expected", [
    ("v13", ["", "OK", "No disponible", "No Disponible", "No Disponible", "Fuera de Red"]),
    ("v7", ["", "OK", "OK", "Error", "No Disponible", "Fuera de Red"]),
    ("v10", ["", "OK", "OK", "OK", "Fuera de Red", "Fuera de Red"]),
    ("v11_copy", ["", "OK", "No Disponible", "No Disponible", "No Disponible", "Fuera de Red"]),
])
def test_classify_status(spark, variant, expected):
    df = spark.createDataFrame(
        [(0, "no_key", False, False), (1, "ok", True, False), (2, "ok", False, True),
         (3, "element_missing", False, True), (4, "timeout", False, False), (5, "driver_error", False, False)],
        "i int, o string, rule boolean, zero boolean")
    got = [r[0] for r in df.orderBy("i").select(
        bands.classify_status("o", F.col("rule"), F.col("zero"), variant)).collect()]
    assert got == expected


def test_level_severity_matches_cleaned_text(spark):
    vals = [0.4, -0.4, 0.5, 1.5, 10.4, 10.5, 11.0, -3.0, None]
    got = col_of(spark, vals, bands.level_severity, "double")
    via_text = col_of(spark, vals, lambda c: bands.severity(S.clean_pct(c.cast("string"), "x")), "double")
    assert got == via_text == ["critical", "critical", "critical", "low", "low", "low", None, "low", None]


def test_normalize_ip_keeps_valid_quads(spark):
    vals = [" 192.168.1.50 ", "192.168.1.1", "192.168.001.050", "10.0.0.256", "192168111210", None, "  "]
    got = col_of(spark, vals, S.normalize_ip)
    assert got == ["192.168.1.50", "192.168.1.1", "192.168.001.050", "100.025.6", "192.168.111.210", None, None]
