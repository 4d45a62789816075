"""Property checks: Spark expressions vs. direct Python implementations of
the original functions on random inputs (one Spark job per generated batch),
idempotence, and independence of input partitioning."""

import math
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from supplyscope.functions import bands, scalars as S
from supplyscope.operators import history as H
from supplyscope.operators.forecast import forecast_ema
from supplyscope.sources import fixtures as X

from .conftest import SF_SMALL

PCT_TEXT = st.one_of(
    st.none(),
    st.text(alphabet="0123456789.%-+ e,x\t", max_size=8),
    st.floats(min_value=-1000, max_value=1000, allow_nan=False).map(lambda v: f"{v}%"),
    st.integers(min_value=-200, max_value=200).map(lambda v: f" {v} %"),
)


def _plain_float(text):
    """float() restricted to plain decimals (what the build accepts)."""
    t = text.strip()
    if not re.fullmatch(r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?", t):
        return None
    v = float(t)
    return v if math.isfinite(v) else None


def py_clean(value, fail):
    if value is None:
        return fail
    v = _plain_float(value.replace("%", ""))
    if v is None:
        return fail
    return f"{int(round(v))}%"


def py_fraction(value):
    if value is None:
        return ""
    v = _plain_float(value.replace(",", "."))
    if v is None:
        return value
    return f"{int(v * 100)}%"


def py_format_ip(ip):
    if ip is None or not ip.strip():
        return None
    d = re.sub(r"[^0-9]", "", ip)
    n = len(d)
    if n in (12, 11):
        return f"{d[:3]}.{d[3:6]}.{d[6:9]}.{d[9:]}"
    if n in (10, 9):
        return f"{d[:3]}.{d[3:6]}.{d[6:8]}.{d[8:]}"
    if n in (8, 7):
        return f"{d[:3]}.{d[3:6]}.{d[6:]}"
    return d


def py_severity(value, low=11):
    v = ("None" if value is None else value).strip()
    if v in ("0%", "0"):
        return "critical"
    if v.endswith("%"):
        x = _plain_float(v[:-1])
        if x is not None and x < low:
            return "low"
    return None


def _run(spark, values, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [tuple(r)[1:] for r in df.select("i", *[e(F.col("v")) for e in exprs]).orderBy("i").collect()]


@settings(max_examples=15, deadline=None)
@given(st.lists(PCT_TEXT, min_size=1, max_size=40))
def test_percent_functions_match_python(spark, values):
    got = _run(spark, values, lambda c: S.clean_pct(c, ""), lambda c: S.clean_pct(c, "0%"),
               S.fraction_to_pct, bands.severity)
    want = [(py_clean(v, ""), py_clean(v, "0%"), py_fraction(v), py_severity(v)) for v in values]
    assert got == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789. -ab\t", max_size=16)), min_size=1, max_size=40))
def test_format_ip_matches_python(spark, values):
    assert [g[0] for g in _run(spark, values, S.format_ip)] == [py_format_ip(v) for v in values]


@settings(max_examples=10, deadline=None)
@given(st.lists(PCT_TEXT, min_size=1, max_size=40))
def test_clean_pct_is_idempotent(spark, values):
    once = [g[0] for g in _run(spark, values, lambda c: S.clean_pct(c, ""))]
    twice = [g[0] for g in _run(spark, once, lambda c: S.clean_pct(c, ""))]
    assert [t if o != "" else "" for o, t in zip(once, twice)] == once


def test_forecast_independent_of_partitioning_and_order(spark):
    raw = X.history_raw(spark, SF_SMALL)
    a = {tuple(r) for r in forecast_ema(H.clean_history(raw), mode="off").collect()}
    shuffled = raw.repartition(7).orderBy(F.rand(3))
    b = {tuple(r) for r in forecast_ema(H.clean_history(shuffled), mode="off").collect()}
    assert a == b


def test_masked_merge_is_idempotent(spark):
    from supplyscope.operators import merge as M
    from supplyscope.plans import refresh as R

    inv = X.inventory_raw(spark, SF_SMALL).withColumn("ip", S.format_ip("ip"))
    poll = R.poll_results(X.poll_raw(spark, SF_SMALL), X.inventory_raw(spark, SF_SMALL))
    once = M.merge_masked_clean(M.merge_left(inv, poll, keys=["device_class", "ip"]), inv.columns,
                                ["toner_negro"], class_col="device_class")
    twice = M.merge_masked_clean(M.merge_left(once, poll, keys=["device_class", "ip"]), once.columns,
                                 ["toner_negro"], class_col="device_class")
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in twice.collect()}


def test_ema_of_a_constant_rate_is_that_rate(spark):
    import datetime as dt

    from supplyscope.operators.forecast import forecast_ema

    base = dt.datetime(2024, 1, 1)
    rows = [(i + 1, "n", "a", "M", 90.0 - 1.5 * d, None, None, None, None, None, base + dt.timedelta(days=d))
            for i, d in enumerate([0, 1, 3, 4, 7, 8, 10, 13, 14, 20, 21, 22])]
    df = spark.createDataFrame(rows, "seq long, nombre string, ip string, modelo string, toner_negro double, "
                                     "toner_cian double, toner_magenta double, toner_amarillo double, "
                                     "kit_mant double, kit_alim double, fecha timestamp_ntz")
    r = forecast_ema(df, mode="off").first()
    assert r.consumo_diario == 1.5 and r.dias_restantes == round((90.0 - 1.5 * 22) / 1.5, 1)
