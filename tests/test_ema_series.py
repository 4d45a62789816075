"""The EMA at every step row against its recurrence."""

import datetime as dt
import random

import pytest

from supplyscope import config as K
from supplyscope.operators.series import ema_alpha, ema_chunk, ema_series, step_table, step_table_split

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "seq long, device string, supply string, ts timestamp_ntz, pct double"


def rows(sizes, seed=7):
    """Series with ties in time, jumps back up and long flat stretches."""
    rng, out, seq = random.Random(seed), [], 0
    for device, n in sizes.items():
        t, level = T0, 100.0
        for _ in range(n):
            seq += 1
            t += dt.timedelta(hours=rng.choice([0, 1, 5, 24]))
            level = 100.0 if level < 5 else level - rng.choice([0.0, 0.1, 1.7, -2.0])
            out.append((seq, device, "toner", t, level))
    return out


def naive(data, span):
    """One value after the other: {seq: ema}."""
    a, out, series = ema_alpha(span), {}, {}
    for seq, device, supply, t, level in sorted(data, key=lambda r: (r[3], r[0])):
        last, ema = series.get((device, supply), (None, None))
        if last and (t - last[0]).total_seconds() > 0:
            rate = (last[1] - level) / ((t - last[0]).total_seconds() / 86400)
            ema = rate if ema is None else (1 - a) * ema + a * rate
            out[seq] = ema
        else:
            out[seq] = None
        series[device, supply] = ((t, level), ema)
    return out


def close(got, want):
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert (got[k] is None) == (v is None)
        assert v is None or abs(got[k] - v) <= 1e-9 * max(1.0, abs(v))


@pytest.mark.parametrize("span", [1, 2, 10, 200])
def test_recurrence(spark, span):
    data = rows({"a": 700, "b": 1, "c": 2, None: 40, "d": 60})
    steps = step_table(spark.createDataFrame(data, SCHEMA), ["device", "supply"], mode="off")[0]
    got = {r.seq: r.ema for r in ema_series(steps, ["device", "supply"], span=span).collect()}
    close(got, naive(data, span))


def test_forced_blocks_and_a_hot_series(spark):
    data = rows({"hot": 6000, **{f"d{i}": 20 for i in range(100)}})
    df = spark.createDataFrame(data, SCHEMA)
    steps = step_table_split(df, ["device", "supply"], block_rows=500)
    got = {r.seq: r.ema for r in ema_series(steps, ["device", "supply"]).collect()}
    close(got, naive(data, K.EMA_SPAN))
    forced = step_table(df, ["device", "supply"], mode="force")[0]
    close({r.seq: r.ema for r in ema_series(forced, ["device", "supply"]).collect()}, got)


def test_chunks_spread_a_hot_series(spark):
    size, reach = ema_chunk(K.EMA_SPAN)
    assert (1 - ema_alpha(K.EMA_SPAN)) ** size <= 1.1e-20 and reach == 16
    data = rows({"hot": 3000})
    steps = step_table(spark.createDataFrame(data, SCHEMA), ["device", "supply"], mode="off")[0]
    plan = ema_series(steps, ["device", "supply"])._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" in plan and "Python" not in plan


def test_last_value_is_the_forecast_rate(spark):
    from supplyscope.plans import catalog

    sf = "/root/testdata/sf0.001"
    every = catalog.ema_series_q(spark, sf).where("ema is not null").join(
        catalog._steps(spark, sf).select("seq", "_cum__step", "_tot__step"), "seq").where("_cum__step = _tot__step")
    last = {(r.device, r.supply): r.ema for r in every.collect()}
    want = {(r.device, r.supply): r.ema for r in catalog.ema_last(spark, sf).collect() if r.m}
    assert last.keys() == want.keys() and all(abs(last[k] - want[k]) < 1e-5 for k in want)


def test_empty(spark):
    steps = step_table(spark.createDataFrame([], SCHEMA), ["device", "supply"], mode="off")[0]
    assert ema_series(steps, ["device", "supply"]).collect() == []
