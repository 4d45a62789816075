"""Fleet forecast jobs: raw log -> clean -> per-series forecast -> alerts.

Physical plan choice (made once per job from a key-only probe of the raw
log, see :func:`supplyscope.operators.forecast.probe_log`):

* every device (ip) holds at most ``supplyscope.series.blockRows`` raw rows
  -> the raw rows are hash-partitioned once by ``ip``.  That single exchange
  satisfies the dedupe (clusters on ip, stamp), the series windows (ip,
  model, supply) and the final aggregate (ip, model, supply), so the whole
  forecast runs with one shuffle of the wide log rows;
* some devices are hot -> the log is split by device.  The hot devices'
  rows (a list of at most ``total / blockRows`` keys, matched null-safely) keep the dedupe's map-side partial aggregation and have
  their series range-split into blocks
  (:mod:`supplyscope.operators.sequencing`); every other device keeps the
  one-exchange plan.  Series never span devices, so the two forecasts are
  disjoint and are unioned.  Only the hot share of the data pays for the
  range split and its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope import config as K
from supplyscope.functions.scalars import parse_ts
from supplyscope.operators import history as H
from supplyscope.operators import incremental as I
from supplyscope.operators.forecast import (forecast_ema, forecast_linear, probe_log, with_alerts,
                                            with_alerts2)
from supplyscope.session import conf_int, scratch_path


def _limit(raw: DataFrame) -> int:
    return conf_int(raw.sparkSession, K.SERIES_BLOCK_ROWS_CONF, K.SERIES_BLOCK_ROWS_DEFAULT)


def _cells_bound(raw: DataFrame, probe: dict) -> tuple[int, int]:
    """(largest series, cells of all hot devices), both from above: a block holds
    cells, and a row has one cell per supply column."""
    columns = sum(c in raw.columns for c in K.supply_cols())
    return probe["bound"][0], probe["hot_rows"] * max(1, columns)


def split_hot_devices(raw: DataFrame, limit: int, strip_status: bool) -> tuple[DataFrame, DataFrame]:
    """(hot rows, other rows) of a raw log: hot devices hold more than
    ``limit`` rows with a valid status.  How the hot list (at most ``total /
    limit`` keys) is joined is left to its measured size; NULL is a key like
    any other (the linear forecast keeps NULL groups)."""
    ok = H.filter_status(raw.select("ip", "estado"), strip=strip_status)
    hot = (ok.groupBy("ip").count().filter(F.col("count") > F.lit(limit))
           .select(F.col("ip").alias("_hot_ip")))
    match = F.col("ip").eqNullSafe(F.col("_hot_ip"))
    return raw.join(hot, match, "left_semi"), raw.join(hot, match, "left_anti")


def fleet_forecast_ema(raw: DataFrame, alerts: bool = True, block_rows: int | None = None, **kw) -> DataFrame:
    """EMA forecast (+ five-level alerts) of a raw history log; ``block_rows`` overrides the setting.

    The clean log is deduped by stamp text, and parsed stamps have one text
    per instant, so no series holds a timestamp tie and the probe proves
    nothing about them."""
    limit = block_rows or _limit(raw)
    probe = probe_log(raw, ties=False, limit=limit)

    def run(src: DataFrame, mode: str) -> DataFrame:
        return forecast_ema(H.clean_history(src), mode=mode, bound=_cells_bound(raw, probe), ties=False, **kw)

    if probe["bound"][0] <= limit:
        out = run(raw.repartition("ip"), "off")
    else:
        hot, cold = split_hot_devices(raw, limit, strip_status=True)
        out = run(cold.repartition("ip"), "off").unionByName(run(hot, "force"))
    return with_alerts(out) if alerts else out


def fleet_forecast_linear(raw: DataFrame, alerts: bool = True, **kw) -> DataFrame:
    """Linear forecast (+ two-level alert) of a raw history log: exact
    status filter, no dedupe, levels parsed per series."""
    limit = _limit(raw)
    probe = probe_log(raw, strip_status=False, ties=False, limit=limit)

    def run(src: DataFrame, mode: str) -> DataFrame:
        ok = H.filter_status(src, strip=False).withColumn("fecha", parse_ts("marca_de_tiempo"))
        return forecast_linear(ok, mode=mode, bound=_cells_bound(raw, probe), **kw)

    if probe["bound"][0] <= limit:
        out = run(raw.repartition("ip"), "off")
    else:
        hot, cold = split_hot_devices(raw, limit, strip_status=False)
        out = run(cold.repartition("ip"), "off").unionByName(run(hot, "force"))
    return with_alerts2(out) if alerts else out


def time_batches(raw: DataFrame, n: int) -> list[DataFrame]:
    """The log cut into ``n`` batches of equal time spans, as a log grows; rows
    whose stamp is no time go by their sequence."""
    at = parse_ts("marca_de_tiempo")
    seconds = F.unix_timestamp(at.cast("timestamp"))
    lo, hi = raw.agg(F.min(seconds), F.max(seconds)).first()
    lo, span = lo or 0, max(1, (hi or 0) - (lo or 0) + 1)
    part = F.coalesce(F.floor((seconds - F.lit(lo)) * n / F.lit(span)), F.pmod("seq", F.lit(n)))
    return [raw.filter(part == F.lit(i)) for i in range(n)]


def incremental_forecast(batches: list[DataFrame], alerts: bool = True, **kw) -> DataFrame:
    """EMA forecast of a log that arrives in batches: each updates the stored
    state and is not read again. A device with late rows that repeat nothing
    would need :func:`supplyscope.operators.incremental.rebuild`."""
    spark = batches[0].sparkSession
    state, last = I.empty_state(spark), None
    for batch in batches:
        path = scratch_path(spark, "forecast-state")
        state = I.write_state(I.update(state, batch, **kw)[0], path)
        if last is not None:
            I.drop_state(spark, last)
        last = path
    return I.forecast_of(state, alerts)
