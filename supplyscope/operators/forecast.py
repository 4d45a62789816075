"""Depletion forecasts per (device, model, supply) series.

``forecast_ema``: consumption rate = last value of an EMA (span 10,
adjust=False) of the step rates, falling back to a least-squares slope of
the level over elapsed days when the EMA is not positive; days left =
level / rate; exhaustion date = last step time + days; alert bands on the
rounded days.

``forecast_linear``: least-squares slope over all points (3 or more),
two-point rate for 2 points, no horizon cap, two-level alert.

Both are columnar: one pass of windows (positions and previous values from
the skew-aware sequencing), one grouped aggregation with partial
aggregation, one projection.  No per-series Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyscope import config as K
from supplyscope.functions.bands import alert_band, alert_band2
from supplyscope.functions.scalars import add_days, parse_ts, pct_to_double, round_to
from supplyscope.operators.history import filter_status
from supplyscope.operators.reshape import unpivot_supplies
from supplyscope.operators.sequencing import order_series
from supplyscope.operators.series import STEP, days_between, ema_weight, step_table

GROUP = ["ip", "modelo"]
KEYS = [*GROUP, "consumible"]
OUT_COLS = ["nombre", "ip", "modelo", "consumible", "porcentaje_actual", "consumo_diario",
            "dias_restantes", "fecha_agotamiento", "metodo"]


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def _long_readings(log: DataFrame, supplies: list[str] | None, value_type: str = "double") -> DataFrame:
    """The log's non-null cells, one row each: only these are sorted and windowed."""
    long = unpivot_supplies(log, ["seq", "nombre", *GROUP, "fecha"], supplies, value_type=value_type)
    return long.filter(F.col("valor").isNotNull())


def _with_name(log: DataFrame) -> DataFrame:
    """A log without names: the device key stands in."""
    return log if "nombre" in log.columns else log.withColumn("nombre", F.col("ip"))


def _join_names(agg: DataFrame, log: DataFrame, name: Column) -> DataFrame:
    """Result rows with the name of their (device, model) group, NULL keys matching
    each other: one partial aggregation of the log, joined to one row per series."""
    names = log.groupBy(*GROUP).agg(name.alias("_name")).select(*[F.col(k).alias(f"_g_{k}") for k in GROUP], "_name")
    match = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in GROUP]
    return agg.join(names, match, "left").withColumn("nombre", F.col("_name")).drop("_name", *[f"_g_{k}" for k in GROUP])


def probe_log(raw: DataFrame, strip_status: bool = True, ties: bool = True, limit: int | None = None) -> dict:
    """Cheap key-only probe of a raw log (ip, status and stamp columns), one
    small job returning scalars.

    ``bound``: (largest row count of one ip, total rows) -- rows per ip bound
    every series size from above.  ``ties``: whether two different stamp
    texts of one ip parse to the same instant (``min(text) != max(text)``
    per ip and instant), the only way a deduped series can hold timestamp
    ties; skipped (reported True) with ``ties=False``. A log parsed by
    :func:`parse_ts` needs no proof: that accepts one fixed text per instant.
    ``hot_rows``: rows of the ips that hold more than ``limit`` rows.

    Counts per ip are added up map-side, so without the proof the probe
    shuffles about one row per device and task. With it, it first
    aggregates per (ip, instant), which spreads a hot device.
    """
    ok = filter_status(raw.select("ip", "estado", "marca_de_tiempo"), strip=strip_status)
    if ties:
        per_ts = (ok.withColumn("fecha", parse_ts("marca_de_tiempo"))
                  .groupBy("ip", "fecha").agg(F.count(F.lit(1)).alias("c"),
                                              F.min("marca_de_tiempo").alias("lo"),
                                              F.max("marca_de_tiempo").alias("hi")))
        tie = F.col("fecha").isNotNull() & (F.col("lo") != F.col("hi"))
        per_ip = per_ts.groupBy("ip").agg(F.sum("c").alias("n"),
                                          F.max(F.when(tie, 1).otherwise(0)).alias("t"))
    else:
        per_ip = ok.groupBy("ip").agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("t"))
    over = F.lit(0) if limit is None else F.when(F.col("n") > limit, F.col("n"))
    row = per_ip.agg(F.max("n").alias("mx"), F.sum("n").alias("tot"), F.max("t").alias("t"), F.sum(over).alias("hot")).first()
    return {"bound": (int(row["mx"] or 0), int(row["tot"] or 0)), "ties": (row["t"] or 0) > 0,
            "hot_rows": int(row["hot"] or 0)}


def forecast_ema(clean: DataFrame, supplies: list[str] | None = None, span: int = K.EMA_SPAN,
                 max_days: float = K.MAX_FORECAST_DAYS, mode: str | None = None,
                 bound=None, ties: bool = True) -> DataFrame:
    """EMA forecast of every series of a clean wide log (see
    :func:`supplyscope.operators.history.clean_history`).

    One row per (ip, modelo, supply) that has at least one level; groups
    with a NULL ip or model are dropped.  ``bound``/``ties`` come from
    :func:`probe_log` of the raw log: with ``ties=False`` the positional
    pairing branch is provably empty and left out of the plan.

    A group is named by its newest row, whether or not that has a level: in
    the one-exchange plan (``mode="off"``) by a window over the wide rows,
    else by an aggregation, which a hot group cannot overload.
    """
    log = _with_name(clean).filter(F.col("ip").isNotNull() & F.col("modelo").isNotNull())
    name = F.max_by("nombre", F.struct(F.col("fecha"), -F.col("seq")))
    named = log.withColumn("nombre", name.over(Window.partitionBy(*GROUP))) if mode == "off" else log
    # Cells without a time form their own window partitions: they count for
    # the series' existence, never for its steps.
    long = _long_readings(named, supplies).withColumn("_valid", F.col("fecha").isNotNull())
    steps, _ = step_table(long, KEYS + ["_valid"], ts="fecha", tie="seq", val="valor", mode=mode,
                          bound=bound)

    v = F.col("_valid")
    m_all, n_all = F.col(f"_tot_{STEP}"), F.col("_n")
    no_tie = v & F.col(STEP) & (m_all == n_all - 1)
    agg = steps.groupBy(*KEYS).agg(
        F.max("nombre").alias("nombre"),
        F.sum(F.when(v, 1).otherwise(0)).alias("_n"),
        F.max_by(F.when(v, F.col("valor")), F.struct(v, F.col("fecha"), F.col("seq"))).alias("_p"),
        F.sum(F.when(v & F.col(STEP), 1).otherwise(0)).alias("_m"),
        F.sum(F.when(v, ema_weight(span) * F.col("rate"))).alias("_ema"),
        F.max(F.when(v & F.col(STEP), F.col("fecha"))).alias("_last_ts"),
        F.regr_slope(F.when(no_tie, F.col(f"_prev_valor")), F.when(no_tie, F.col("days"))).alias("_slope_nt"),
        F.max(F.when(v, m_all < n_all - 1)).alias("_ties"),
    )
    if mode != "off":
        agg = _join_names(agg, log, name)

    if not ties:
        return _ema_branches(agg.withColumn("_slope_t", F.lit(None).cast("double")), span, max_days)
    # Series with timestamp ties pair x and y by position (equi-join).
    tied = steps.filter(v & (m_all < n_all - 1))
    xs = tied.filter(F.col(STEP)).select(*KEYS, F.col(f"_cum_{STEP}").alias("_pos"), F.col("days").alias("x"))
    ys = tied.select(*KEYS, F.col("_rn").alias("_pos"), F.col("valor").alias("y"))
    tie_slope = (xs.join(ys, on=[*KEYS, "_pos"], how="inner")
                 .groupBy(*KEYS).agg(F.regr_slope("y", "x").alias("_slope_t")))
    agg = agg.join(tie_slope, on=KEYS, how="left")

    return _ema_branches(agg, span, max_days)


def _ema_branches(agg: DataFrame, span: int, max_days: float) -> DataFrame:
    n, m, p = F.col("_n"), F.col("_m"), F.col("_p")
    ema = F.when(m >= 1, F.col("_ema"))
    use_ema = ema.isNotNull() & (ema > F.lit(0.0))
    slope = F.coalesce(F.when(F.col("_ties"), F.col("_slope_t")).otherwise(F.col("_slope_nt")), F.lit(0.0))
    rate = F.when(use_ema, ema).when(m >= 3, -slope)
    method = F.when(use_ema, F.lit(K.METHOD_EMA.format(span=span))).when(m >= 3, F.lit(K.METHOD_FALLBACK)) \
        .otherwise(F.lit(K.METHOD_INVALID_SLOPE))
    a = agg.select(*KEYS, "nombre", n.alias("n"), p.alias("p"), rate.alias("r"), method.alias("meth"),
                   F.col("_last_ts").alias("t"))
    n, p, r, meth, t = F.col("n"), F.col("p"), F.col("r"), F.col("meth"), F.col("t")
    too_few = n < 2
    flat = r.isNull() | (r <= F.lit(0.0))
    d = F.when(~too_few & ~flat, p / r)
    far = d > F.lit(float(max_days))

    def pick(few, flat_v, far_v, ok_v):
        return F.when(too_few, few).when(flat, flat_v).when(far, far_v).otherwise(ok_v)

    out = a.select(
        "nombre", *KEYS,
        pick(_null("double"), p, round_to(p, 1), round_to(p, 1)).alias("porcentaje_actual"),
        pick(_null("double"), F.lit(0.0), round_to(r, 6), round_to(r, 4)).alias("consumo_diario"),
        pick(_null("double"), _null("double"), round_to(d, 1), round_to(d, 1)).alias("dias_restantes"),
        pick(_null("timestamp_ntz"), _null("timestamp_ntz"), _null("timestamp_ntz"), add_days(t, d)).alias("fecha_agotamiento"),
        pick(F.lit(K.METHOD_TOO_FEW), meth, F.concat(meth, F.lit(K.SUFFIX_UNRELIABLE)), meth).alias("metodo"),
    )
    return out.select(*OUT_COLS)


def order_forecast(forecast: DataFrame) -> DataFrame:
    """Report order: device key, then the fixed supply order (a global sort,
    use only for presentation)."""
    ix = None
    for i, name in enumerate(K.supply_names()):
        ix = F.when(F.col("consumible") == name, F.lit(i)) if ix is None else ix.when(F.col("consumible") == name, F.lit(i))
    return forecast.orderBy(F.col("ip").asc_nulls_last(), F.col("modelo").asc_nulls_last(), ix)


def with_alerts(forecast: DataFrame, critical: float = K.ALERT_CRITICAL_DAYS,
                medium: float = K.ALERT_MEDIUM_DAYS, low: float = K.ALERT_LOW_STOCK_DAYS) -> DataFrame:
    """Add the five-level ``alerta`` band of the (rounded) days left."""
    return forecast.withColumn("alerta", alert_band("dias_restantes", critical, medium, low))


def forecast_linear(clean: DataFrame, supplies: list[str] | None = None, mode: str | None = None,
                    bound=None) -> DataFrame:
    """Linear forecast of a log filtered on status but neither deduped nor
    parsed (levels still text, see :func:`clean_history` with
    ``dedupe=False`` and raw levels).  NULL ip/model groups are kept; the
    group name is the first logged one.
    """
    log = _with_name(clean)
    name = F.min_by("nombre", F.col("seq"))
    named = log.withColumn("nombre", name.over(Window.partitionBy(*GROUP))) if mode == "off" else log
    long = _long_readings(named, supplies, value_type="string").withColumn("_y", pct_to_double("valor"))
    long = long.withColumn("_v", F.col("fecha").isNotNull() & F.col("_y").isNotNull())
    # x = days since the series' first valid reading, as the original
    # regresses on; the window shares the aggregate's exchange.
    seq_df, _ = order_series(long, KEYS + ["_v"], ["fecha", "seq"], carry=["fecha"], mode=mode, bound=bound)
    order_key = F.when(F.col("_v"), F.struct(F.col("fecha"), F.col("seq")))
    x = days_between(F.col("_first_fecha"), F.col("fecha"))
    agg = seq_df.groupBy(*KEYS).agg(
        F.max("nombre").alias("nombre"),
        F.sum(F.when(F.col("_v"), 1).otherwise(0)).alias("n"),
        F.max_by(F.col("_y"), order_key).alias("p"),
        F.min_by(F.col("_y"), order_key).alias("p0"),
        F.max(F.when(F.col("_v"), F.col("fecha"))).alias("t"),
        F.min(F.when(F.col("_v"), F.col("fecha"))).alias("t0"),
        F.regr_slope(F.when(F.col("_v"), F.col("_y")), F.when(F.col("_v"), x)).alias("_slope"),
    )
    if mode != "off":
        agg = _join_names(agg, log, name)

    n, p, p0, t, t0 = F.col("n"), F.col("p"), F.col("p0"), F.col("t"), F.col("t0")
    dd = days_between(t0, t)
    two_point = F.when(dd > F.lit(0.0), (p0 - p) / dd)
    r = F.when(n >= 3, -F.coalesce(F.col("_slope"), F.lit(0.0))).when(n == 2, two_point)
    meth = F.when(n >= 3, F.lit(K.METHOD_LINEAR)).otherwise(F.lit(K.METHOD_SIMPLE))
    too_few = n < 2
    flat = r.isNull() | (r <= F.lit(0.0))
    d = F.when(~too_few & ~flat, p / r)

    def pick(few, flat_v, ok_v):
        return F.when(too_few, few).when(flat, flat_v).otherwise(ok_v)

    out = agg.select(
        "nombre", *KEYS,
        pick(_null("double"), p, round_to(p, 1)).alias("porcentaje_actual"),
        pick(_null("double"), F.lit(0.0), round_to(r, 2)).alias("consumo_diario"),
        pick(_null("double"), _null("double"), round_to(d, 1)).alias("dias_restantes"),
        pick(_null("timestamp_ntz"), _null("timestamp_ntz"), add_days(t, d)).alias("fecha_agotamiento"),
        pick(F.lit(K.METHOD_TOO_FEW), meth, meth).alias("metodo"),
    )
    return out.select(*OUT_COLS)


def with_alerts2(forecast: DataFrame, limit: float = K.LINEAR_ALERT_DAYS) -> DataFrame:
    """Add the two-level ``alerta`` band (linear forecast)."""
    return forecast.withColumn("alerta", alert_band2("dias_restantes", limit))
