"""Forecast state that an appended batch updates, without the log.

The EMA forecast of a series needs its size, first and last reading, the EMA
as of the last step, the time of that step and the least-squares moments of
(days, previous level). All of these merge: a batch contributes its own
readings and the step that leads into them from the state's last reading,
the EMA of a batch is an affine map applied to the state's EMA, and the
moments add up by the parallel-variance rule. So the state is one row per
series, whatever the length of the log, and a batch's update reads the batch
and the state only.

Besides, the state holds one row per (device, model) for its name, one row
per device with its newest reading time, and the rows whose stamp is no time
(one per device and text, as the dedupe keeps them).

Contract of a batch: a device's readings come in time order from batch to
batch. Inside a batch any order and any repetition is fine. A row that is
not newer than its device's newest reading in the state is *late*: either a
repetition of a row that was taken (the log's dedupe drops it too) or a
reading that came too late, which an EMA cannot take in afterwards. Late rows
are returned, not dropped; :func:`rebuild` recomputes the state of their
devices from the log.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyscope import config as K
from supplyscope.operators.forecast import GROUP, KEYS, _ema_branches, with_alerts
from supplyscope.operators.history import clean_history, dedupe_first
from supplyscope.operators.reshape import unpivot_supplies
from supplyscope.operators.series import STEP, days_between, ema_alpha, step_table
from supplyscope.session import drop_path

_S, _D, _L, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampNTZType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols])


_KEY = [("ip", _S), ("modelo", _S)]

#: One row per series: size, first time, last reading, steps, EMA, last step, moments of (days, previous level).
SERIES_SCHEMA = _schema(*_KEY, ("consumible", _S), ("n", _L), ("t0", _TS), ("t1", _TS), ("seq1", _L), ("p1", _D),
                        ("m", _L), ("ema", _D), ("t_step", _TS), ("k", _L), ("mx", _D), ("my", _D), ("cxx", _D), ("cxy", _D))
#: The name of a group and the reading it comes from.
NAMES_SCHEMA = _schema(*_KEY, ("nombre", _S), ("fecha", _TS), ("seq", _L))
#: A device's newest reading time.
CLOCK_SCHEMA = _schema(("ip", _S), ("fecha", _TS))
#: Rows whose stamp is no time, as the dedupe keeps them.
UNPARSED_SCHEMA = _schema(("seq", _L), ("nombre", _S), *_KEY, *[(c, _D) for c in K.supply_cols()], ("marca_de_tiempo", _S))


@dataclass
class ForecastState:
    series: DataFrame
    names: DataFrame
    clock: DataFrame
    unparsed: DataFrame


SCHEMAS = {"series": SERIES_SCHEMA, "names": NAMES_SCHEMA, "clock": CLOCK_SCHEMA, "unparsed": UNPARSED_SCHEMA}


def empty_state(spark: SparkSession) -> ForecastState:
    return ForecastState(**{n: spark.createDataFrame([], s) for n, s in SCHEMAS.items()})


def write_state(state: ForecastState, path: str) -> ForecastState:
    """Write the state to a new ``path`` and return it as read from there."""
    spark = state.series.sparkSession
    for f in fields(state):
        getattr(state, f.name).write.parquet(f"{path}/{f.name}")
    return read_state(spark, path)


def read_state(spark: SparkSession, path: str) -> ForecastState:
    return ForecastState(**{n: spark.read.schema(s).parquet(f"{path}/{n}") for n, s in SCHEMAS.items()})


def drop_state(spark: SparkSession, path: str) -> None:
    drop_path(spark, path)


def _cells(log: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Non-null cells of the rows that a forecast takes, one row each."""
    rows = log.filter(F.col("ip").isNotNull() & F.col("modelo").isNotNull())
    return unpivot_supplies(rows, ["seq", "ip", "modelo", "fecha"], names, value_type="double").filter(F.col("valor").isNotNull())


def _merged_moments(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """Moments of two disjoint sets: counts add, means and products by the parallel-variance rule."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    ka, kb = F.coalesce(a["k"], F.lit(0)), F.coalesce(b["k"], F.lit(0))
    k = ka + kb
    part = F.when(k > 0, kb / k).otherwise(F.lit(0.0))
    dx, dy = zero(b["mx"]) - zero(a["mx"]), zero(b["my"]) - zero(a["my"])
    both = F.when((ka > 0) & (kb > 0), ka * kb / k).otherwise(F.lit(0.0))
    return {"k": k, "mx": F.when(ka > 0, zero(a["mx"]) + dx * part).otherwise(zero(b["mx"])),
            "my": F.when(ka > 0, zero(a["my"]) + dy * part).otherwise(zero(b["my"])),
            "cxx": zero(a["cxx"]) + zero(b["cxx"]) + dx * dx * both,
            "cxy": zero(a["cxy"]) + zero(b["cxy"]) + dx * dy * both}


def merge_series(old: DataFrame, cells: DataFrame, span: int = K.EMA_SPAN, mode: str | None = None) -> DataFrame:
    """The series state after ``cells`` (ip, modelo, consumible, seq, fecha, valor),
    all newer than their series' last reading.

    Each series' last reading stands in front of its new ones as a seed row,
    which carries the state through the window and the aggregate: no join.
    """
    state = F.struct(*[F.col(c) for c in old.columns if c not in KEYS])
    seeds = old.select(*KEYS, F.col("seq1").alias("seq"), F.col("t1").alias("fecha"), F.col("p1").alias("valor"), state.alias("_old"))
    new = cells.select(*KEYS, "seq", "fecha", "valor", F.lit(None).cast(seeds.schema["_old"].dataType).alias("_old"))
    steps, _ = step_table(seeds.unionByName(new), KEYS, ts="fecha", tie="seq", val="valor", mode=mode)

    a = ema_alpha(span)
    i, m, step = F.col(f"_cum_{STEP}"), F.col(f"_tot_{STEP}"), F.col(STEP)
    x, y, rate = F.when(step, F.col("days")), F.when(step, F.col("_prev_valor")), F.col("rate")
    added = F.when(step, F.lit(a) * F.pow(F.lit(1.0 - a), (m - i).cast("double")) * rate)
    last = F.struct("fecha", "seq", "valor")
    g = steps.groupBy(*KEYS).agg(
        F.max("_old").alias("o"),
        F.sum(F.when(F.col("_old").isNull(), 1).otherwise(0)).alias("bn"),
        F.min("fecha").alias("b0"), F.max(last).alias("b1"), F.max(F.when(step, F.col("fecha"))).alias("b_step"),
        F.sum(F.when(step, 1).otherwise(0)).alias("bm"), F.sum(added).alias("badd"),
        F.min_by(rate, F.when(step, i)).alias("brate"),
        F.count(x).alias("bk"), F.avg(x).alias("bx"), F.avg(y).alias("by"),
        F.var_pop(x).alias("vx"), F.covar_pop(x, y).alias("vxy"))

    # The batch's days count from the seed; the state's from the first reading.
    shift = F.coalesce(days_between(F.col("o.t0"), F.col("o.t1")), F.lit(0.0))
    mom = _merged_moments({c: F.col(f"o.{c}") for c in ("k", "mx", "my", "cxx", "cxy")},
                          {"k": F.col("bk"), "mx": F.col("bx") + shift, "my": F.col("by"),
                           "cxx": F.col("vx") * F.col("bk"), "cxy": F.col("vxy") * F.col("bk")})
    before = F.coalesce(F.when(F.col("o.m") > 0, F.col("o.ema")), F.col("brate"))      # an EMA begins at its first rate
    ema = F.when(F.col("bm") > 0, F.pow(F.lit(1.0 - a), F.col("bm").cast("double")) * before + F.col("badd"))
    old_n, old_m = F.coalesce(F.col("o.n"), F.lit(0)), F.coalesce(F.col("o.m"), F.lit(0))
    return g.select(
        *KEYS, (old_n + F.col("bn")).alias("n"), F.coalesce(F.col("o.t0"), F.col("b0")).alias("t0"),
        F.col("b1.fecha").alias("t1"), F.col("b1.seq").alias("seq1"), F.col("b1.valor").alias("p1"),
        (old_m + F.col("bm")).alias("m"), F.coalesce(ema, F.col("o.ema")).alias("ema"),
        F.coalesce(F.col("b_step"), F.col("o.t_step")).alias("t_step"), *[c.alias(n) for n, c in mom.items()])


def update(state: ForecastState, raw: DataFrame, span: int = K.EMA_SPAN, mode: str | None = None,
           ) -> tuple[ForecastState, DataFrame]:
    """(state after the batch ``raw``, late rows of the batch).

    ``raw`` holds rows of the history log (see
    :func:`supplyscope.operators.history.clean_history`). Both results are
    plans over the batch and the state; write the state before the next batch.
    A null ip is no device of a forecast; a null model keeps its row out of
    the series but not out of the dedupe. An empty batch changes nothing.
    """
    clean = clean_history(raw).filter(F.col("ip").isNotNull())
    if "nombre" not in clean.columns:
        clean = clean.withColumn("nombre", F.col("ip"))
    timed = clean.filter(F.col("fecha").isNotNull())
    known = timed.join(state.clock.withColumnRenamed("fecha", "_clock"), "ip", "left")
    is_late = F.coalesce(F.col("fecha") <= F.col("_clock"), F.lit(False))
    fresh, late = known.filter(~is_late).drop("_clock"), known.filter(is_late).drop("_clock")

    named = fresh.filter(F.col("modelo").isNotNull()).select(*NAMES_SCHEMA.names)
    newest = F.max_by(F.struct("nombre", "fecha", "seq"), F.struct(F.col("fecha"), -F.col("seq"))).alias("v")
    names = state.names.unionByName(named).groupBy(*GROUP).agg(newest).select(*GROUP, "v.nombre", "v.fecha", "v.seq")
    clock = state.clock.unionByName(fresh.select("ip", "fecha")).groupBy("ip").agg(F.max("fecha").alias("fecha"))
    unparsed = clean.filter(F.col("fecha").isNull()).select(*UNPARSED_SCHEMA.names)
    unparsed = dedupe_first(state.unparsed.unionByName(unparsed), ["ip", "marca_de_tiempo"], tie="seq")
    series = merge_series(state.series, _cells(fresh), span, mode)
    return ForecastState(series, names, clock, unparsed), late


def rebuild(state: ForecastState, log: DataFrame, devices: DataFrame, span: int = K.EMA_SPAN,
            mode: str | None = None) -> ForecastState:
    """The state with that of ``devices`` (a column ``ip``) recomputed from their rows of the whole log."""
    some = devices.select("ip").distinct()
    spark = log.sparkSession
    again, _ = update(empty_state(spark), log.join(some, "ip", "left_semi"), span, mode)
    return ForecastState(**{f.name: getattr(state, f.name).join(some, "ip", "left_anti").unionByName(getattr(again, f.name))
                            for f in fields(state)})


def forecast_of(state: ForecastState, alerts: bool = True, span: int = K.EMA_SPAN,
                max_days: float = K.MAX_FORECAST_DAYS) -> DataFrame:
    """The EMA forecast that the whole log would give, from the state alone."""
    # A cell without a time makes its series exist, and may name its group.
    other = state.unparsed.withColumn("fecha", F.lit(None).cast("timestamp_ntz"))
    exist = _cells(other).select(*KEYS).distinct()
    series = exist.join(state.series, KEYS, "full")
    untimed = other.filter(F.col("modelo").isNotNull()).select(*NAMES_SCHEMA.names)
    name = F.max_by("nombre", F.struct(F.col("fecha"), -F.col("seq"))).alias("nombre")
    names = state.names.unionByName(untimed).groupBy(*GROUP).agg(name)
    agg = series.join(names, GROUP, "left").select(
        "nombre", *KEYS, F.coalesce("n", F.lit(0)).alias("_n"), F.col("p1").alias("_p"), F.coalesce("m", F.lit(0)).alias("_m"),
        F.col("ema").alias("_ema"), F.col("t_step").alias("_last_ts"), F.when(F.col("cxx") > 0, F.col("cxy") / F.col("cxx")).alias("_slope_nt"),
        F.lit(None).cast("double").alias("_slope_t"), F.lit(False).alias("_ties"))
    out = _ema_branches(agg, span, max_days)
    return with_alerts(out) if alerts else out
