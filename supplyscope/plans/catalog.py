"""Query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads whole tables of the dataset folder (through the adapters
in :mod:`supplyscope.sources.fixtures`) and returns a lazy DataFrame whose
column names equal those of its SQL twin in :mod:`supplyscope.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope import config as K
from supplyscope.functions import bands, scalars as S
from supplyscope.operators import history as H
from supplyscope.operators import merge as M
from supplyscope.operators.forecast import forecast_ema, order_forecast
from supplyscope.operators.reshape import unpivot_supplies
from supplyscope.operators.series import STEP, ema_series, ema_weight, step_table_split
from supplyscope.plans import forecast_jobs as FJ
from supplyscope.plans import jobs as J
from supplyscope.plans import refresh as R
from supplyscope.plans import report as P
from supplyscope.sources import buckets as B
from supplyscope.sources import checked as C
from supplyscope.sources import evolved as V
from supplyscope.sources import fixtures as X
from supplyscope.sources import pages as G
from supplyscope.sources import tables as T
from supplyscope.sources import timed_log as L
from supplyscope.session import drop_path, scratch_path
from supplyscope.streaming.ingest import stream_dedupe_history, stream_latest_levels
from supplyscope.streaming.ordered import stream_dedupe_ordered
from supplyscope.streaming.upsert import ClassTable, run_upserts

Query = Callable[[SparkSession, str], DataFrame]
READ_KEYS = ["device", "supply"]


# ---------------------------------------------------------------- sources
def scan_inventory(spark, d):
    return X.inventory_raw(spark, d)


def scan_history(spark, d):
    return X.history_raw(spark, d)


def scan_all_classes(spark, d):
    path = scratch_path(spark, "classes")
    T.write_class_tables(X.inventory_raw(spark, d), path)
    return T.read_class_tables(spark, path)


def scan_classes_evolved(spark, d):
    path = scratch_path(spark, "sheets")
    for cls, gen, sheet in X.class_sheets(spark, d):
        V.write_class(sheet, path, cls, gen)
    return V.read_evolved(spark, path)


def read_sheet_split(spark, d):
    """The log exported as text, some lines broken: every line with what became of it."""
    path, out = scratch_path(spark, "sheet"), scratch_path(spark, "sheet-split")
    X.log_lines(spark, d).write.text(path)
    split = C.split_sheet(spark, path, out, header=False)
    drop_path(spark, path)
    clean = split.clean.withColumn(C.LINE, F.lit(None).cast("string")).withColumn(C.REASONS, F.lit(None).cast("string"))
    both = clean.unionByName(split.rejected)
    return both.select(*[F.when(F.col(C.LINE).isNull(), F.col(c)).alias(c) for c in C.SHEET_SCHEMA.names],
                       F.col(C.LINE).alias("line"), C.REASONS, *[F.lit(n).cast("long").alias(k) for k, n in (
                           ("n_read", split.read), ("n_broken", split.broken), ("n_bad_cells", split.bad_cells))])


def history_since(spark, d):
    """The log appended in three batches laid out by time; readings of a week."""
    path, raw = scratch_path(spark, "timed-log"), X.history_raw(spark, d)
    for batch in FJ.time_batches(raw, 3):
        L.append_timed(batch, path, file_rows=2_000)
    return L.read_between(spark, path, raw.schema, X.WEEK[0], X.WEEK[1])


def extract_gauges(spark, d):
    return G.extract_gauges(X.gauge_pages(spark, d), "nav")


def extract_gauges_id(spark, d):
    return G.extract_gauges(X.device_pages(spark, d), "supply_gauge")


def extract_gauges_toner_list(spark, d):
    return G.extract_gauges(X.device_pages(spark, d), "toner_list")


def extract_gauges_grid(spark, d):
    return G.extract_gauges(X.device_pages(spark, d), "grid")


def extract_gauges_row_id(spark, d):
    return G.extract_gauges(X.device_pages(spark, d), "row_id")


def gauges_to_supplies(spark, d):
    return G.gauges_to_supplies(X.device_pages(spark, d))


def gauges_pivot(spark, d):
    return G.pivot_gauges(G.label_gauges(G.extract_gauges(X.gauge_pages(spark, d), "nav", keep=("device_class",))))


# ------------------------------------------------- projections / filters
def trim_columns(spark, d):
    # Padded column names (as a spreadsheet export leaves them) -> trimmed.
    # Internal names keep the result free of dots, which column references
    # would read as struct access.
    h = X.history_raw(spark, d)
    padded = h.toDF(*[f"  {c}\t " for c in h.columns])
    return H.trim_columns(padded)


def filter_valid_key(spark, d):
    inv = X.inventory_raw(spark, d).withColumn("ip", S.format_ip("ip"))
    return inv.filter(F.col("ip").isNotNull())


def filter_ok_trim(spark, d):
    return H.filter_status(X.history_raw(spark, d), strip=True)


def filter_ok_exact(spark, d):
    return H.filter_status(X.history_raw(spark, d), strip=False)


def stamp_run(spark, d):
    return X.inventory_raw(spark, d).withColumn("marca_de_tiempo", F.lit(X.RUN_STAMP))


def ip_to_url(spark, d):
    inv = X.inventory_raw(spark, d)
    ip = S.format_ip("ip")
    return inv.select("device_id", ip.alias("ip"), S.ip_to_url(ip).alias("url"))


def parse_ts(spark, d):
    return X.history_raw(spark, d).select("seq", "marca_de_tiempo", S.parse_ts("marca_de_tiempo").alias("fecha"))


# ------------------------------------------------------------- scalars
def _inv_ip(spark, d, expr):
    return X.inventory_raw(spark, d).select("device_id", "ip", expr.alias("ip_fmt"))


def format_ip(spark, d):
    return _inv_ip(spark, d, S.format_ip("ip"))


def format_ip_dots(spark, d):
    inv = X.inventory_raw(spark, d)
    return inv.select("device_id", "ip", S.format_ip("ip", "dots", null_check=False).alias("ip_v6"),
                      S.format_ip("ip", "dots").alias("ip_v7"))


def format_ip_zero(spark, d):
    return _inv_ip(spark, d, S.format_ip("ip", "zero"))


def normalize_ip(spark, d):
    return _inv_ip(spark, d, S.normalize_ip("ip"))


def _history_cells(spark, d):
    return unpivot_supplies(X.history_raw(spark, d), ["seq"], add_missing=True, value_type="string")


def unpivot_supplies_q(spark, d):
    return unpivot_supplies(X.history_raw(spark, d), ["seq", "ip"], value_type="string")


def clean_pct_blank(spark, d):
    return _history_cells(spark, d).withColumn("out", S.clean_pct("valor", ""))


def clean_pct_zero(spark, d):
    return _history_cells(spark, d).withColumn("out", S.clean_pct("valor", "0%"))


def clean_pct_float(spark, d):
    return _history_cells(spark, d).withColumn("out", S.clean_pct_float("valor"))


def pct_to_double(spark, d):
    return _history_cells(spark, d).withColumn("out", S.pct_to_double("valor"))


def severity(spark, d):
    return _history_cells(spark, d).withColumn("severity", bands.severity("valor"))


def fraction_to_pct(spark, d):
    inv = X.inventory_raw(spark, d)
    return inv.select("device_id", "toner_negro", "ui_negro",
                      S.fraction_to_pct("toner_negro").alias("toner_pct"),
                      S.fraction_to_pct("ui_negro").alias("ui_pct"))


def classify_status(spark, d):
    p = X.poll_raw(spark, d)
    inv = X.inventory_raw(spark, d).select("device_id", "device_class")
    j = p.join(inv, "device_id")
    rule = R._class_rule(F.col("device_class"), j)
    zero = (F.col("toner_negro") == "0%") & (F.col("ui_negro") == "0%")
    variants = ["v4", "v5", "v6", "v10_normal", "v7", "v8", "v10", "v11", "v11_copy", "v11_clx", "v13"]
    return j.select("device_id", "device_class", "outcome",
                    *[bands.classify_status("outcome", rule, zero, v).alias(f"status_{v}") for v in variants])


# ------------------------------------------------------------- merges
def _poll(spark, d, by_class=True, variant="v13"):
    return R.poll_results(X.poll_raw(spark, d), X.inventory_raw(spark, d), variant=variant, by_class=by_class)


def _joined(spark, d):
    inv = X.inventory_raw(spark, d).withColumn("ip", S.format_ip("ip"))
    return inv, M.merge_left(inv, _poll(spark, d), keys=["device_class", "ip"])


def merge_left(spark, d):
    return _joined(spark, d)[1]


def merge_bucketed(spark, d):
    """Inventory and polls stored in buckets first, then merged without an exchange."""
    tag, keys = uuid.uuid4().hex[:12], ["device_class", "ip"]
    inv = X.inventory_raw(spark, d).withColumn("ip", S.format_ip("ip"))
    stored = [B.write_bucketed(df, f"supplyscope_{n}_{tag}", scratch_path(spark, f"bucketed-{n}"), keys, 8)
              for n, df in (("inventory", inv), ("poll", _poll(spark, d)))]
    return B.merge_bucketed(*stored, keys)


def merge_fanout(spark, d):
    """Every poll row of a key, as the original joins them."""
    inv = X.inventory_raw(spark, d).withColumn("ip", S.format_ip("ip"))
    return M.merge_left(inv, _poll(spark, d), keys=["device_class", "ip"], allow_fanout=True)


def poll_no_key(spark, d):
    """Poll rows of an inventory in which some keys hold no digit: these devices are never polled."""
    return R.poll_results(X.poll_raw(spark, d), X.inventory_blank_keys(spark, d))


_MERGE_COLS = ["toner_negro", "ui_negro", "estado", "marca_de_tiempo"]


def merge_overwrite(spark, d):
    inv, j = _joined(spark, d)
    return M.merge_overwrite(j, inv.columns, _MERGE_COLS)


def merge_coalesce(spark, d):
    inv, j = _joined(spark, d)
    return M.merge_coalesce(j, inv.columns, _MERGE_COLS)


def merge_masked(spark, d):
    inv, j = _joined(spark, d)
    return M.merge_masked(j, inv.columns, ["toner_negro", "ui_negro"])


def merge_masked_clean(spark, d):
    inv, j = _joined(spark, d)
    return M.merge_masked_clean(j, inv.columns, ["toner_negro"], class_col=None, on_fail="")


def refresh_inventory(spark, d):
    return R.refresh_inventory(X.inventory_raw(spark, d), _poll(spark, d))


def refresh_inventory_mono(spark, d):
    return R.refresh_inventory_mono(X.inventory_raw(spark, d), _poll(spark, d, by_class=False, variant="v11"))


def refresh_inventory_color(spark, d):
    return R.refresh_inventory_color11(X.inventory_raw(spark, d), _poll(spark, d, by_class=False, variant="v8"))


def refresh_levels(spark, d):
    """Eight classes with all their levels, refreshed by polls of as many."""
    inv = reduce(DataFrame.unionByName, [V.conform(sheet.withColumn("device_class", F.lit(cls)), extras=None)
                                         for cls, _, sheet in X.class_sheets(spark, d)])
    return R.refresh_keyed(inv, X.class_polls(spark, d))


def refresh_one_class(spark, d):
    """The stored-table job for one class: its partition is replaced, its siblings stay."""
    inv, poll, out = (scratch_path(spark, n) for n in ("job-inventory", "job-poll", "job-out"))
    for path in (inv, out):
        T.write_class_tables(X.inventory_raw(spark, d), path)
    T.write_overwrite(_poll(spark, d), poll)
    J.refresh_job(spark, inv, poll, out, classes=["HP Admin"])
    for path in (inv, poll):
        drop_path(spark, path)
    return T.read_class_tables(spark, out)


def severity_counts(spark, d):
    return P.severity_counts(refresh_inventory(spark, d))


def severity_counts_below_5(spark, d):
    return P.severity_counts(refresh_inventory(spark, d), low_below=5)


def severity_counts_red(spark, d):
    return P.severity_counts(refresh_inventory(spark, d), low_below=None)


def refresh_new_level(spark, d):
    # A sheet without the toner column takes the polled level as a new one.
    return R.refresh_inventory(X.inventory_raw(spark, d).drop("toner_negro"), _poll(spark, d))


# ------------------------------------------------------------- history
def history_append(spark, d):
    return H.append_history(X.history_raw(spark, d), refresh_inventory(spark, d))


def clean_history(spark, d):
    return H.clean_history(X.history_raw(spark, d))


def dedupe_history(spark, d):
    return H.dedupe_first(X.history_raw(spark, d), ["ip", "marca_de_tiempo"])


def history_sorted(spark, d):
    return H.sort_history(clean_history(spark, d))


def group_name_latest(spark, d):
    c = clean_history(spark, d).filter(F.col("ip").isNotNull() & F.col("modelo").isNotNull())
    return c.groupBy("ip", "modelo").agg(F.max_by("nombre", F.struct("fecha", -F.col("seq"))).alias("nombre"))


# ------------------------------------------------------- series / windows
def _steps(spark, d):
    r = X.readings_long(spark, d).filter(F.col("ts").isNotNull() & F.col("pct").isNotNull())
    return step_table_split(r, READ_KEYS, ts="ts", tie="seq", val="pct")


def elapsed_days(spark, d):
    return _steps(spark, d).select("seq", *READ_KEYS, "days")


def delta_days(spark, d):
    return _steps(spark, d).select("seq", *READ_KEYS, "delta_days")


def delta_pct(spark, d):
    return _steps(spark, d).select("seq", *READ_KEYS, "delta_pct")


def step_rate(spark, d):
    return _steps(spark, d).select("seq", *READ_KEYS, "rate")


def ema_last(spark, d):
    s = _steps(spark, d)
    return s.groupBy(*READ_KEYS).agg(
        F.sum(F.when(F.col(STEP), 1).otherwise(0)).cast("bigint").alias("m"),
        S.round_to(F.sum(ema_weight() * F.col("rate")), 6).alias("ema"))


def ema_series_q(spark, d):
    s = ema_series(_steps(spark, d), READ_KEYS)
    return s.select("seq", *READ_KEYS, S.round_to("ema", 6).alias("ema"))


def regr_slope_supply(spark, d):
    s = _steps(spark, d)
    g = s.groupBy(*READ_KEYS).agg(F.count(F.lit(1)).alias("n"), F.regr_slope("pct", "days").alias("_s"))
    return g.select(*READ_KEYS, "n", F.when(F.col("n") >= 2, S.round_to(F.coalesce("_s", F.lit(0.0)), 6))
                    .alias("slope"))


def latest_level(spark, d):
    r = X.readings_long(spark, d)
    return r.groupBy(*READ_KEYS).agg(F.max("ts").alias("last_ts"),
                                     F.max_by("pct", F.struct("ts", "seq")).alias("pct"))


def simple_rate(spark, d):
    s = _steps(spark, d).filter(F.col("_rn") == F.col("_n"))
    return s.select(*READ_KEYS, F.when(F.col("delta_days") > 0, F.col("delta_pct") / F.col("delta_days"))
                    .alias("simple_rate"))


def _days_left(spark, d):
    s = _steps(spark, d)
    dl = F.when(F.col("rate") > 0, F.col("pct") / F.col("rate"))
    return s.select("seq", *READ_KEYS, "ts", dl.alias("_d"))


def alert_band(spark, d):
    s = _days_left(spark, d).withColumn("days_left", S.round_to("_d", 1))
    return s.select("seq", *READ_KEYS, "days_left", bands.alert_band("days_left").alias("alerta"))


def alert_band2(spark, d):
    s = _days_left(spark, d).withColumn("days_left", S.round_to("_d", 1))
    return s.select("seq", *READ_KEYS, "days_left", bands.alert_band2("days_left").alias("alerta"))


def project_date(spark, d):
    s = _days_left(spark, d)
    return s.select("seq", *READ_KEYS, S.round_to("_d", 1).alias("days_left"), S.add_days("ts", "_d").alias("fecha_fin"))


# ------------------------------------------------------------- forecasts
def forecast_ema_q(spark, d):
    return FJ.fleet_forecast_ema(X.history_raw(spark, d), alerts=False)


def forecast_ema_alerts(spark, d):
    return FJ.fleet_forecast_ema(X.history_raw(spark, d))


def forecast_blocked(spark, d):
    """The same with a small bound: devices above it go in blocks, the others in one exchange."""
    return FJ.fleet_forecast_ema(X.history_raw(spark, d), block_rows=66)


def forecast_ties(spark, d):
    """A log that is not deduped: readings of one instant, and pairs by position in the fallback."""
    return forecast_ema(H.clean_history(X.history_raw(spark, d), dedupe=False), mode="off", ties=True)


def forecast_report(spark, d):
    """The forecast in report order under its display names."""
    return J.with_display_names(order_forecast(FJ.fleet_forecast_ema(X.history_raw(spark, d))))


def forecast_incremental(spark, d):
    path = scratch_path(spark, "log-batches")
    paths = []
    for i, batch in enumerate(FJ.time_batches(X.history_raw(spark, d), 3)):
        paths.append(f"{path}-{i}")
        batch.write.parquet(paths[-1])
    out = FJ.incremental_forecast([T.read_history(spark, p) for p in paths])
    for p in paths:
        drop_path(spark, p)
    return out


def _date_text(df):
    """Dates as text: without a horizon they run past what client date types hold."""
    return df.withColumn("fecha_agotamiento", F.col("fecha_agotamiento").cast("string"))


def forecast_linear_q(spark, d):
    return _date_text(FJ.fleet_forecast_linear(X.history_raw(spark, d), alerts=False))


def forecast_linear_alerts(spark, d):
    return _date_text(FJ.fleet_forecast_linear(X.history_raw(spark, d)))


# ------------------------------------------------------------- streaming
def stream_dedupe(spark, d):
    return stream_dedupe_history(spark, d)


def stream_latest(spark, d):
    return stream_latest_levels(spark, d)


def stream_refresh(spark, d):
    """Poll rows land class by class, each class in two deliveries; a delivery is one trigger however
    many files it has, and rewrites its class only."""
    land, root, ck, all_polls = (scratch_path(spark, n) for n in ("landing-poll", "inventory", "ck-poll", "polls"))
    _poll(spark, d).write.parquet(all_polls)
    poll = spark.read.parquet(all_polls)
    store = ClassTable(spark, root)
    store.start(R.with_levels(X.inventory_raw(spark, d).withColumn("ip", S.format_ip("ip")), poll, K.supply_cols()))
    half = F.pmod(F.xxhash64("ip"), F.lit(2))
    for cls in sorted(r[0] for r in poll.select("device_class").distinct().collect()):      # the fixed classes
        for i in range(2):
            poll.filter((F.col("device_class") == cls) & (half == i)).write.mode("append").parquet(land)
            run_upserts(spark.readStream.schema(poll.schema).parquet(land), store, R.refresh_keyed, ck)
    store.vacuum(1)
    for path in (land, ck, all_polls):
        drop_path(spark, path)
    return store.read()


def queries() -> dict[str, Query]:
    return {
        "scan_inventory": scan_inventory,
        "scan_history": scan_history,
        "scan_all_classes": scan_all_classes,
        "scan_classes_evolved": scan_classes_evolved,
        "read_sheet_split": read_sheet_split,
        "history_since": history_since,
        "extract_gauges": extract_gauges,
        "extract_gauges_id": extract_gauges_id,
        "extract_gauges_toner_list": extract_gauges_toner_list,
        "extract_gauges_grid": extract_gauges_grid,
        "extract_gauges_row_id": extract_gauges_row_id,
        "gauges_to_supplies": gauges_to_supplies,
        "gauges_pivot": gauges_pivot,
        "trim_columns": trim_columns,
        "filter_valid_key": filter_valid_key,
        "filter_ok_trim": filter_ok_trim,
        "filter_ok_exact": filter_ok_exact,
        "stamp_run": stamp_run,
        "ip_to_url": ip_to_url,
        "parse_ts": parse_ts,
        "format_ip": format_ip,
        "format_ip_dots": format_ip_dots,
        "format_ip_zero": format_ip_zero,
        "normalize_ip": normalize_ip,
        "unpivot_supplies": unpivot_supplies_q,
        "clean_pct_blank": clean_pct_blank,
        "clean_pct_zero": clean_pct_zero,
        "clean_pct_float": clean_pct_float,
        "pct_to_double": pct_to_double,
        "fraction_to_pct": fraction_to_pct,
        "severity": severity,
        "classify_status": classify_status,
        "merge_left": merge_left,
        "merge_bucketed": merge_bucketed,
        "merge_fanout": merge_fanout,
        "poll_no_key": poll_no_key,
        "refresh_levels": refresh_levels,
        "refresh_one_class": refresh_one_class,
        "merge_overwrite": merge_overwrite,
        "merge_coalesce": merge_coalesce,
        "merge_masked": merge_masked,
        "merge_masked_clean": merge_masked_clean,
        "refresh_inventory": refresh_inventory,
        "refresh_inventory_mono": refresh_inventory_mono,
        "refresh_inventory_color": refresh_inventory_color,
        "severity_counts": severity_counts,
        "severity_counts_below_5": severity_counts_below_5,
        "severity_counts_red": severity_counts_red,
        "refresh_new_level": refresh_new_level,
        "history_append": history_append,
        "clean_history": clean_history,
        "dedupe_history": dedupe_history,
        "history_sorted": history_sorted,
        "group_name_latest": group_name_latest,
        "elapsed_days": elapsed_days,
        "delta_days": delta_days,
        "delta_pct": delta_pct,
        "step_rate": step_rate,
        "ema_last": ema_last,
        "ema_series": ema_series_q,
        "regr_slope_supply": regr_slope_supply,
        "latest_level": latest_level,
        "simple_rate": simple_rate,
        "alert_band": alert_band,
        "alert_band2": alert_band2,
        "project_date": project_date,
        "forecast_ema": forecast_ema_q,
        "forecast_ema_alerts": forecast_ema_alerts,
        "forecast_blocked": forecast_blocked,
        "forecast_ties": forecast_ties,
        "forecast_report": forecast_report,
        "forecast_incremental": forecast_incremental,
        "forecast_linear": forecast_linear_q,
        "forecast_linear_alerts": forecast_linear_alerts,
        "stream_dedupe": stream_dedupe,
        "stream_dedupe_ordered": stream_dedupe_ordered,
        "stream_latest": stream_latest,
        "stream_refresh": stream_refresh,
    }
