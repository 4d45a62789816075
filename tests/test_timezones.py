"""Results must not depend on the session time zone (NTZ wall clock)."""

import datetime as dt

from pyspark.sql import functions as F

from supplyscope.functions import scalars as S
from supplyscope.operators.forecast import forecast_ema, forecast_linear

LOG = ("seq long, nombre string, ip string, modelo string, toner_negro double, toner_cian double, "
       "toner_magenta double, toner_amarillo double, kit_mant double, kit_alim double, fecha timestamp_ntz")


def _with_zone(spark, zone, fn):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        return fn()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_stamp_in_dst_gap_keeps_wall_time(spark):
    df = spark.createDataFrame([("2024-03-31 02:30:00",), ("2024-02-30 10:00:00",)], "t string")
    got = _with_zone(spark, "Europe/Madrid", lambda: [r[0] for r in df.select(S.parse_ts("t")).collect()])
    assert got == [dt.datetime(2024, 3, 31, 2, 30), None]


def test_forecast_across_dst_change_is_zone_independent(spark):
    base = dt.datetime(2024, 3, 29, 12, 0)
    rows = [(i + 1, "n", "a", "M", lvl, None, None, None, None, None, base + dt.timedelta(days=i))
            for i, lvl in enumerate([90.0, 80.0, 72.0, 61.0, 55.0])]
    df = spark.createDataFrame(rows, LOG)

    def run():
        e = [tuple(r) for r in forecast_ema(df, mode="off").collect()]
        lin = [tuple(r) for r in forecast_linear(df.select(*[F.col(c).cast("string") if c.startswith(("toner", "kit"))
                                                             else F.col(c) for c in df.columns]),
                                                 mode="off").collect()]
        d = [r[0] for r in df.select(S.elapsed_micros(F.lit("2024-03-29 12:00:00").cast("timestamp_ntz"), "fecha")).collect()]
        return e, lin, d

    utc = _with_zone(spark, "UTC", run)
    madrid = _with_zone(spark, "Europe/Madrid", run)
    assert utc == madrid
    assert utc[2] == [i * 86400 * 10**6 for i in range(5)]      # whole days across the change


def test_key_queries_match_oracle_under_other_session_settings(spark):
    """ANSI off and a DST zone must not change any result."""
    import duckdb

    import __spark_entry__ as E

    from .conftest import SF_SMALL
    from .test_oracle import TABLES, _norm

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    names = ["forecast_ema_alerts", "forecast_linear_alerts", "clean_pct_blank", "fraction_to_pct",
             "refresh_inventory", "project_date", "parse_ts", "gauges_to_supplies"]
    old = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.session.timeZone")}
    spark.conf.set("spark.sql.ansi.enabled", "false")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        for name in names:
            df = E.queries()[name](spark, SF_SMALL)
            cols = sorted(df.columns)
            got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
            cur = con.execute(E.oracle_sql()[name])
            ocols = [d[0] for d in cur.description]
            want = sorted((tuple(_norm(r[ocols.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)
            assert got == want, name
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
