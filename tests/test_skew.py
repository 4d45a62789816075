"""A device holding a third of all readings must not land in one task."""

from pyspark.sql import functions as F

from supplyscope import config as K
from supplyscope.operators.sequencing import BLOCK, order_series
from supplyscope.operators.series import step_table
from supplyscope.sources import fixtures as X



def _skewed(spark):
    r = X.readings_long(spark, "/root/testdata/sf0.01")
    # every third reading is re-assigned to one hot device/supply series
    return r.withColumn("device", F.when(F.col("seq") % 3 == 0, F.lit(-1)).otherwise(F.col("device"))) \
            .withColumn("supply", F.when(F.col("seq") % 3 == 0, F.lit("click")).otherwise(F.col("supply")))


def test_hot_series_is_split_into_bounded_blocks(spark):
    df = _skewed(spark)
    total = df.count()
    hot = df.filter(F.col("device") == -1).count()
    assert hot * 3 >= total - 3
    block_rows = 500
    spark.conf.set(K.SERIES_BLOCK_ROWS_CONF, str(block_rows))
    try:
        seq, plan = order_series(df, ["device", "supply"], ["ts", "seq"], carry=["ts", "pct"])
        assert plan.blocked
        per_block = seq.groupBy(BLOCK).count().agg(F.max("count")).first()[0]
        assert per_block <= 3 * block_rows < hot
        # positions are global and gap-free within the hot series
        rn = seq.filter(F.col("device") == -1).agg(F.min("_rn"), F.max("_rn"), F.countDistinct("_rn")).first()
        assert tuple(rn) == (1, hot, hot)
    finally:
        spark.conf.unset(K.SERIES_BLOCK_ROWS_CONF)


def test_hot_series_steps_equal_plain(spark):
    df = _skewed(spark)
    cols = ["seq", "days", "delta_days", "delta_pct", "rate", "_cum__step", "_tot__step", "_rn", "_n"]
    plain = {r.seq: tuple(r) for r in step_table(df, ["device", "supply"], mode="off")[0].select(*cols).collect()}
    spark.conf.set(K.SERIES_BLOCK_ROWS_CONF, "500")
    try:
        blocked = {r.seq: tuple(r) for r in step_table(df, ["device", "supply"])[0].select(*cols).collect()}
    finally:
        spark.conf.unset(K.SERIES_BLOCK_ROWS_CONF)
    assert blocked == plain


def test_only_the_hot_device_takes_the_blocked_path(spark):
    from supplyscope.operators import history as H
    from supplyscope.operators.forecast import forecast_ema
    from supplyscope.plans.forecast_jobs import fleet_forecast_ema, split_hot_devices

    raw = X.history_raw(spark, "/root/testdata/sf0.01")
    hot_ip = "192.168.100.0"
    skewed = raw.withColumn("ip", F.when(F.col("seq") % 3 == 0, F.lit(hot_ip)).otherwise(F.col("ip")))
    hot, cold = split_hot_devices(skewed, 1000, strip_status=True)
    assert [r.ip for r in hot.select("ip").distinct().collect()] == [hot_ip]
    assert cold.filter(F.col("ip") == hot_ip).count() == 0
    assert hot.count() + cold.count() == skewed.count()

    plain = {tuple(r) for r in forecast_ema(H.clean_history(skewed), mode="off").collect()}
    spark.conf.set(K.SERIES_BLOCK_ROWS_CONF, "1000")
    try:
        split = {tuple(r) for r in fleet_forecast_ema(skewed, alerts=False).collect()}
    finally:
        spark.conf.unset(K.SERIES_BLOCK_ROWS_CONF)
    assert split == plain


def test_step_table_split_equals_plain(spark):
    from supplyscope.operators.series import step_table_split

    df = _skewed(spark)
    cols = ["seq", "days", "delta_days", "delta_pct", "rate", "_cum__step", "_tot__step", "_rn", "_n"]
    plain = {r.seq: tuple(r) for r in step_table(df, ["device", "supply"], mode="off")[0].select(*cols).collect()}
    split = {r.seq: tuple(r) for r in step_table_split(df, ["device", "supply"], block_rows=500)
             .select(*cols).collect()}
    assert split == plain


def test_fanout_of_a_hot_key_is_cut_into_blocks(spark, monkeypatch):
    from collections import Counter

    from supplyscope.operators import merge as M

    monkeypatch.setattr(M, "FANOUT_BLOCK", 20)
    ip = F.when(F.col("id") < 150, "hot").when(F.col("id") < 160, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") % 30).cast("string")))
    inv = spark.range(250).select(F.col("id").alias("device_id"), ip.alias("ip"), F.lit("10%").alias("toner"))
    poll = spark.range(40, 220).select(ip.alias("ip"), F.col("id").alias("seq"), F.col("id").cast("string").alias("toner"))
    got = M.merge_left(inv, poll, allow_fanout=True)
    assert got.columns == ["ip", "device_id", "toner", "toner_new"]
    polls = poll.select("ip", F.col("toner").alias("toner_new"))
    want = inv.join(polls, "ip", "left").select(got.columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    blocked = M._blocked(M.salted(inv, ["ip"]), M.salted(poll, ["ip"]).filter("ip is not null"), ["ip", M.SALT])
    for side, replicas in zip(blocked[:2], (6, 8)):                 # 110 polls make 6 blocks, 150 devices 8
        hot = side.filter("ip = 'hot'").groupBy(M._INV_BLOCK, M._POLL_BLOCK).count().collect()
        assert max(r["count"] for r in hot) < 60
        assert sum(r["count"] for r in hot) == replicas * side.filter("ip = 'hot'").select("device_id" if "device_id" in side.columns else "seq").distinct().count()
