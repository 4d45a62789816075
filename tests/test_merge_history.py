"""Merge contracts, refresh and history append on hand-made tables."""

from pyspark.sql import functions as F

from supplyscope.operators import history as H
from supplyscope.operators import merge as M
from supplyscope.plans import refresh as R

INV = "device_id long, nombre string, device_class string, ip string, modelo string, toner_negro string, " \
      "estado string, marca_de_tiempo string"
POLL = "device_class string, ip string, seq long, toner_negro string, estado string, marca_de_tiempo string"


def _inv(spark):
    return spark.createDataFrame([
        (1, "a", "HP Admin", "10.0.0.1", "M", "50%", "OK", "t0"),        # unmatched
        (2, "b", "HP Admin", "10.0.0.2", "M", "40%", "OK", "t0"),        # failed poll keeps level
        (3, "c", "HP Admin", "10.0.0.3", "M", None, None, None),         # OK poll, bad text
        (4, "d", "Color Admin", "10.0.0.4", "M", "30%", "OK", "t0"),     # colour class, bad text
        (5, "e", "HP Admin", None, "M", "20%", "OK", "t0"),              # no key
        (6, "f", "HP Admin", "10.0.0.6", "M", "10%", "OK", "t0"),        # duplicate poll rows
    ], INV)


def _poll(spark):
    return spark.createDataFrame([
        ("HP Admin", "10.0.0.2", 2, "", "Fuera de Red", "t1"),
        ("HP Admin", "10.0.0.3", 3, "--", "OK", "t1"),
        ("Color Admin", "10.0.0.4", 4, "x", "OK", "t1"),
        ("HP Admin", "10.0.0.6", 7, "77.5%", "OK", "t1"),
        ("HP Admin", "10.0.0.6", 6, "66.5%", "OK", "t1"),
    ], POLL)


def _by_id(df):
    return {r["device_id"]: r for r in df.collect()}


def test_merge_left_keeps_row_count_and_dedupes_poll(spark):
    j = M.merge_left(_inv(spark), _poll(spark), keys=["device_class", "ip"])
    assert j.count() == 6
    assert _by_id(j)[6]["toner_negro_new"] == "66.5%"     # smallest seq wins
    fan = M.merge_left(_inv(spark), _poll(spark), keys=["device_class", "ip"], allow_fanout=True)
    assert fan.count() == 7


def test_merge_contracts(spark):
    inv = _inv(spark)
    j = M.merge_left(inv, _poll(spark), keys=["device_class", "ip"])
    over = _by_id(M.merge_overwrite(j, inv.columns, ["toner_negro", "estado"]))
    assert over[1]["toner_negro"] is None and over[2]["toner_negro"] == ""
    coal = _by_id(M.merge_coalesce(j, inv.columns, ["toner_negro", "estado"]))
    assert coal[1]["toner_negro"] == "50%" and coal[2]["toner_negro"] == "" and coal[2]["estado"] == "Fuera de Red"
    mask = _by_id(M.merge_masked(j, inv.columns, ["toner_negro"]))
    assert mask[2]["toner_negro"] == "40%" and mask[2]["estado"] == "Fuera de Red"
    assert mask[3]["toner_negro"] == "--" and mask[6]["toner_negro"] == "66.5%"
    assert mask[1]["marca_de_tiempo"] == "t0" and mask[6]["marca_de_tiempo"] == "t1"


def test_merge_masked_clean_by_class(spark):
    inv = _inv(spark)
    j = M.merge_left(inv, _poll(spark), keys=["device_class", "ip"])
    out = _by_id(M.merge_masked_clean(j, inv.columns, ["toner_negro"]))
    assert out[1]["toner_negro"] == "50%"
    assert out[2]["toner_negro"] == "40%"
    assert out[3]["toner_negro"] == "" and out[3]["estado"] == "OK"          # mono class: ''
    assert out[4]["toner_negro"] == "0%"                                      # colour class: '0%'
    assert out[5]["toner_negro"] == "20%" and out[5]["ip"] is None
    assert out[6]["toner_negro"] == "66%"                                     # 66.5 -> half even


def test_refresh_inventory_normalises_keys(spark):
    inv = spark.createDataFrame([(1, "a", "HP Admin", " 192 168 111 216 ", "M", "5%", "OK", "t0"),
                                 (2, "b", "HP Admin", "  ", "M", "6%", "OK", "t0")], INV)
    poll = spark.createDataFrame([("HP Admin", "192.168.111.216", 1, "12.5 %", "OK", "t1")], POLL)
    out = _by_id(R.refresh_inventory(inv, poll))
    assert out[1]["ip"] == "192.168.111.216" and out[1]["toner_negro"] == "12%"
    assert out[2]["ip"] is None and out[2]["toner_negro"] == "6%"


def test_require_columns(spark):
    import pytest
    with pytest.raises(KeyError):
        M.merge_left(_inv(spark).drop("ip"), _poll(spark), keys=["ip"])


LOG = "seq long, nombre string, ip string, modelo string, toner_negro string, estado string, " \
      "marca_de_tiempo string"


def test_history_append_rules(spark):
    batch = _inv(spark)
    new_only = H.append_history(None, batch)
    assert new_only.columns == ["nombre", "ip", "modelo", "toner_negro", "estado", "marca_de_tiempo"]
    old = spark.createDataFrame([(1, "x", "1.1.1.1", "M", "5%", "OK", "t")], LOG).drop("toner_negro") \
        .withColumn("kit_mant", F.lit("9%"))
    out = H.append_history(old, batch)
    rows = out.collect()
    assert len(rows) == 7
    assert rows[0]["toner_negro"] == ""            # missing in the old log -> ''
    assert rows[1]["kit_mant"] is None             # missing in the batch -> NULL
    assert rows[1]["seq"] is None


def test_clean_history_dedupes_first_logged(spark):
    raw = spark.createDataFrame([
        (1, "a", "ip1", "M", "50%", " OK ", "2024-01-01 00:00:00"),
        (2, "b", "ip1", "M", "60%", "OK", "2024-01-01 00:00:00"),
        (3, "c", "ip1", "M", "--", "OK", "2024-01-02 00:00:00"),
        (4, "d", "ip1", "M", "70%", "Fuera de Red", "2024-01-03 00:00:00"),
        (5, "e", None, "M", "1%", "OK", "bad"),
        (6, "f", None, "M", "2%", "OK", "bad"),
    ], LOG)
    c = H.clean_history(raw).orderBy("seq").collect()
    assert [r["seq"] for r in c] == [1, 3, 5]
    assert c[0]["toner_negro"] == 50.0 and c[1]["toner_negro"] is None and c[2]["fecha"] is None
    exact = H.clean_history(raw, strip_status=False).orderBy("seq").collect()
    assert [r["seq"] for r in exact] == [2, 3, 5]


def test_append_empty_batch_keeps_the_log(spark):
    old = spark.createDataFrame([(1, "x", "1.1.1.1", "M", "5%", "OK", "t")], LOG)
    out = H.append_history(old, _inv(spark).limit(0))
    assert out.count() == 1 and out.columns == old.columns


def test_poll_without_a_level_column(spark):
    inv = _inv(spark).withColumn("toner_cian", F.lit("33%"))
    poll = _poll(spark)                                   # no toner_cian column at all
    j = M.merge_left(inv, poll, keys=["device_class", "ip"])
    out = _by_id(M.merge_masked_clean(j, inv.columns, ["toner_negro", "toner_cian"], class_col=None,
                                      on_fail="0%"))
    assert out[6]["toner_cian"] == "0%"                    # OK poll, no value: the class failure value
    assert out[2]["toner_cian"] == "33%"                   # failed poll keeps the old level


def test_refresh_color11_keeps_old_nulls_and_cleans_poll_text(spark):
    inv = spark.createDataFrame([(1, "a", "x", "10.0.0.1", "M", None, "OK", "t0"),
                                 (2, "b", "x", "10.0.0.2", "M", None, "OK", "t0")], INV) \
        .withColumn("ui_negro", F.lit(None).cast("string"))
    poll = spark.createDataFrame([("10001", 1, "55.5 %", "0.5", "OK", "t1"),
                                  ("10002", 2, "", "", "Fuera de Red", "t1")],
                                 "ip string, seq long, toner_negro string, ui_negro string, estado string, "
                                 "marca_de_tiempo string")
    out = _by_id(R.refresh_inventory_color11(inv, poll))
    assert (out[1]["toner_negro"], out[1]["ui_negro"], out[1]["estado"]) == ("56%", "0%", "OK")
    assert out[2]["toner_negro"] is None and out[2]["estado"] == "Fuera de Red"


def test_null_keys_stay_out_of_the_join(spark):
    """Rows without a key keep their values, and match no poll row without one."""
    poll = _poll(spark).unionByName(spark.createDataFrame([("HP Admin", None, 9, "1%", "OK", "t9")], POLL))
    j = M.merge_left(_inv(spark), poll, keys=["device_class", "ip"])
    assert j.count() == 6
    row = j.filter("device_id = 5").first()
    assert row.toner_negro == "20%" and row.toner_negro_new is None and row.estado_new is None
    plan = j._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 1 and "xxhash64" in plan and "_salt" not in j.columns      # the union is the polls' own
    again = M.merge_left(_inv(spark), poll, keys=["device_class", "ip"], allow_fanout=True)
    assert again.filter("device_id = 5").count() == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_inventory_is_read_once(spark):
    from supplyscope.session import scratch_path

    path = scratch_path(spark, "t-once")
    _inv(spark).write.parquet(f"{path}/inv")
    _poll(spark).write.parquet(f"{path}/poll")
    inv, poll = spark.read.parquet(f"{path}/inv"), spark.read.parquet(f"{path}/poll").hint("merge")
    plan = _plan(M.merge_left(inv, poll, keys=["device_class", "ip"]))
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 2      # one a side; the poll's serves dedupe and join


def test_keyless_rows_are_spread(spark):
    """A third of the inventory without a key, and as many rows of one key: neither salt changes what a row gets."""
    inv = spark.range(3000).selectExpr("id AS device_id", "'n' AS nombre", "'HP Admin' AS device_class",
                                       "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 'hot' ELSE concat('d', id) END AS ip",
                                       "'M' AS modelo", "'5%' AS toner_negro", "'OK' AS estado", "'t0' AS marca_de_tiempo")
    salts = M.salted(inv, ["device_class", "ip"]).groupBy("ip").agg(F.countDistinct(M.SALT).alias("n"))
    by = {r.ip: r.n for r in salts.collect()}
    assert by[None] == 1000 and by["hot"] == 1 and by["d2"] == 1
    poll = spark.createDataFrame([("HP Admin", "hot", 1, "7%", "OK", "t1"), ("HP Admin", None, 2, "8%", "OK", "t1"),
                                  (None, "hot", 3, "9%", "OK", "t1")], POLL)
    got = M.merge_left(inv, poll, keys=["device_class", "ip"]).groupBy("ip", "toner_negro_new").count().collect()
    assert sum(r["count"] for r in got) == 3000
    assert {(r.ip, r.toner_negro_new): r["count"] for r in got if r.toner_negro_new or r.ip is None} == {("hot", "7%"): 1000, (None, None): 1000}


def test_bucketed_tables_join_without_a_shuffle(spark):
    from supplyscope.session import scratch_path
    from supplyscope.sources import buckets as B

    keys, inv, poll = ["device_class", "ip"], _inv(spark), _poll(spark).unionByName(
        spark.createDataFrame([("HP Admin", None, 9, "1%", "OK", "t9")], POLL))
    stored = [B.write_bucketed(df, f"t_bucketed_{n}", scratch_path(spark, f"b-{n}"), keys, 4) for n, df in (("inv", inv), ("poll", poll))]
    try:
        j = B.merge_bucketed(*stored, keys)
        plan = _plan(j)
        assert "Exchange" not in plan and "SortMergeJoin" in plan and plan.count("Bucketed: true") == 2
        want = M.merge_left(inv, poll, keys=keys)
        assert sorted(map(str, j.collect())) == sorted(map(str, want.select(j.columns).collect()))
        again = R.refresh_keyed(stored[0].drop(M.SALT), poll)
        assert again.count() == 6
    finally:
        for n in ("inv", "poll"):
            B.drop_table(spark, f"t_bucketed_{n}")


def test_bucketed_empty_tables(spark):
    from supplyscope.session import scratch_path
    from supplyscope.sources import buckets as B

    stored = [B.write_bucketed(df.limit(0), f"t_empty_{n}", scratch_path(spark, f"e-{n}"), ["device_class", "ip"], 4)
              for n, df in (("inv", _inv(spark)), ("poll", _poll(spark)))]
    assert B.merge_bucketed(*stored, ["device_class", "ip"]).collect() == []
    for n in ("inv", "poll"):
        B.drop_table(spark, f"t_empty_{n}")
