"""Class sheets with columns of their own under one declared target."""

import pytest
from pyspark.sql import functions as F

from supplyscope import config as K
from supplyscope.session import scratch_path
from supplyscope.sources import evolved as V


def test_conform_finds_casts_adds_and_keeps(spark):
    df = spark.createDataFrame([(7, "a", 85.0, "x", None), (8, "b", None, None, None)],
                               "device_id int, ` IP ` string, `Toner Negro` double, contador string, nota string")
    rows = {r.device_id: r for r in V.conform(df).collect()}
    assert list(rows[7].__fields__) == [*V.TARGET.names, "otros"]
    assert (rows[7].ip, rows[7].toner_negro, rows[7].otros) == ("a", "85.0", '{"contador":"x"}')
    assert rows[8].toner_negro is None and rows[8].otros is None and rows[8].kit_mant is None
    assert dict(V.conform(df, extras=None).dtypes)["device_id"] == "bigint"


def test_what_cannot_be_cast_is_null(spark):
    df = spark.createDataFrame([("x1", "a"), ("12", "b")], "device_id string, ip string")
    assert [r.device_id for r in V.conform(df).orderBy("ip").collect()] == [None, 12]


def test_two_headers_of_one_column(spark):
    df = spark.createDataFrame([("a", None, "5%"), ("b", "6%", "7%")], "ip string, toner_negro string, `Toner Negro` string")
    assert [r.toner_negro for r in V.conform(df).orderBy("ip").collect()] == ["5%", "6%"]


def test_files_and_generations_that_differ(spark):
    path = scratch_path(spark, "ev")
    V.write_class(spark.createDataFrame([("a", "1%")], "ip string, toner_negro string"), path, "HP Admin")
    V.write_class(spark.createDataFrame([("b", "2%", "3%")], "ip string, toner_negro string, kit_mant string"), path, "HP Admin")
    V.write_class(spark.createDataFrame([("c", 4.5)], "ip string, toner_negro double"), path, "HP Planta", 1)
    V.write_class(spark.createDataFrame([("d", "5%")], "ip string, toner_negro string"), path, "HP Planta", 2)
    V.write_class(spark.createDataFrame([], "ip string"), path, "Color/100%")
    got = {r.ip: (r.device_class, r.toner_negro, r.kit_mant) for r in V.read_evolved(spark, path).collect()}
    assert got == {"a": ("HP Admin", "1%", None), "b": ("HP Admin", "2%", "3%"), "c": ("HP Planta", "4.5", None),
                   "d": ("HP Planta", "5%", None)}
    only = V.read_evolved(spark, path, ["HP Planta"])
    assert {r.ip for r in only.collect()} == {"c", "d"} and all("HP%20Planta" in f or "HP Planta" in f for f in only.inputFiles())
    assert V.read_evolved(spark, path, ["Another"]).columns == [*V.TARGET.names, "otros"]


def test_a_class_filter_drops_the_other_folders(spark):
    path = scratch_path(spark, "ev-f")
    for c in ("HP Admin", "HP Planta"):
        V.write_class(spark.createDataFrame([(c[:4], "1%")], "ip string, toner_negro string"), path, c)
    plan = V.read_evolved(spark, path).filter(F.col("device_class") == "HP Admin")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_a_folder_without_keys_is_named(spark):
    path = scratch_path(spark, "ev-bad")
    V.write_class(spark.createDataFrame([(1,)], "x long"), path, "HP Admin")
    with pytest.raises(ValueError, match="HP Admin"):
        V.read_evolved(spark, path)


def test_target_has_every_class_level():
    for cls in K.GAUGE_MAP:
        assert set(V.class_levels(cls)) <= set(V.TARGET.names)
