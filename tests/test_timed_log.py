"""A log laid out by time: a period opens few files and few row groups."""

import datetime as dt

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from supplyscope.session import scratch_path
from supplyscope.sources import timed_log as L

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "seq long, ip string, marca_de_tiempo string"


def rows(spark, n, hours=1, first=0):
    """One reading an hour, in no order; every 50th stamp is no time."""
    return spark.range(first, first + n).select(
        F.col("id").alias("seq"), F.concat(F.lit("d"), F.col("id") % 7).alias("ip"),
        F.when(F.col("id") % 50 == 49, F.lit("soon")).otherwise(
            F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 3600 * hours), "yyyy-MM-dd HH:mm:ss"))
        .alias("marca_de_tiempo")).repartition(5, F.xxhash64("id"))


def log(spark):
    path = scratch_path(spark, "timed")
    for b in range(3):
        assert L.append_timed(rows(spark, 2000, first=b * 2000), path, file_rows=250) == 2000
    return path


def test_a_period_opens_few_files(spark):
    path, schema = log(spark), rows(spark, 1).schema
    since, until = T0 + dt.timedelta(hours=2500), T0 + dt.timedelta(hours=2600)
    every = L.index_of(spark, path).count()
    got = L.read_between(spark, path, schema, since, until)
    assert every >= 20 and len(got.inputFiles()) <= 3
    want = {i for i in range(2500, 2600) if i % 50 != 49}
    assert {r.seq for r in got.collect()} == want and got.count() == len(want)


def test_row_groups_are_skipped_by_their_footers(spark):
    path = scratch_path(spark, "timed-rg")
    L.append_timed(rows(spark, 60_000), path, file_rows=60_000, row_group_bytes=64 * 1024)
    (file,) = [r.file for r in L.index_of(spark, path).collect()]
    meta = pq.ParquetFile(file.removeprefix("file:").replace("//", "/")).metadata
    at = meta.schema.names.index("fecha") if hasattr(meta.schema, "names") else 3
    since = dt.datetime(2024, 1, 1) + dt.timedelta(hours=40_000)
    span = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
    hit = [s for s in span if s is not None and s.has_min_max and s.max >= since]
    assert meta.num_row_groups > 3 and 0 < len(hit) < meta.num_row_groups
    got = L.read_between(spark, path, rows(spark, 1).schema, since)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(fecha" in plan
    assert got.count() == sum(1 for i in range(40_000, 60_000) if i % 50 != 49)


def test_open_ends_and_untimed_rows(spark):
    path, schema = log(spark), rows(spark, 1).schema
    assert L.read_between(spark, path, schema).count() == 6000 - 120
    assert L.read_untimed(spark, path, schema).count() == 120
    assert L.read_between(spark, path, schema, until=T0).count() == 0
    assert L.read_between(spark, path, schema, since=dt.datetime(2030, 1, 1)).collect() == []
    edge = L.read_between(spark, path, schema, T0, T0 + dt.timedelta(hours=1)).collect()
    assert [r.seq for r in edge] == [0]                                   # since is in, until is out


def test_one_instant_on_a_third_of_the_rows(spark):
    path = scratch_path(spark, "timed-hot")
    df = rows(spark, 900).withColumn("marca_de_tiempo", F.when(F.col("seq") % 3 == 0, "2024-01-05 00:00:00").otherwise(F.col("marca_de_tiempo")))
    L.append_timed(df, path, file_rows=100)
    assert L.index_of(spark, path).agg(F.max("rows")).first()[0] <= 300
    at = dt.datetime(2024, 1, 5)
    assert L.read_between(spark, path, df.schema, at, at + dt.timedelta(seconds=1)).count() == df.filter(
        "marca_de_tiempo = '2024-01-05 00:00:00'").count()


def test_a_batch_without_its_index_is_not_seen(spark):
    path, schema = log(spark), rows(spark, 1).schema
    rows(spark, 10, first=9000).withColumn("fecha", F.lit(None).cast("timestamp_ntz")).write.parquet(f"{path}/data/half")
    assert L.read_between(spark, path, schema).count() + L.read_untimed(spark, path, schema).count() == 6000


def test_empty_batch(spark):
    path = scratch_path(spark, "timed-empty")
    assert L.append_timed(rows(spark, 0), path) == 0
    assert L.read_between(spark, path, rows(spark, 1).schema).collect() == []
