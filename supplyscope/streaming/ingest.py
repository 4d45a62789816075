"""Structured Streaming forms of the history log.

The fleet tool re-runs a batch by hand; its append-only log with one stamp
per run maps onto a file stream: readings land as Parquet files, a streaming
query dedupes them on (ip, reading time) inside a watermark and appends to
the log, and a second query keeps the latest level per device and supply.

Watermark rule (new semantics, not in the original): a reading whose time is
more than ``late`` older than the newest time seen in an earlier trigger is
dropped as late; duplicates are only recognised within that window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyscope.functions.bands import level_severity
from supplyscope.functions.scalars import parse_ts
from supplyscope.operators.history import dedupe_first, filter_status
from supplyscope.session import drop_path, scratch_path
from supplyscope.sources import fixtures as X

LOG_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("nombre", T.StringType()),
    T.StructField("ip", T.StringType()), T.StructField("modelo", T.StringType()),
    T.StructField("toner_negro", T.StringType()), T.StructField("toner_cian", T.StringType()),
    T.StructField("toner_magenta", T.StringType()), T.StructField("toner_amarillo", T.StringType()),
    T.StructField("kit_mant", T.StringType()), T.StructField("kit_alim", T.StringType()),
    T.StructField("estado", T.StringType()), T.StructField("marca_de_tiempo", T.StringType()),
])

READING_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("device", T.LongType()),
    T.StructField("supply", T.StringType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("pct", T.DoubleType()),
])


def valid_stream(stream: DataFrame) -> DataFrame:
    """Rows with a valid status, as the batch clean takes them, with their reading time."""
    return filter_status(stream, strip=True).withColumn("fecha", parse_ts("marca_de_tiempo"))


def unparsed_stream(stream: DataFrame) -> DataFrame:
    """The side path: valid rows whose stamp is no time. They cannot be watermarked,
    so they are appended as they come and deduped when the log is read."""
    return valid_stream(stream).filter(F.col("fecha").isNull())


def dedupe_stream(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """Readings -> first valid arrival of each (ip, reading time) within the watermark.

    The status filter comes first: a failed poll never hides a good one. Rows
    later than the watermark are dropped, and a backlog is not in time order:
    a backfill over several triggers belongs to the batch
    :func:`supplyscope.operators.history.clean_history`.
    """
    s = valid_stream(stream).filter(F.col("fecha").isNotNull())
    # Event-time watermarks need TIMESTAMP (session zone); the stored
    # reading time stays TIMESTAMP_NTZ.
    s = s.withColumn("_event_time", F.col("fecha").cast("timestamp"))
    d = s.withWatermark("_event_time", late).dropDuplicatesWithinWatermark(["ip", "marca_de_tiempo"])
    return d.drop("_event_time")


def latest_stream(stream: DataFrame) -> DataFrame:
    """Readings -> latest level and its severity per (device, supply), a
    complete-mode table (state: one row per series)."""
    latest = stream.groupBy("device", "supply").agg(
        F.max("ts").alias("last_ts"),
        F.max_by("pct", F.struct("ts", "seq")).alias("pct"),
        F.count(F.lit(1)).alias("n"))
    return latest.withColumn("severity", level_severity("pct"))


def run_append(df: DataFrame, out: str, checkpoint: str) -> None:
    """Drain every available file into an append-mode Parquet sink."""
    q = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
    q.awaitTermination()


def run_complete(df: DataFrame, out: str, checkpoint: str) -> None:
    """Drain every available file; each trigger rewrites the full table."""
    def sink(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    q = (df.writeStream.outputMode("complete").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def run_updates(df: DataFrame, out: str, checkpoint: str) -> None:
    """Drain every available file; each trigger writes the series it changed, and only these,
    into ``out/epoch=<batch id>``, so a repeated batch replaces itself."""
    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    q = (df.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_updated(spark: SparkSession, out: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The newest row of every key among the triggers' folders: one grouped pass, partial aggregates first."""
    stored = T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])
    rest = [F.col(c) for c in schema.names if c not in keys]
    newest = (spark.read.schema(stored).parquet(out).groupBy(*keys)
              .agg(F.max_by(F.struct(*rest), "epoch").alias("_row")))
    return newest.select(*keys, "_row.*").select(*schema.names)


def compact_updates(spark: SparkSession, out: str, schema: T.StructType, keys: list[str], epoch: int) -> str:
    """Write the newest rows as one folder of a new ``out`` (returned), as of ``epoch``; the
    stream goes on there with its own later epochs."""
    to = scratch_path(spark, "latest-compact")
    read_updated(spark, out, schema, keys).write.parquet(f"{to}/epoch={epoch}")
    return to


def stream_dedupe_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the raw log as files, stream it through the dedupe, read the sink."""
    land, out, ck = (scratch_path(spark, n) for n in ("landing-log", "log", "ck-log"))
    X.history_raw(spark, sf_dir).write.parquet(land)
    stream = spark.readStream.schema(LOG_SCHEMA).parquet(land)
    run_append(dedupe_stream(stream), out, ck)
    side, side_ck = (scratch_path(spark, n) for n in ("log-unparsed", "ck-log-unparsed"))
    run_append(unparsed_stream(stream), side, side_ck)
    for path in (land, ck, side_ck):
        drop_path(spark, path)
    rest = dedupe_first(spark.read.schema(unparsed_stream(stream).schema).parquet(side), ["ip", "marca_de_tiempo"], tie="seq")
    names = ["ip", "marca_de_tiempo", "fecha"]
    return spark.read.parquet(out).select(*names).unionByName(rest.select(*names))


def stream_latest_levels(spark: SparkSession, sf_dir: str, files: int = 4) -> DataFrame:
    """Readings land in several files, one a trigger; each trigger writes the series it changed."""
    land, out, ck = (scratch_path(spark, n) for n in ("landing-readings", "latest", "ck-latest"))
    X.readings_long(spark, sf_dir).repartition(files, F.xxhash64("seq")).write.parquet(land)
    stream = latest_stream(spark.readStream.schema(READING_SCHEMA).option("maxFilesPerTrigger", 1).parquet(land))
    run_updates(stream, out, ck)
    for path in (land, ck):
        drop_path(spark, path)
    return read_updated(spark, out, stream.schema, ["device", "supply"])
