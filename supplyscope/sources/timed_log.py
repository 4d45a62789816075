"""A history log laid out by reading time, so that a question about a period reads that period.

Each appended batch is dealt to files by ranges of its time (any number of
tasks, cut points from a sample) and sorted within them; rows whose stamp is
no time lie together at the start. Inside a file the row groups carry the
smallest and largest time in their footers, which Parquet checks before it
reads one. An index beside the log holds the same for whole files: its rows
are read off the batch's own files (one narrow column) when it is appended,
and a query opens only the files whose range meets its period.

A batch is written to a folder of its own; it counts once its index is there,
so a batch that died half-way is not seen and can be appended again under
another name.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyscope.functions.scalars import parse_ts

TIME = "fecha"
FILE_ROWS = 1_000_000
INDEX_SCHEMA = T.StructType([T.StructField("file", T.StringType()), T.StructField("lo", T.TimestampNTZType()),
                             T.StructField("hi", T.TimestampNTZType()), T.StructField("rows", T.LongType()),
                             T.StructField("untimed", T.LongType())])


def append_timed(df: DataFrame, path: str, file_rows: int = FILE_ROWS, row_group_bytes: int | None = None,
                 batch: str | None = None) -> int:
    """Append a batch of log rows (with ``marca_de_tiempo``); returns its number of rows.

    The time column ``fecha`` is added unless it is there. Files hold about
    ``file_rows`` rows; readings of one instant may be cut between files, so no
    instant is too large.
    """
    spark = df.sparkSession
    if TIME not in df.columns:
        df = df.withColumn(TIME, parse_ts("marca_de_tiempo"))
    tie = [c for c in ("seq",) if c in df.columns]
    files = max(1, -(-df.count() // file_rows))
    folder = f"{path}/data/{batch or uuid.uuid4().hex}"
    order = [F.col(TIME).asc_nulls_first(), *tie]
    out = df.repartitionByRange(files, *order).sortWithinPartitions(*order).write
    (out if row_group_bytes is None else out.option("parquet.block.size", row_group_bytes)).parquet(folder)
    stored = spark.read.schema(df.schema).parquet(folder)
    index = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(TIME).alias("lo"), F.max(TIME).alias("hi"), F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(TIME).isNull()).alias("untimed"))
    index.coalesce(1).write.parquet(f"{path}/index/{folder.rpartition('/')[2]}")          # a row a file
    return index_of(spark, path).filter(F.contains("file", F.lit(f"/{folder.rpartition('/')[2]}/"))).agg(F.sum("rows")).first()[0] or 0


def index_of(spark: SparkSession, path: str) -> DataFrame:
    """One row per file of the log: its range of times, its rows, and those without a time."""
    return spark.read.schema(INDEX_SCHEMA).option("recursiveFileLookup", True).parquet(f"{path}/index")


def files_between(spark: SparkSession, path: str, since: datetime | None, until: datetime | None) -> list[str]:
    """Files that can hold a reading with ``since <= time < until``; their names, not their rows, reach the driver."""
    meets = F.col("lo").isNotNull()
    if since is not None:
        meets = meets & (F.col("hi") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        meets = meets & (F.col("lo") < F.lit(until).cast("timestamp_ntz"))
    return sorted(r["file"] for r in index_of(spark, path).filter(meets).select("file").collect())


def read_between(spark: SparkSession, path: str, schema: T.StructType, since: datetime | None = None,
                 until: datetime | None = None) -> DataFrame:
    """The log's readings with ``since <= time < until``; rows without a time are in no period.

    ``schema`` is that of the appended rows (``fecha`` is added to it). Files
    come from the index, row groups by their footers, rows by the filter.
    """
    if TIME not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(TIME, T.TimestampNTZType())])
    files = files_between(spark, path, since, until)
    if not files:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(*files).filter(F.col(TIME).isNotNull())
    if since is not None:
        df = df.filter(F.col(TIME) >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        df = df.filter(F.col(TIME) < F.lit(until).cast("timestamp_ntz"))
    return df


def read_untimed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The log's rows whose stamp is no time."""
    if TIME not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(TIME, T.TimestampNTZType())])
    files = sorted(r["file"] for r in index_of(spark, path).filter("untimed > 0").select("file").collect())
    return spark.read.schema(schema).parquet(*files).filter(F.col(TIME).isNull()) if files else spark.createDataFrame([], schema)
