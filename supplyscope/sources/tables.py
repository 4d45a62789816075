"""Table readers and writers.

Fleet tables are Parquet datasets with declared schemas: a device table
(one row per device, ``device_class`` column or partition), the history log
(append-only, partitioned by day) and forecast outputs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyscope import config as K
from supplyscope.functions.scalars import parse_ts

_S = T.StringType()

INVENTORY_SCHEMA = T.StructType(
    [T.StructField("device_id", T.LongType()), T.StructField("nombre", _S),
     T.StructField("device_class", _S), T.StructField("ip", _S), T.StructField("modelo", _S)]
    + [T.StructField(c, _S) for c in K.supply_cols()]
    + [T.StructField("ui_negro", _S), T.StructField("estado", _S), T.StructField("marca_de_tiempo", _S)])

HISTORY_SCHEMA = T.StructType(
    [T.StructField("seq", T.LongType())] + [T.StructField(c, _S) for c in K.HISTORY_COLUMNS.values()])


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a dataset folder (schema from the file footer)."""
    return spark.read.parquet(table_path(sf_dir, name))


def check_schema(df: DataFrame, required: list[str], path: str) -> DataFrame:
    """Raise a ``ValueError`` naming ``path`` when required columns are missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"table at {path} lacks column(s) {missing}")
    return df


def read_with_schema(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                     **options) -> DataFrame:
    """Read with a declared schema: no inference pass, stable types, columns
    absent from older files read as NULL."""
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def read_inventory(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    df = read_with_schema(spark, path, INVENTORY_SCHEMA, fmt, **options)
    return check_schema(df, ["ip"], path)


def read_history(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    df = read_with_schema(spark, path, HISTORY_SCHEMA, fmt, **options)
    return check_schema(df, ["ip", "estado", "marca_de_tiempo"], path)


# Display name (sheet header) -> internal column.
SHEET_COLUMNS: dict[str, str] = {**K.HISTORY_COLUMNS, **K.IMAGING_COLUMNS}


def _internal_name(header: str) -> str:
    h = header.strip()
    if h in SHEET_COLUMNS:
        return SHEET_COLUMNS[h]
    return "_".join("".join(ch if ch.isalnum() else " " for ch in h.lower()).split())


def read_sheet(spark: SparkSession, path: str, fmt: str = "csv", device_class: str | None = None,
               **options) -> DataFrame:
    """A device sheet exported as text (CSV by default): header row with the
    display names, every value kept as text (no type inference, as the
    original forces text dtypes), padded headers trimmed, display names
    mapped to internal columns (``Kit Mant.`` -> ``kit_mant``).  With
    ``device_class`` the sheet's class is added as a column."""
    df = (spark.read.format(fmt).option("header", True).option("inferSchema", False)
          .options(**options).load(path))
    df = df.toDF(*[_internal_name(c) for c in df.columns])
    if device_class is not None:
        df = df.withColumn("device_class", F.lit(device_class))
    return check_schema(df, ["ip"], path)


def write_class_tables(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """All device classes as one dataset partitioned by ``device_class``.

    With ``mode="overwrite"`` and dynamic partition overwrite only the
    classes present in ``df`` are replaced; the other classes stay as they
    are (the "replace one sheet, keep its siblings" contract).
    """
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("device_class").parquet(path))


def read_class_tables(spark: SparkSession, path: str, classes: list[str] | None = None) -> DataFrame:
    """Every class of a partitioned device dataset (partition discovery); a
    class filter prunes partitions instead of reading them."""
    df = spark.read.parquet(path)
    if classes:
        df = df.filter(F.col("device_class").isin(classes))
    return df


def write_overwrite(df: DataFrame, path: str) -> None:
    """Replace a table.  Never point ``path`` at a table ``df`` reads from:
    stage to a new path and swap instead."""
    df.write.mode("overwrite").parquet(path)


def append_log(df: DataFrame, path: str, day_col: str = "fecha_dia") -> int:
    """Append a batch to the history log, partitioned by the day of the parsed
    stamp (rows whose stamp is no time share the null partition); returns the
    number of appended rows, counted by an ``observe`` metric of the write
    itself (no second pass). Rows are dealt by day, a large day over several
    tasks, so a batch writes few files."""
    from pyspark.sql import Observation

    obs = Observation("history_append")
    batch = df
    if day_col not in batch.columns:
        batch = batch.withColumn(day_col, parse_ts("marca_de_tiempo").cast("date").cast("string"))
    batch = batch.observe(obs, F.count(F.lit(1)).alias("rows"))
    batch.hint("rebalance", day_col).write.mode("append").partitionBy(day_col).parquet(path)
    return int(obs.get["rows"])
