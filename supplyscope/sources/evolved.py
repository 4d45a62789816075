"""Device classes stored with columns of their own, read as one table.

Each class folder holds the columns its sheet has: the gauges that the class
reads, older types, display names as headers, now and then a column nobody
declared. Reading takes every class folder with the merged schema of its own
files and conforms it to a declared target: columns are found by name or
display name, cast where an older generation has another type (what cannot be
cast is NULL), added as NULL where a class lacks them, and columns that the target
does not know are kept as one JSON text. Class folders are few, whatever the
number of devices; rows stay where they are (a union of scans, no shuffle), and a
filter on the class drops the other folders from the plan.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyscope import config as K
from supplyscope.sources.tables import _internal_name

CLASS, GENERATION = "device_class", "gen"
EXTRAS = "otros"
_S = T.StringType()

#: Every level any class has, beside the columns that all have.
TARGET = T.StructType(
    [T.StructField("device_id", T.LongType()), T.StructField("nombre", _S), T.StructField(CLASS, _S),
     T.StructField("ip", _S), T.StructField("modelo", _S)]
    + [T.StructField(c, _S) for c in (*K.SUPPLY_COLUMNS.values(), *K.IMAGING_COLUMNS.values())]
    + [T.StructField("estado", _S), T.StructField("marca_de_tiempo", _S)])


def class_levels(cls: str) -> list[str]:
    """Level columns of a class, in the order of its gauges."""
    names = {**K.SUPPLY_COLUMNS, **K.IMAGING_COLUMNS}
    return [names[s] for s in K.GAUGE_MAP[cls]]


def conform(df: DataFrame, target: T.StructType = TARGET, extras: str | None = EXTRAS) -> DataFrame:
    """``df`` with exactly the columns of ``target`` (and ``extras``, the rest as a JSON object, NULL if there is none).

    Of several columns with one internal name the first one that is not NULL counts.
    """
    found: dict[str, list[str]] = {}
    for c in df.columns:
        found.setdefault(_internal_name(c), []).append(f"`{c}`")
    out = []
    for f in target:
        have = [F.col(c).try_cast(f.dataType) for c in found.get(f.name, [])]
        out.append((F.coalesce(*have) if have else F.lit(None).cast(f.dataType)).alias(f.name))
    rest = [(n, c) for n, cs in found.items() if n not in target.names for c in cs]
    if extras is not None:
        whole = F.to_json(F.struct(*[F.col(c).cast("string").alias(n) for n, c in rest])) if rest else F.lit(None).cast("string")
        some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for _, c in rest], F.lit(False))
        out.append(F.when(some, whole).alias(extras))
    return df.select(*out)


def class_folders(spark: SparkSession, path: str) -> list[tuple[str | None, str]]:
    """(class, folder) of everything below ``path`` that holds files: a class's folder, or
    its ``gen=<n>`` folders, one for each generation of its sheet."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in fs.listStatus(at(folder)))

    out = []
    for n in names(path):
        if not n.startswith(f"{CLASS}="):
            continue
        cls = None if n.endswith("=__HIVE_DEFAULT_PARTITION__") else unquote(n.partition("=")[2])
        gens = [g for g in names(f"{path}/{n}") if g.startswith(f"{GENERATION}=")]
        for folder in [f"{path}/{n}/{g}" for g in gens] or [f"{path}/{n}"]:
            if any(f.endswith(".parquet") for f in names(folder)):
                out.append((cls, folder))
    return out


def read_evolved(spark: SparkSession, path: str, classes: list[str] | None = None, target: T.StructType = TARGET,
                 extras: str | None = EXTRAS) -> DataFrame:
    """Every class below ``path`` (or those asked for) under the target schema.

    A class folder without files gives no rows, a folder without an ``ip``
    column is an error that names it, and no folder at all gives an empty table.
    """
    parts = []
    for cls, folder in class_folders(spark, path):
        if classes is not None and cls not in classes:
            continue
        df = spark.read.option("mergeSchema", True).parquet(folder)
        if "ip" not in {_internal_name(c) for c in df.columns}:
            raise ValueError(f"table at {folder} lacks column(s) ['ip']")
        parts.append(conform(df.withColumn(CLASS, F.lit(cls).cast("string")), target, extras))
    if not parts:
        schema = T.StructType([*target.fields, *([T.StructField(extras, _S)] if extras else [])])
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def write_class(df: DataFrame, path: str, cls: str, generation: int | None = None, mode: str = "append") -> None:
    """Files of one class, with whatever columns ``df`` has; files of one folder must agree in
    the types of their columns, so another type is another generation."""
    folder = f"{path}/{CLASS}={quote(cls, safe=' -._~')}"
    df.drop(CLASS).write.mode(mode).parquet(folder if generation is None else f"{folder}/{GENERATION}={generation}")
