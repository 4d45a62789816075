"""Sheets read with their bad records kept: a clean and a rejected output, counted in one pass.

A text export is read permissively under a declared schema of texts. A line
that is no record (too few or too many fields, broken quotes) keeps its text
in the corrupt-record column. Records that can be read are checked cell by
cell: a level must be blank or a percentage, a stamp must be a time, a key must
not be blank. What fails is rejected with its reasons and its line, never
nulled in silence. Both outputs are written by one job, which also counts
them (``observe``); no row is read twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyscope import config as K
from supplyscope.functions.scalars import parse_ts, pct_to_double, strip_ws
from supplyscope.sources.tables import HISTORY_SCHEMA

LINE = "_line"             # text of a line that is no record
REASONS = "reasons"
BLANK_LEVELS = ("", "--")  # texts that stand for no level

#: A log sheet as text: every column of the log, cells as they are.
SHEET_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in HISTORY_SCHEMA])


@dataclass
class Split:
    clean: DataFrame           # the sheet's columns, texts as they came
    rejected: DataFrame        # the same, with the line of a broken record and the reasons
    read: int
    broken: int
    bad_cells: int

    @property
    def kept(self) -> int:
        return self.read - self.broken - self.bad_cells


def _blank(c: Column) -> Column:
    return c.isNull() | strip_ws(c).isin(*BLANK_LEVELS)


def cell_reasons(df: DataFrame, levels: list[str], stamp: str = "marca_de_tiempo", key: str = "ip") -> Column:
    """Array of what is wrong with a record, by column, in column order; empty for a clean one."""
    found = [F.when(~_blank(F.col(c)) & pct_to_double(c).isNull(), F.lit(f"{c}: no percentage")) for c in levels if c in df.columns]
    if key in df.columns:
        found.insert(0, F.when(F.col(key).isNull() | (strip_ws(F.col(key)) == ""), F.lit(f"{key}: blank")))
    if stamp in df.columns:
        found.append(F.when(parse_ts(stamp).isNull(), F.lit(f"{stamp}: no time")))
    return F.array_compact(F.array(*found))


def read_permissive(spark: SparkSession, path: str, schema: T.StructType = SHEET_SCHEMA, header: bool = True, **options) -> DataFrame:
    """The sheet's lines as records of ``schema``; a line that is none has its text in ``_line``."""
    whole = T.StructType([*schema.fields, T.StructField(LINE, T.StringType())])
    return (spark.read.schema(whole).option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", LINE).options(**options).csv(path))


def split_sheet(spark: SparkSession, path: str, out: str, schema: T.StructType = SHEET_SCHEMA,
                levels: list[str] | None = None, **options) -> Split:
    """Read ``path``, write ``out/part=clean`` and ``out/part=rejected``, count both.

    ``out`` must be new. A broken line gives one reason, ``no record``, and
    counts as broken whatever its cells hold. Reasons are joined by ``; ``.
    Columns that the sheet lacks make every line broken, so a sheet of another
    layout is rejected as a whole and visibly. An empty sheet has two empty
    outputs.
    """
    rows = read_permissive(spark, path, schema, **options)
    reasons = cell_reasons(rows, K.supply_cols() if levels is None else levels)
    broken = F.col(LINE).isNotNull()
    rows = rows.withColumn(REASONS, F.when(broken, "no record").otherwise(F.nullif(F.array_join(reasons, "; "), F.lit(""))))
    obs = Observation("split_sheet")
    rows = rows.observe(obs, F.count(F.lit(1)).alias("read"), F.count_if(broken).alias("broken"),
                        F.count_if(~broken & F.col(REASONS).isNotNull()).alias("bad_cells"))
    part = F.when(F.col(REASONS).isNull(), "clean").otherwise("rejected")
    rows.withColumn("part", part).write.partitionBy("part").parquet(out)
    counts = obs.get
    stored = T.StructType([*schema.fields, T.StructField(LINE, T.StringType()), T.StructField(REASONS, T.StringType()),
                           T.StructField("part", T.StringType())])
    both = spark.read.schema(stored).parquet(out)
    return Split(both.filter(F.col("part") == "clean").drop("part", LINE, REASONS),
                 both.filter(F.col("part") == "rejected").drop("part"),
                 int(counts["read"]), int(counts["broken"]), int(counts["bad_cells"]))
