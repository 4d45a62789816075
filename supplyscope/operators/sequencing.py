"""Ordered series without hot-key tasks.

Most fleet operators need, within a series (one device + supply), each
row's position, the previous row's values and running counts.  The direct
Spark form is a window partitioned by the series key, which puts a whole
series into one task: fine while every series is small, fatal when one
device holds a third of all readings.

``order_series`` therefore has two physical forms behind one contract:

* **plain**: ``Window.partitionBy(keys).orderBy(order)``; one exchange on
  the series key, used when the largest series fits a task.
* **blocked**: the rows are range-partitioned on ``keys + order`` (Spark's
  range partitioner samples the composite key, so a hot series is cut into
  many contiguous blocks and ties on the time column are split by the
  tie-breaker), the block id is stored with a reliable checkpoint (so
  recomputation after an executor loss sees the same blocks), windows run
  per ``(series, block)``, and a summary table with one row per
  ``(series, block)`` -- at most ``blocks + series`` rows -- stitches
  positions and previous-row values across block edges.  The series key is
  carried as one struct column (never NULL; NULL parts compare equal), so
  each stitch is a plain equi-join on the windows' own partitioning and the
  large side is not shuffled again.  The range split and the positions
  are each stored with a reliable checkpoint, so neither the running counts
  nor their summary recompute an earlier pass.

``mode="auto"`` (default, or conf ``supplyscope.series.skewMode``) probes
the largest series size with one aggregation over the key columns and
picks blocked only when it exceeds ``supplyscope.series.blockRows``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplyscope import config as K
from supplyscope.session import conf_int, conf_str, ensure_checkpoint_dir

BLOCK = "_blk"
SKEY = "_sk"     # struct of the series key: never NULL, NULL parts compare equal


@dataclass
class SeriesPlan:
    """How a DataFrame was sequenced; reused by later passes."""

    keys: list[str]
    order: list[str]
    blocked: bool
    block_col: str | None = None

    @property
    def part_keys(self) -> list[str]:
        return [SKEY, self.block_col] if self.blocked else self.keys


def _choose_mode(df: DataFrame, keys: list[str], mode: str | None, block_rows: int,
                 bound: DataFrame | tuple[int, int] | None = None) -> tuple[bool, int]:
    spark = df.sparkSession
    mode = mode or conf_str(spark, K.SERIES_SKEW_MODE_CONF, "auto")
    if mode == "off":
        return False, 0
    # ``bound``: upper bounds of series sizes -- a DataFrame with a ``count``
    # column, or an already probed (largest, total) pair -- e.g. rows per
    # device of the raw log: a key-only scan instead of re-running the whole
    # upstream pipeline just to size the series.
    if isinstance(bound, tuple):
        mx, total = bound
        row = {"mx": mx, "tot": total}
    else:
        sizes = bound if bound is not None else df.groupBy(*keys).count()
        row = sizes.agg(F.max("count").alias("mx"), F.sum("count").alias("tot")).first()
    total = int(row["tot"] or 0)
    if mode == "force":
        return True, total
    if mode != "auto":
        raise ValueError(f"unknown skew mode {mode!r}")
    return (row["mx"] or 0) > block_rows, total


def order_series(df: DataFrame, keys: list[str], order: list[str], carry: list[str] = (),
                 mode: str | None = None, block_rows: int | None = None,
                 blocks: int | None = None,
                 bound: DataFrame | tuple[int, int] | None = None) -> tuple[DataFrame, SeriesPlan]:
    """Add ``_rn`` (1-based position by ``order`` within the series),
    ``_n`` (series size), ``_prev_<c>`` (previous row's ``c``, NULL on the
    first row) and ``_first_<c>`` (first row's ``c``) for each ``c`` in
    ``carry``.  ``order`` must be a total order within a series (end it
    with a unique tie-breaker)."""
    keys, order, carry = list(keys), list(order), list(carry)
    spark = df.sparkSession
    block_rows = block_rows or conf_int(spark, K.SERIES_BLOCK_ROWS_CONF, K.SERIES_BLOCK_ROWS_DEFAULT)
    blocked, total = _choose_mode(df, keys, mode, block_rows, bound)
    ordering = [F.col(c).asc_nulls_first() for c in order]

    if not blocked:
        # One window spec for everything: partition-wide values use an
        # explicit whole-partition frame of the same ordered spec (linear
        # time), so Spark evaluates them all in a single Window operator.
        w = Window.partitionBy(*keys).orderBy(*ordering)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        cols = [F.row_number().over(w).alias("_rn"), F.count(F.lit(1)).over(whole).alias("_n")]
        cols += [F.lag(c).over(w).alias(f"_prev_{c}") for c in carry]
        cols += [F.first(c).over(whole).alias(f"_first_{c}") for c in carry]
        return df.select("*", *cols), SeriesPlan(keys, order, False)

    # ---- blocked form -------------------------------------------------
    ensure_checkpoint_dir(spark)
    nparts = blocks or max(spark.sparkContext.defaultParallelism, math.ceil(total / block_rows))
    ranged = (df.repartitionByRange(nparts, *[F.col(k) for k in keys], *ordering)
              .withColumn(BLOCK, F.spark_partition_id())
              .withColumn(SKEY, F.struct(*[F.col(k) for k in keys])))
    # Store the block id: the range bounds come from a sample, so a
    # recomputed branch must never re-derive them.
    ranged = ranged.checkpoint(eager=True)
    plan = SeriesPlan(keys, order, True, BLOCK)
    return _blocked_sequence(ranged, plan, carry), plan


def _summary_window(plan: SeriesPlan):
    sw = Window.partitionBy(SKEY).orderBy(plan.block_col)
    return (sw.rowsBetween(Window.unboundedPreceding, -1),
            sw.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), sw)


def _blocked_sequence(df: DataFrame, plan: SeriesPlan, carry: list[str]) -> DataFrame:
    order, pk = plan.order, plan.part_keys
    ordering = [F.col(c).asc_nulls_first() for c in order]
    w = Window.partitionBy(*pk).orderBy(*ordering)
    local = df.select("*", F.row_number().over(w).alias("_lrn"),
                      *[F.lag(c).over(w).alias(f"_lprev_{c}") for c in carry])
    state = F.struct(*[F.col(c).alias(c) for c in carry]) if carry else F.lit(None)
    key_struct = F.struct(*order)
    summ = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("_c"),
                               F.max_by(state, key_struct).alias("_last"),
                               F.min_by(state, key_struct).alias("_bfirst"))
    before, whole, sw = _summary_window(plan)
    summ = summ.select(
        *pk,
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
        F.sum("_c").over(whole).alias("_n"),
        F.lag("_last").over(sw).alias("_plast"),
        F.first("_bfirst").over(whole).alias("_sfirst"),
    )
    j = local.join(summ, on=pk, how="inner")
    return j.select(*df.columns, (F.col("_lrn") + F.col("_off")).cast("int").alias("_rn"), F.col("_n"),
                    *[F.when(F.col("_lrn") == 1, F.col(f"_plast.{c}")).otherwise(F.col(f"_lprev_{c}"))
                      .alias(f"_prev_{c}") for c in carry],
                    *[F.col(f"_sfirst.{c}").alias(f"_first_{c}") for c in carry])


def running_count(df: DataFrame, plan: SeriesPlan, flag: str) -> DataFrame:
    """Add ``_cum_<flag>`` (number of rows with ``flag`` true up to and
    including this row, in series order) and ``_tot_<flag>`` (series total).
    Uses the partitioning chosen by ``order_series``; in blocked form the
    positions are stored first, since rows and summary both read them."""
    ordering = [F.col(c).asc_nulls_first() for c in plan.order]
    ind = F.when(F.col(flag), F.lit(1)).otherwise(F.lit(0))
    if not plan.blocked:
        spec = Window.partitionBy(*plan.keys).orderBy(*ordering)
        w = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return df.select("*", F.sum(ind).over(w).cast("int").alias(f"_cum_{flag}"),
                         F.sum(ind).over(whole).cast("int").alias(f"_tot_{flag}"))
    pk, df = plan.part_keys, df.checkpoint(eager=True)
    w = (Window.partitionBy(*pk).orderBy(*ordering)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = df.select("*", F.sum(ind).over(w).alias("_lcum"))
    summ = df.groupBy(*pk).agg(F.sum(ind).alias("_fc"))
    before, whole, _ = _summary_window(plan)
    summ = summ.select(*pk, F.coalesce(F.sum("_fc").over(before), F.lit(0)).alias("_foff"),
                       F.sum("_fc").over(whole).alias("_ftot"))
    j = local.join(summ, on=pk, how="inner")
    return j.select(*df.columns, (F.col("_lcum") + F.col("_foff")).cast("int").alias(f"_cum_{flag}"),
                    F.col("_ftot").cast("int").alias(f"_tot_{flag}"))
