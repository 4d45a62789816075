"""Device and poll tables bucketed by key, so that refreshes join without a shuffle.

A table is written once per change, hash-partitioned by its key and salt (see
:func:`supplyscope.operators.merge.salted`) into as many files as buckets, each
sorted. Two tables with the same keys and number of buckets are co-located:
the poll side's reduction to one row per key and the join itself need no
exchange, run after run. Rows without a key are spread over the buckets by
the salt. The session's catalog knows the bucketing; the files lie where
``path`` says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope.operators.merge import SALT, merge_left, salted

BUCKETS = 32


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Store ``df`` at ``path`` as ``table``, bucketed and sorted by ``keys`` and salt, and return it as read back.

    ``path`` must be new (a table is staged beside the one it replaces, then
    the name is moved). An empty table is stored like any other.
    """
    by = [*keys, SALT]
    (salted(df, keys).repartition(buckets, *[F.col(c) for c in by]).write.format("parquet").mode("errorifexists")
     .bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """Forget the name; the files stay (the table is external)."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def merge_bucketed(inv: DataFrame, poll: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`supplyscope.operators.merge.merge_left` of two bucketed tables, each task joining one bucket.

    The poll side is never broadcast, whatever its size: the point is a plan
    that stays the same, and moves no row, as tables grow.
    """
    if SALT not in inv.columns or SALT not in poll.columns:
        raise ValueError("both tables must be stored by write_bucketed")
    return merge_left(inv, poll.hint("merge"), keys=keys)
