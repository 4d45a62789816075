"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope.session import ensure_checkpoint_dir, scratch_path

#: ASCII white space of every word rule here, and its complement as a regex.
WORD_REGEX = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names`` lengthened until no column of ``df`` is called so, in any spelling."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def plainly_named(df: DataFrame, *wanted: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns called ``c0``, ``c1``, ... (functions over whole rows cannot take names with
    dots), and what the ``wanted`` ones are called there; ``toDF`` with the old names undoes it."""
    new = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*new), [new[df.columns.index(w)] for w in wanted]


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame, name: str, by: str | None = None, **options: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet below the shared folder, in folders ``by`` a column
    if given, and read it back; the caller drops the path once nothing reads it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    out = df.write.options(**options)
    (out.partitionBy(by) if by else out).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def crc_fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds`` (a null id: fold of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def hash_sample(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hash of ``by``, one for each hash.

    A cut on the hash leaves about ``2 * rows`` rows before anything is sorted,
    so tasks pass on a bounded number altogether however many they are, and
    copies count once.
    """
    total, space = df.count(), 1 << 40
    told = df.withColumn("_h", F.xxhash64(*by).bitwiseAND(F.lit(space - 1)))
    if total > 2 * rows:
        told = told.where(F.col("_h") < int(space * 2 * rows / total))
    return told.dropDuplicates(["_h"]).orderBy("_h").limit(rows).drop("_h")


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows of about ``max_bytes`` of ``column``
    (one row at least), so that a task's working memory follows this bound
    and the longest single text, not the batch size Spark chose."""
    size = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(size), 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def give_back() -> None:
    """Return freed memory to the system at the end of a task: workers wait beside the next
    steps of the JVM. Only an allocator that can (glibc's) is asked to."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null reads as the empty text."""
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def signature(df: DataFrame) -> tuple:
    """(rows, order-free hash) of a small-row table, two scalars for a convergence test."""
    r = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*df.columns))).first()
    return r[0], r[1]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): rows ``(node, root)`` with
    the smallest node of the component, for every node that is not its own root.

    Alternating large-star / small-star rounds. Each round is a partial
    ``min`` per node and an equi-join that adaptive execution may split at a
    hub; edges per round never exceed the input's. Only two scalars a round
    reach the driver. Empty input gives an empty result.
    """
    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
         .distinct())
    e = reliable(e)
    last = signature(e)
    for _ in range(max_rounds):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = reliable(small)
        now = signature(e)
        if now == last:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def pair_blocks(rows: DataFrame, bucket: str, uid: str, block_rows: int) -> DataFrame:
    """Rows of every bucket with two members or more, dealt so that any two rows
    of a bucket meet in one task group ``(bucket, pa, pb)`` of at most about
    ``2 * block_rows`` rows.

    A bucket of ``m`` rows is cut into ``ceil(m / block_rows)`` hashed blocks, and
    each pair of blocks is one group: a hot bucket spreads over many tasks,
    whole, and ordinary buckets are one group each. Adds ``ps`` (own block).
    """
    n = rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    cut = rows.join(n, bucket).withColumn("_k", F.ceil(F.col("_n") / block_rows).cast("int"))
    cut = cut.withColumn("ps", F.pmod(F.xxhash64(uid), F.col("_k")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_t")
    return (cut.select("*", other).withColumn("pa", F.least("ps", "_t")).withColumn("pb", F.greatest("ps", "_t"))
            .drop("_n", "_k", "_t"))


def group_starts(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Positions at which a run of equal ``keys`` begins."""
    k = frame[keys].to_numpy()
    return np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)])


def whole_groups(frames: Iterator[pd.DataFrame], keys: list[str], rows: int) -> Iterator[pd.DataFrame]:
    """Re-cut a partition sorted by ``keys`` into frames of about ``rows`` rows that
    never split a group; one frame is at most ``rows`` rows and one group."""
    held = None
    for f in frames:
        held = f if held is None else pd.concat([held, f], ignore_index=True)
        if len(held) < rows:
            continue
        at, stops = 0, group_starts(held, keys)[1:]     # the last group may go on in the next frame
        for s in stops:
            if s - at >= rows or s == stops[-1]:
                yield held.iloc[at:s].reset_index(drop=True)
                at = int(s)
        held = held.iloc[at:].reset_index(drop=True)
    if held is not None and len(held):
        at, stops = 0, [*group_starts(held, keys)[1:], len(held)]
        for s in stops:
            if s - at >= rows or s == len(held):
                yield held.iloc[at:s].reset_index(drop=True)
                at = int(s)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes over the links ``a[i]-b[i]``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new
