"""Session helpers.

Jobs take an existing ``SparkSession``; these helpers only build one for
tests/benchmarks and resolve the shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def recommended_cluster_conf(total_input_bytes: int, cores: int) -> dict[str, str]:
    """Settings a cluster run of these jobs should start from (the library
    never hard-codes them): AQE with skew-join splitting, partitions sized to
    ~256 MB of input so shuffle blocks fit executor memory, and an initial
    shuffle width AQE can coalesce down but never has to split up."""
    target = 256 * 1024 * 1024
    initial = max(cores * 3, -(-total_input_bytes // target))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.session.timeZone": "UTC",
        # Dedupe state of a stream lives off the heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "supplyscope", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (a cluster job gets its own)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session (or the directory the
    context already uses).  Only when neither exists and the master is local
    (tests) a private folder is registered -- through
    ``SparkContext.setCheckpointDir``, since Spark 4 forbids changing the
    core setting at run time.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: reliable checkpoints and "
                               "staged tables must survive the loss of any executor")
        d = tempfile.mkdtemp(prefix="supplyscope-ckpt-")   # local tests only
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for staged tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "supplyscope", f"{name}-{uuid.uuid4().hex[:12]}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote (any Hadoop file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """``key`` is ``value`` for the jobs within, and afterwards what it was."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    v = spark.conf.get(key, None)
    return int(v) if v not in (None, "") else default


def conf_str(spark: SparkSession, key: str, default: str) -> str:
    v = spark.conf.get(key, None)
    return v if v not in (None, "") else default
