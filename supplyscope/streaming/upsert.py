"""A device table kept up to date by a stream of poll results.

The table is stored class by class in versions: ``root/v=<n>/device_class=<c>``.
Version 0 is the inventory, and a micro-batch with id ``b`` is version ``b + 1``;
it holds only the classes that have polls in the batch. The current table is, for each class,
its newest committed version (a version is committed when Spark's ``_SUCCESS``
file stands in it). So

* a batch rewrites the classes it touches and leaves the others' files alone,
* a batch that comes again finds its version committed and does nothing,
* a batch that failed half-way finds its version uncommitted, computes from
  the versions below its own, and replaces it,
* a reader sees a whole version of a class or none of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from supplyscope.session import drop_path

CLASS = "device_class"
Merge = Callable[[DataFrame, DataFrame], DataFrame]


class ClassTable:
    """Versions of a class-partitioned table below ``root`` (any Hadoop file system)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._schema: T.StructType | None = None

    def start(self, df: DataFrame) -> None:
        """Version 0. Rows without a class cannot be polled; they form a class of their own."""
        self._schema = df.schema
        if not self.committed(0):
            self._write(df, 0)

    def _write(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").partitionBy(CLASS).parquet(f"{self.root}/v={version}")

    def _names(self, path: str) -> list[str]:
        p = self._path(path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def committed(self, version: int) -> bool:
        return bool(self._fs.exists(self._path(f"{self.root}/v={version}/_SUCCESS")))

    def versions(self) -> list[int]:
        """Committed versions, ascending."""
        found = [int(n[2:]) for n in self._names(self.root) if n.startswith("v=")]
        return sorted(v for v in found if self.committed(v))

    def current(self, below: int | None = None) -> dict[str, int]:
        """Newest committed version of each class folder, of versions below ``below`` if given."""
        out: dict[str, int] = {}
        for v in self.versions():
            if below is None or v < below:
                out |= {n: v for n in self._names(f"{self.root}/v={v}") if n.startswith(f"{CLASS}=")}
        return out

    def read(self, classes: list[str | None] | None = None, below: int | None = None) -> DataFrame:
        """The current table, or the classes asked for. An empty table has the schema of version 0."""
        paths = [f"{self.root}/v={v}/{n}" for n, v in sorted(self.current(below).items())]
        schema = self._schema
        if schema is None:
            schema = T.StructType([f for f in self.spark.read.parquet(f"{self.root}/v=0").schema])
        if not paths:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*[f for f in schema if f.name != CLASS], T.StructField("v", T.LongType()),
                               T.StructField(CLASS, T.StringType())])
        df = self.spark.read.schema(stored).option("basePath", self.root).parquet(*paths).select(*schema.names)
        if classes is None:
            return df
        wanted = F.col(CLASS).isin([c for c in classes if c is not None])
        return df.filter(wanted | F.col(CLASS).isNull() if None in classes else wanted)

    def upsert(self, batch: DataFrame, batch_id: int, merge: Merge) -> bool:
        """Merge one micro-batch into the classes it has polls for; False where it was done before."""
        version = batch_id + 1
        if self.committed(version):
            return False
        classes = [r[0] for r in batch.select(CLASS).distinct().collect()]      # the table's classes, a fixed few
        if not classes:
            return False
        self._write(merge(self.read(classes, below=version), batch), version)
        return True

    def vacuum(self, keep: int = 2) -> int:
        """Delete class folders that ``keep`` newer committed versions replace; returns how many.
        Version 0 keeps its marker. A reader of the current table is never affected."""
        newer: dict[str, int] = {}
        gone = 0
        for v in reversed(self.versions()):
            for n in [n for n in self._names(f"{self.root}/v={v}") if n.startswith(f"{CLASS}=")]:
                newer[n] = newer.get(n, 0) + 1
                if newer[n] > max(1, keep):
                    drop_path(self.spark, f"{self.root}/v={v}/{n}")
                    gone += 1
        return gone


def run_upserts(stream: DataFrame, table: ClassTable, merge: Merge, checkpoint: str) -> StreamingQuery:
    """Drain every available file into ``table``. Of a batch's poll rows with one
    key the smallest sequence counts; a later batch updates what an earlier one left."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id, merge)

    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
