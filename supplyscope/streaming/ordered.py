"""The history log as a stream, deduped by the batch's rule: the smallest sequence wins.

Devices are dealt to a fixed number of slots by a hash of their ip; rows are
grouped by slot and time bucket (a day unless told otherwise). So the number of
groups, state entries and Python calls follows slots and buckets, not devices.
A group's keyed state holds the rows it has so far, one for each device and
stamp, that with the smallest sequence, as compressed Arrow; an event-time timer
at the end of the bucket emits them once the watermark has passed it. So arrival
order inside the lateness bound does not matter.

Nothing vanishes. Spark drops rows behind the watermark before a stateful
operator sees them, so the rows travel beside a *clock branch*: that branch
carries no rows, only the event times that move the watermark, while the data
branch's own time column is a constant that is never late. A row whose group
has been emitted goes at once to the side output ``late``, a valid row whose
stamp is no time to the side output ``untimed``. :func:`read_deduped` settles both against
the main output.

The sink writes each trigger's rows into a folder of its own named by the
batch id, so a repeated batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from supplyscope import config as K
from supplyscope.functions.scalars import parse_ts, strip_ws
from supplyscope.operators.history import clean_history, dedupe_first
from supplyscope.session import drop_path, scratch_path
from supplyscope.sources import fixtures as X
from supplyscope.streaming.ingest import LOG_SCHEMA

MAIN, LATE, UNTIMED = "main", "late", "untimed"
OUT_SCHEMA = T.StructType([*LOG_SCHEMA.fields, T.StructField("side", T.StringType())])
KEY = ["ip", "marca_de_tiempo"]
SLOTS = 32                 # groups a bucket's devices are dealt to; fixed as long as a checkpoint lives
_COLUMNS = LOG_SCHEMA.names
_STORED = pa.schema([(f.name, pa.int64() if f.name == "seq" else pa.string()) for f in LOG_SCHEMA])
_NEVER_LATE = "2200-01-01 00:00:00"
_NO_TIME = -1
_WIDTH = "spark.sql.shuffle.partitions"


def _packed(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, schema=_STORED, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


def first_of_each(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per device and stamp: that with the smallest sequence."""
    return rows.sort_values("seq", kind="stable").drop_duplicates(KEY)


def keep_first(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Rows of one (slot, bucket end in milliseconds): held until the bucket closes."""
    if state.hasTimedOut:
        (held,) = state.get
        state.remove()
        yield _unpacked(held).assign(side=MAIN)
        return
    rows = pd.concat([f[f["_ok"]] for f in frames], ignore_index=True)[_COLUMNS]
    if rows.empty:
        return
    end = key[1]
    closed = state.getCurrentWatermarkMs() >= end
    if end == _NO_TIME or (closed and not state.exists):
        yield rows.assign(side=UNTIMED if end == _NO_TIME else LATE)
        return
    if state.exists:
        rows = pd.concat([_unpacked(state.get[0]), rows], ignore_index=True)
    rows = first_of_each(rows)
    if closed:                                    # the watermark passed while these rows were under way
        state.remove()
        yield rows.assign(side=MAIN)
    else:
        state.update((_packed(rows),))
        state.setTimeoutTimestamp(int(end))


def ordered_dedupe(stream: DataFrame, late: str = "1 day", bucket_seconds: int = 86_400, slots: int = SLOTS) -> DataFrame:
    """Log rows -> rows with a valid status and their ``side``: ``main`` (one per
    device and stamp, the smallest sequence of those in time), ``late`` or ``untimed``.

    A bucket closes when the newest time of earlier triggers is more than
    ``late`` past its end. A bucket's rows of one slot are held and emitted by one
    call: more ``slots`` or shorter buckets make that less. Sequences must not be null; a null ip is a device
    like any other. A failed poll moves the clock but hides no row; it is
    dropped inside the operator, so that every row counts in both branches (a
    branch without rows since a restart would hold the watermark back).
    """
    at = parse_ts("marca_de_tiempo").cast("timestamp")
    seconds = F.unix_timestamp(at)
    end = (F.floor(seconds / bucket_seconds) + 1) * bucket_seconds * 1000
    ok = F.coalesce(strip_ws(F.col("estado")) == F.lit(K.VALID_STATUS), F.lit(False))
    data = (stream.select(*_COLUMNS, ok.alias("_ok"), F.pmod(F.xxhash64("ip"), F.lit(slots)).alias("_slot"),
                          F.coalesce(end, F.lit(_NO_TIME)).cast("long").alias("_end"),
                          F.to_timestamp(F.lit(_NEVER_LATE)).alias("_time"))
            .withWatermark("_time", late))
    clock = stream.select(at.alias("_time")).where("_time is not null").withWatermark("_time", late)
    nothing = clock.where(F.col("_time") > F.to_timestamp(F.lit(_NEVER_LATE))).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA], F.lit(False).alias("_ok"),
        F.lit(None).cast("long").alias("_slot"), F.lit(None).cast("long").alias("_end"), "_time")
    both = nothing.unionByName(data)
    return both.groupBy("_slot", "_end").applyInPandasWithState(
        keep_first, OUT_SCHEMA, T.StructType([T.StructField("rows", T.BinaryType())]), "append",
        GroupStateTimeout.EventTimeTimeout)


def write_sides(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Drain every available file; a trigger's rows go to ``out/epoch=<batch id>/side=<side>``.

    A new checkpoint gets two state partitions a core, or the session's number of shuffle
    partitions if that is less: every trigger opens and commits each of them, even empty ones.
    """
    spark = rows.sparkSession
    width = spark.conf.get(_WIDTH)

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").partitionBy("side").parquet(f"{out}/epoch={epoch}")

    spark.conf.set(_WIDTH, str(min(int(width), 2 * spark.sparkContext.defaultParallelism)))
    try:
        q = (rows.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    finally:
        spark.conf.set(_WIDTH, width)
    q.awaitTermination()
    return q


def read_sides(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(T.StructType([*OUT_SCHEMA.fields, T.StructField("epoch", T.LongType())])).parquet(out)


def read_deduped(spark: SparkSession, out: str) -> DataFrame:
    """The clean log that the stream's outputs make.

    Main rows stand as they are unless a late row has their device and stamp;
    only those, the late rows themselves and the untimed ones are deduped again.
    """
    rows = read_sides(spark, out)
    main, late = rows.where(F.col("side") == MAIN).select(*_COLUMNS), rows.where(F.col("side") == LATE).select(*_COLUMNS)
    untimed = rows.where(F.col("side") == UNTIMED).select(*_COLUMNS)
    keys = late.select(*[F.col(k).alias(f"_{k}") for k in KEY]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY]
    again = main.join(keys, same, "left_semi").unionByName(late).unionByName(untimed)
    settled = main.join(keys, same, "left_anti").unionByName(dedupe_first(again, KEY, tie="seq"))
    return clean_history(settled, dedupe=False)


def closing_row(spark: SparkSession, stamp: str) -> DataFrame:
    """A poll that read nothing, at ``stamp``: it moves the clock and closes what is older."""
    return spark.createDataFrame([tuple({"seq": 0, "estado": "", "marca_de_tiempo": stamp}.get(c) for c in _COLUMNS)], LOG_SCHEMA)


def by_arrival(raw: DataFrame, files: int) -> list[DataFrame]:
    """The log cut into ``files`` deliveries: rows come up to 36 hours after their
    reading in no order, one in forty 12 days after it."""
    seconds = F.coalesce(F.unix_timestamp(parse_ts("marca_de_tiempo").cast("timestamp")), F.lit(0))
    draw = F.pmod(F.xxhash64("seq"), F.lit(40 * 129_600))
    arrival = seconds + F.when(F.floor(draw / 129_600) == 0, F.lit(12 * 86_400)).otherwise(draw % 129_600)
    lo, hi = raw.agg(F.min(F.when(seconds > 0, seconds)), F.max(arrival)).first()
    lo, span = lo or 0, max(1, (hi or 0) - (lo or 0) + 1)
    part = F.greatest(F.lit(0), F.floor((arrival - F.lit(lo)) * files / F.lit(span)))
    return [raw.filter(part == i) for i in range(files)]


def stream_dedupe_ordered(spark: SparkSession, sf_dir: str, files: int = 6) -> DataFrame:
    """Land the raw log as shuffled deliveries, each drained in one trigger however many files it
    has; the clean log from the stream's outputs."""
    land, out, ck = (scratch_path(spark, n) for n in ("landing-ordered", "log-ordered", "ck-ordered"))
    for part in [*by_arrival(X.history_raw(spark, sf_dir), files), closing_row(spark, "2100-01-01 00:00:00")]:
        part.write.mode("append").parquet(land)
        write_sides(ordered_dedupe(spark.readStream.schema(LOG_SCHEMA).parquet(land), late="8 days"), out, ck)
    for path in (land, ck):
        drop_path(spark, path)
    return read_deduped(spark, out)
