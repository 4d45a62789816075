"""End-to-end jobs over stored tables (what a scheduler runs).

* ``refresh_job``: class-partitioned inventory + poll results -> refreshed
  inventory (dynamic partition overwrite, only the refreshed classes are
  replaced) and one appended history batch.
* ``forecast_job``: history log -> forecast table.
* ``update_forecast_job``: one appended batch + stored forecast state -> next
  state and forecast table, without reading the log.

Outputs never overwrite the table being read: callers stage to a new path
and swap.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyscope import config as K
from supplyscope.operators import incremental as I
from supplyscope.operators.history import history_batch
from supplyscope.plans.forecast_jobs import fleet_forecast_ema, fleet_forecast_linear
from supplyscope.plans.refresh import refresh_inventory
from supplyscope.sources.tables import (append_log, check_schema, read_class_tables, read_history,
                                        write_class_tables, write_overwrite)

POLL_SCHEMA = T.StructType([
    T.StructField("device_class", T.StringType()), T.StructField("ip", T.StringType()),
    T.StructField("seq", T.LongType()), T.StructField("toner_negro", T.StringType()),
    T.StructField("toner_cian", T.StringType()), T.StructField("toner_magenta", T.StringType()),
    T.StructField("toner_amarillo", T.StringType()), T.StructField("kit_mant", T.StringType()),
    T.StructField("kit_alim", T.StringType()), T.StructField("estado", T.StringType()),
    T.StructField("marca_de_tiempo", T.StringType()),
])

SEQ_PER_RUN = 1_000_000_000   # ingest sequence: run id * this + device id


def refresh_job(spark: SparkSession, inventory_path: str, poll_path: str, out_path: str,
                log_path: str | None = None, classes: list[str] | None = None, run_id: int | None = None) -> int:
    """Refresh the given classes (all when None); returns the logged row count.

    ``run_id`` orders the runs in the log and makes its sequence unique; it is
    the time of the run in seconds unless given."""
    if out_path.rstrip("/") == inventory_path.rstrip("/"):
        raise ValueError("stage the refreshed inventory to a new path, then swap")
    inv = read_class_tables(spark, inventory_path, classes)
    poll = check_schema(spark.read.schema(POLL_SCHEMA).parquet(poll_path), ["device_class", "ip"], poll_path)
    if classes:
        poll = poll.filter(F.col("device_class").isin(classes))
    out = refresh_inventory(inv, poll)
    write_class_tables(out, out_path)
    if not log_path:
        return 0
    done = read_class_tables(spark, out_path, classes)
    run_id = int(time.time()) if run_id is None else run_id
    seq = F.lit(run_id).cast("bigint") * F.lit(SEQ_PER_RUN) + F.col("device_id")
    return append_log(history_batch(done.withColumn("seq", seq)), log_path)


def with_display_names(forecast: DataFrame) -> DataFrame:
    """The forecast's columns under the names a report shows, in report order."""
    return forecast.select(*[F.col(c).alias(name) for name, c in K.FORECAST_COLUMNS.items() if c in forecast.columns])


def forecast_job(spark: SparkSession, log_path: str, out_path: str, method: str = "ema") -> None:
    """Forecast every series of the stored log and write the table."""
    if out_path.rstrip("/") == log_path.rstrip("/"):
        raise ValueError("the forecast must not overwrite the log")
    log = read_history(spark, log_path)
    job = fleet_forecast_ema if method == "ema" else fleet_forecast_linear
    write_overwrite(job(log), out_path)


def update_forecast_job(spark: SparkSession, batch_path: str, old_state: str | None, new_state: str, out_path: str,
                        late_path: str | None = None) -> int:
    """Take one appended batch of the log into the forecast state (none before the
    first) and write the forecast; returns the number of late rows, which are
    written to ``late_path`` when given (a device with late readings is due for
    :func:`supplyscope.operators.incremental.rebuild`)."""
    if old_state is not None and new_state.rstrip("/") == old_state.rstrip("/"):
        raise ValueError("write the next state to a new path")
    state = I.empty_state(spark) if old_state is None else I.read_state(spark, old_state)
    state, late = I.update(state, read_history(spark, batch_path))
    state = I.write_state(state, new_state)
    write_overwrite(I.forecast_of(state), out_path)
    if late_path is not None:
        write_overwrite(late, late_path)
        late = spark.read.parquet(late_path)
    return late.count()
