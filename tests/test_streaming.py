"""Structured Streaming ingest: watermark late-data rule and dedupe across
triggers (new semantics; the original has no streaming)."""

from supplyscope.session import scratch_path
from supplyscope.streaming import ingest as S

LOG = S.LOG_SCHEMA


def _batch(spark, rows):
    full = [(seq, "n", ip, "M", "50%", None, None, None, None, None, "OK", stamp) for seq, ip, stamp in rows]
    return spark.createDataFrame(full, LOG)


def test_dedupe_across_triggers_and_late_rows(spark):
    land, out, ck = (scratch_path(spark, n) for n in ("s-land", "s-out", "s-ck"))
    _batch(spark, [(1, "a", "2024-01-10 00:00:00"), (2, "a", "2024-01-10 00:00:00"),
                   (3, "a", "2024-01-12 00:00:00"), (4, "b", "bad stamp")]).write.mode("append").parquet(land)
    stream = spark.readStream.schema(LOG).parquet(land)
    S.run_append(S.dedupe_stream(stream, late="1 day"), out, ck)
    assert spark.read.parquet(out).count() == 2
    _batch(spark, [(5, "a", "2024-01-12 00:00:00"),      # duplicate inside the watermark -> dropped
                   (6, "a", "2024-01-05 00:00:00"),      # older than the watermark -> late, dropped
                   (7, "a", "2024-01-13 00:00:00")]).write.mode("append").parquet(land)
    stream = spark.readStream.schema(LOG).parquet(land)
    S.run_append(S.dedupe_stream(stream, late="1 day"), out, ck)
    got = sorted(r.marca_de_tiempo for r in spark.read.parquet(out).collect())
    assert got == ["2024-01-10 00:00:00", "2024-01-12 00:00:00", "2024-01-13 00:00:00"]


def test_status_first_and_unparsed_side_path(spark):
    land, out, ck, side, side_ck = (scratch_path(spark, n) for n in ("v-land", "v-out", "v-ck", "v-side", "v-sck"))
    rows = [(1, "n", "a", "M", "1%", None, None, None, None, None, "Fuera de Red", "2024-01-10 00:00:00"),
            (2, "n", "a", "M", "2%", None, None, None, None, None, " OK ", "2024-01-10 00:00:00"),
            (3, "n", "b", "M", "3%", None, None, None, None, None, "OK", "bad stamp")]
    spark.createDataFrame(rows, LOG).coalesce(1).write.parquet(land)
    stream = spark.readStream.schema(LOG).parquet(land)
    S.run_append(S.dedupe_stream(stream), out, ck)
    S.run_append(S.unparsed_stream(stream), side, side_ck)
    assert [r.seq for r in spark.read.parquet(out).collect()] == [2]
    assert [r.seq for r in spark.read.parquet(side).collect()] == [3]


def test_latest_level_complete_mode(spark):
    import datetime as dt

    land, out, ck = (scratch_path(spark, n) for n in ("l-land", "l-out", "l-ck"))
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 7, "click", t, 50.0), (2, 7, "click", t + dt.timedelta(days=1), 40.0), (3, 8, "view", t, 10.0)]
    spark.createDataFrame(rows, S.READING_SCHEMA).write.parquet(land)
    S.run_complete(S.latest_stream(spark.readStream.schema(S.READING_SCHEMA).parquet(land)), out, ck)
    got = {(r.device, r.supply): (r.pct, r.n, r.severity) for r in spark.read.parquet(out).collect()}
    assert got == {(7, "click"): (40.0, 2, None), (8, "view"): (10.0, 1, "low")}


def test_latest_level_updates_only_what_changed(spark):
    import datetime as dt

    land, out, ck = (scratch_path(spark, n) for n in ("u-land", "u-out", "u-ck"))
    t = dt.datetime(2024, 1, 1)
    days = lambda n: t + dt.timedelta(days=n)

    def send(rows):
        spark.createDataFrame(rows, S.READING_SCHEMA).coalesce(1).write.mode("append").parquet(land)

    def run():
        stream = S.latest_stream(spark.readStream.schema(S.READING_SCHEMA).option("maxFilesPerTrigger", 1).parquet(land))
        S.run_updates(stream, out, ck)
        return stream.schema

    send([(1, 7, "click", days(0), 50.0), (2, 8, "view", days(0), 10.0)])
    send([(3, 7, "click", days(2), 40.0), (4, 7, "click", days(1), 45.0)])
    schema = run()
    send([(5, 9, "view", days(0), 3.0)])
    run()
    keys = ["device", "supply"]
    got = {(r.device, r.supply): (r.pct, r.n, r.severity) for r in S.read_updated(spark, out, schema, keys).collect()}
    assert got == {(7, "click"): (40.0, 3, None), (8, "view"): (10.0, 1, "low"), (9, "view"): (3.0, 1, "low")}
    assert [spark.read.parquet(f"{out}/epoch={e}").count() for e in range(3)] == [2, 1, 1]
    small = S.compact_updates(spark, out, schema, keys, 2)
    assert {(r.device, r.supply): (r.pct, r.n, r.severity) for r in S.read_updated(spark, small, schema, keys).collect()} == got
