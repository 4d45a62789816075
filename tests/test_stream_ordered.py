"""Streaming dedupe by the batch's rule: smallest sequence, late and untimed rows on side outputs."""

import pytest

from supplyscope.operators.history import clean_history
from supplyscope.session import scratch_path
from supplyscope.streaming import ordered as O
from supplyscope.streaming.ingest import LOG_SCHEMA


def row(seq, ip, stamp, level="50%", estado="OK"):
    return (seq, "n", ip, "M", level, None, None, None, None, None, estado, stamp)


class Feed:
    """Files that land one after the other, one a trigger."""

    def __init__(self, spark, late="1 day"):
        self.spark, self.late = spark, late
        self.land, self.out, self.ck = (scratch_path(spark, n) for n in ("o-land", "o-out", "o-ck"))
        self.rows = []

    def send(self, rows):
        self.rows += rows
        self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.land)
        return self

    def close(self):
        O.closing_row(self.spark, "2090-01-01 00:00:00").write.mode("append").parquet(self.land)
        return self

    def run(self):
        stream = self.spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(self.land)
        O.write_sides(O.ordered_dedupe(stream, late=self.late), self.out, self.ck)
        return self

    def sides(self):
        got = {}
        for r in O.read_sides(self.spark, self.out).collect():
            got.setdefault(r.side, []).append(r.seq)
        return {k: sorted(v) for k, v in got.items()}

    def check(self):
        got = O.read_deduped(self.spark, self.out)
        want = clean_history(self.spark.createDataFrame(self.rows, LOG_SCHEMA))
        assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_smallest_sequence_wins_whatever_the_order(spark):
    f = Feed(spark).send([row(9, "a", "2024-01-10 01:00:00", "9%"), row(8, "b", "2024-01-10 02:00:00", "8%")])
    f.send([row(2, "a", "2024-01-10 01:00:00", "2%"), row(20, "a", "2024-01-11 01:00:00", "20%")])
    f.send([row(5, "a", "2024-01-10 01:00:00", "5%"), row(1, "b", "2024-01-10 02:00:00", "", "Fuera de Red")])
    f.close().run()
    assert f.sides() == {"main": [2, 8, 20]}
    f.check()


def test_late_rows_go_to_the_side_and_are_settled(spark):
    f = Feed(spark).send([row(5, "a", "2024-01-10 01:00:00"), row(6, "b", "2024-01-10 01:00:00")])
    f.send([row(10, "a", "2024-01-20 01:00:00")])
    f.send([row(11, "c", "2024-01-20 02:00:00")])
    f.send([row(1, "a", "2024-01-10 01:00:00", "1%"),          # smaller, but its bucket is closed
            row(12, "b", "2024-01-10 01:00:00", "12%"),         # a late repetition
            row(13, "b", "2024-01-09 01:00:00", "13%"),         # a reading nobody has
            row(14, None, "2024-01-09 01:00:00", "14%")])
    f.close().run()
    assert f.sides() == {"main": [5, 6, 10, 11], "late": [1, 12, 13, 14]}
    f.check()


def test_untimed_rows_and_null_keys(spark):
    f = Feed(spark).send([row(5, "a", "soon"), row(6, None, "2024-01-10 01:00:00"), row(7, "a", None)])
    f.send([row(3, "a", "soon"), row(4, None, "2024-01-10 01:00:00"), row(8, "a", "soon", "x", "Error")])
    f.close().run()
    assert f.sides() == {"untimed": [3, 5, 7], "main": [4]}
    f.check()


def test_goes_on_from_its_checkpoint(spark):
    f = Feed(spark).send([row(5, "a", "2024-01-10 01:00:00")]).run()
    assert f.sides() == {}                                       # still open
    f.send([row(3, "a", "2024-01-10 01:00:00")]).run()
    f.close().run()
    assert f.sides() == {"main": [3]}
    f.check()


def test_a_repeated_batch_replaces_itself(spark):
    f = Feed(spark).send([row(5, "a", "2024-01-10 01:00:00"), row(6, "a", "late?")]).close().run()
    before = sorted(map(str, O.read_sides(spark, f.out).collect()))
    again = Feed(spark)                                          # the same files from the start into the same sink
    again.land, again.out, again.rows = f.land, f.out, f.rows
    again.run()
    assert sorted(map(str, O.read_sides(spark, f.out).collect())) == before
    f.check()


def test_empty_stream(spark):
    f = Feed(spark).send([]).run()
    assert O.read_sides(spark, f.out).collect() == []


@pytest.mark.parametrize("files", [3])
def test_deliveries_keep_every_row(spark, files):
    from supplyscope.sources import fixtures as X

    raw = X.history_raw(spark, "/root/testdata/sf0.001")
    assert sum(p.count() for p in O.by_arrival(raw, files)) == raw.count()


def test_groups_follow_slots_and_buckets_not_devices(spark):
    """Devices of a slot share a group; each keeps its own smallest sequence."""
    sent = [row(1000 + i, f"d{i % 500}", f"2024-01-1{i % 2} 01:00:00") for i in range(2000)] + [row(3000, None, "2024-01-10 01:00:00")]
    f = Feed(spark).send(sent).send([row(7, "d3", "2024-01-11 01:00:00"), row(8, None, "2024-01-10 01:00:00")]).run()
    held = spark.read.format("statestore").load(f.ck)
    assert 0 < held.count() <= 2 * O.SLOTS
    f.close().run()
    f.check()


def test_a_delivery_of_many_files_is_one_trigger(spark, monkeypatch):
    epochs = []
    write = O.write_sides

    def counted(rows, out, ck):
        q = write(rows, out, ck)
        epochs.append([p["batchId"] for p in q.recentProgress if p["numInputRows"]])
        return q

    monkeypatch.setattr(O, "write_sides", counted)
    monkeypatch.setattr(O, "by_arrival", lambda raw, files: [raw.repartition(5)])
    width = spark.conf.get("spark.sql.shuffle.partitions")
    got = O.stream_dedupe_ordered(spark, "/root/testdata/sf0.001")
    want = clean_history(O.X.history_raw(spark, "/root/testdata/sf0.001"))
    assert [len(e) for e in epochs] == [1, 1] and spark.conf.get("spark.sql.shuffle.partitions") == width
    assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
