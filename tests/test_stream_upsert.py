"""Poll results as a stream into a class-partitioned device table."""

import os

from pyspark.sql import functions as F

from supplyscope.functions.scalars import format_ip
from supplyscope.plans import refresh as R
from supplyscope.session import scratch_path
from supplyscope.sources.tables import INVENTORY_SCHEMA
from supplyscope.streaming.upsert import ClassTable, run_upserts

POLL = "device_class string, ip string, seq long, toner_negro string, estado string, marca_de_tiempo string"
CLASSES = ["Color Admin", "HP Admin", "HP Planta"]


def inventory(spark):
    rows = [{"device_id": i, "nombre": f"n{i}", "device_class": CLASSES[i % 3] if i < 9 else None, "ip": f"192.168.100.10{i}",
             "modelo": "M", "toner_negro": "10%", "estado": "OK", "marca_de_tiempo": "t0"} for i in range(10)]
    df = spark.createDataFrame([tuple(r.get(c) for c in INVENTORY_SCHEMA.names) for r in rows], INVENTORY_SCHEMA)
    return df.withColumn("ip", format_ip("ip"))


def poll(spark, rows):
    return spark.createDataFrame([(CLASSES[i % 3], f"192.168.100.10{i}", seq, level, estado, t) for i, seq, level, estado, t in rows], POLL)


def files(root):
    """Path and time of every data file."""
    base = root.removeprefix("file:")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(base) for f in fs if f.endswith(".parquet")}


def levels(table):
    return {r.device_id: (r.toner_negro, r.estado, r.marca_de_tiempo) for r in table.read().collect()}


def store(spark):
    t = ClassTable(spark, scratch_path(spark, "u-inv"))
    t.start(inventory(spark))
    return t


def test_only_touched_classes_are_rewritten(spark):
    t = store(spark)
    before = files(t.root)
    assert t.upsert(poll(spark, [(1, 1, "77.6 %", "OK", "t1"), (4, 2, "", "Fuera de Red", "t1")]), 0, R.refresh_keyed)
    after = files(t.root)
    assert before.items() <= after.items()
    assert all("device_class=HP Admin" in p for p in after.keys() - before.keys())
    got = levels(t)
    assert len(got) == 10 and got[1] == ("78%", "OK", "t1") and got[4] == ("10%", "Fuera de Red", "t1")
    assert got[0] == ("10%", "OK", "t0") and got[9] == ("10%", "OK", "t0")
    assert t.current() == {"device_class=Color Admin": 0, "device_class=HP Planta": 0, "device_class=HP Admin": 1,
                           "device_class=__HIVE_DEFAULT_PARTITION__": 0}


def test_a_repeated_batch_changes_nothing(spark):
    t = store(spark)
    b = poll(spark, [(1, 1, "50%", "OK", "t1"), (2, 1, "40%", "OK", "t1")])
    assert t.upsert(b, 0, R.refresh_keyed)
    was, content = files(t.root), levels(t)
    assert not t.upsert(b, 0, R.refresh_keyed)
    assert files(t.root) == was and levels(t) == content


def test_a_half_written_version_is_replaced(spark):
    t = store(spark)
    b = poll(spark, [(1, 1, "50%", "OK", "t1")])
    t.upsert(b, 0, R.refresh_keyed)
    want = levels(t)
    os.remove(t.root.removeprefix("file:") + "/v=1/_SUCCESS")      # as if the job had died before its commit
    assert levels(t)[1] == ("10%", "OK", "t0")                     # readers see the version before
    assert t.upsert(b, 0, R.refresh_keyed) and levels(t) == want


def test_batches_build_on_each_other_and_old_versions_go(spark):
    t = store(spark)
    for b, level in enumerate(["50%", "40%", "30%"]):
        t.upsert(poll(spark, [(1, 1, level, "OK", f"t{b}")]), b, R.refresh_keyed)
    t.upsert(poll(spark, []), 3, R.refresh_keyed)
    want = levels(t)
    assert want[1] == ("30%", "OK", "t2")
    assert t.vacuum(1) == 3 and levels(t) == want and t.vacuum(1) == 0
    assert ClassTable(spark, t.root).read().count() == 10          # opened anew


def test_stream_equals_the_batch_refresh(spark):
    rows = [(i, i, f"{90 - i}.4%", "OK" if i % 4 else "Fuera de Red", "t1") for i in range(9)] + [(1, 50, "1%", "OK", "t1")]
    every = poll(spark, rows)
    land, ck = scratch_path(spark, "u-land"), scratch_path(spark, "u-ck")
    for c in CLASSES:
        every.filter(F.col("device_class") == c).coalesce(1).write.mode("append").parquet(land)
    t = store(spark)
    stream = spark.readStream.schema(POLL).option("maxFilesPerTrigger", 1).parquet(land)
    run_upserts(stream, t, R.refresh_keyed, ck)
    want = R.refresh_keyed(inventory(spark), every)
    key = lambda df: sorted(map(tuple, df.select(INVENTORY_SCHEMA.names).collect()), key=str)
    assert len(t.versions()) == 4
    assert key(t.read().filter("device_class is not null")) == key(want.filter("device_class is not null"))
    was = files(t.root)
    run_upserts(stream, t, R.refresh_keyed, scratch_path(spark, "u-ck2"))      # replayed from the start: all ids are known
    assert files(t.root) == was


def test_empty_table(spark):
    t = ClassTable(spark, scratch_path(spark, "u-none"))
    t.start(inventory(spark).limit(0))
    assert t.read().collect() == [] and not t.upsert(poll(spark, []), 0, R.refresh_keyed)


def test_a_delivery_of_many_files_is_one_version(spark, monkeypatch):
    from supplyscope.plans import catalog

    polled, versions, vacuum = catalog._poll, [], ClassTable.vacuum
    monkeypatch.setattr(catalog, "_poll", lambda s, d: polled(s, d).repartition(7))
    monkeypatch.setattr(ClassTable, "vacuum", lambda self, keep: versions.extend(self.versions()) or vacuum(self, keep))
    got = catalog.stream_refresh(spark, "/root/testdata/sf0.001")
    want = catalog.refresh_inventory(spark, "/root/testdata/sf0.001")
    assert versions == list(range(7))                              # the inventory and two deliveries of three classes
    assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
