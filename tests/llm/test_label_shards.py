import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from supplyscope.llm import label_shards as L

from .helpers import AWKWARD, docs


def check(spark, rows, shards=8):
    got = L.shard_documents(docs(spark, rows), shards).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc, r["size"], r.crc) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r.law == "rows" and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s in slots:
        assert sorted(slots[s]) == list(range(len(slots[s])))
    return got


def split(got, rows):
    text = {i: t for i, t, _ in rows}
    by = defaultdict(set)
    for r in got:
        by[text[r.doc]].add(r.shard)
    return sum(len(s) > 1 for s in by.values())


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_awkward_rows(spark, shards):
    check(spark, AWKWARD, shards)


def test_copies_come_together(spark):
    rows = [(i, f"group {i // 5}" if i < 200 else f"single {i}", "s") for i in range(800)]
    assert split(check(spark, rows), rows) <= 2


def test_linked_groups_only(spark):
    rows = [(i, f"group {i // 7}", "s") for i in range(560)]
    assert split(check(spark, rows), rows) <= 16          # a cut in each shard at most, and where it goes on


def test_group_of_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(L, "PIECE_ROWS", 40)
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}", "s") for i in range(900)]
    got = check(spark, rows)
    per = Counter(r.shard for r in got if rows[r.doc][1] == "hot")
    assert len([s for s in per if per[s] > 5]) <= 4        # 300 copies need three shards of 112


def test_empty_table(spark):
    assert L.shard_documents(docs(spark, [])).count() == 0


def test_copies_without_an_id_are_split_like_others(spark, monkeypatch):
    """A group above the quota is dealt over several parts also if its rows have no id."""
    rows = L.nodes(docs(spark, [(None, "same text", "s")] * 400).repartition(4))
    rows = rows.withColumn("n", F.lit(400).cast("long")).withColumn("shard", F.monotonically_increasing_id() % 8)
    seen = []
    monkeypatch.setattr(L, "reliable", lambda df: seen.append(df) or df)
    moved = L.propagate(rows.withColumn("shard", F.col("shard").cast("int")), 400, rounds=1)
    assert moved.count() == 400 and seen[0].groupBy("part").count().count() == 8
