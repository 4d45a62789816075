import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from supplyscope.llm import mixing

from .helpers import AWKWARD, docs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Weights share the total; whoever would exceed three times its size stops there, and the rest share again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(sizes), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > 3 * sizes[s] + 1e-9}
        if not full:
            return out | {s: level * w[s] for s in open_}
        for s in full:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def check(spark, rows, block):
    df = docs(spark, rows)
    got = mixing.taken_words(df, block=block).collect()
    size = [len(WORDS.findall(t or "")) for _, t, _ in rows]
    assert Counter((i, n) for (i, _, _), n in zip(rows, size)) == Counter((r.doc, r["size"]) for r in got)
    by = Counter()
    for (_, _, s), n in zip(rows, size):
        by[s] += n
    want = targets(by)
    order = sorted((s for s in by if s is not None)) + [s for s in by if s is None]
    taken = defaultdict(int)
    for r in got:
        s = order[r.sid]
        assert r.source_size == by[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    for s in by:
        assert abs(taken[s] - want[s]) <= 2 * block
    return sorted((str(r.doc), r["size"], r.taken) for r in got)


def test_awkward_rows_and_reruns(spark):
    assert check(spark, AWKWARD, 4) == check(spark, AWKWARD, 4)


def test_hot_source_and_caps(spark):
    rows = [(i, "w " * (1 + i % 40), "hot") for i in range(300)] + [(1000 + i, "x y z", f"s{i % 5}") for i in range(60)]
    check(spark, rows, 8)


def test_permutation_is_one_to_one(spark):
    for n in (1, 2, 7, 100, 257):
        x = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("p"))
        assert sorted(r.p for r in x.collect()) == list(range(n))


def test_slots_read_every_block_evenly(spark):
    df = docs(spark, [(i, "w " * 37, "abc"[i % 3]) for i in range(60)])
    out = mixing.mix(df, block=8)
    uses = out.select("sid", "block", "shard", "slot").distinct().groupBy("sid", "block").count()
    for r in uses.groupBy("sid").agg(F.min("count").alias("a"), F.max("count").alias("b")).collect():
        assert r.b - r.a <= 1 and r.b <= 3
    slots = [(r.shard, r.slot) for r in out.select("shard", "slot").distinct().collect()]
    assert sorted(s * mixing.SHARD_SLOTS + t for s, t in slots) == list(range(len(slots)))


def plan_of(spark, slots):
    """A source plan with these numbers of slots, half as many blocks."""
    rows, first = [], 0
    for sid, n in enumerate(slots):
        rows.append((sid, n, max(1, -(-n // 2)), first, sum(slots)))
        first += n
    return spark.createDataFrame(rows, "sid long, slots long, blocks long, first_slot long, all_slots long")


def test_the_draw_fills_shards_and_meets_totals(spark):
    """Shards are full, sources have their totals, numbers go on from shard to shard, and counts spread as a draw without replacement does."""
    slots, size = [6000, 300, 1700, 0, 1], 100
    got = mixing.drawn(plan_of(spark, slots), seed=3, shard_slots=size).collect()
    by_shard, by_source = Counter(), Counter()
    for r in sorted(got, key=lambda r: r.shard):
        assert r["from"] == by_source[r.sid]
        by_shard[r.shard] += r["count"]
        by_source[r.sid] += r["count"]
    assert by_source == {i: n for i, n in enumerate(slots) if n} and set(range(81)) == set(by_shard)
    assert all(by_shard[h] == size for h in range(80)) and by_shard[80] == 1
    share = 6000 / 8001
    counts = [sum(r["count"] for r in got if r.shard == h and r.sid == 0) for h in range(80)]
    spread = sum((c - size * share) ** 2 for c in counts) / 80
    assert 0.5 < spread / (size * share * (1 - share)) < 1.7
    assert got != mixing.drawn(plan_of(spark, slots), seed=4, shard_slots=size).collect()


def test_slots_come_from_the_counts(spark):
    """Every (shard, slot) once; in a pass every block once; the counts of the draw are those of the slots."""
    plan = plan_of(spark, [500, 41, 160])
    out = mixing.slots(plan, seed=1, shard_slots=64).collect()
    want = {(r.shard, r.sid): r["count"] for r in mixing.drawn(plan, seed=1, shard_slots=64).collect()}
    assert Counter((r.shard, r.sid) for r in out) == want
    assert sorted(r.shard * 64 + r.slot for r in out) == list(range(701))
    for sid, n in enumerate((500, 41, 160)):
        blocks = -(-n // 2)
        assert sorted((r["pass"], r.block) for r in out if r.sid == sid)[:blocks] == [(0, b) for b in range(blocks)]


def test_the_result_comes_through_the_draw(spark, monkeypatch):
    """op1 takes what the shards' counts say: a draw with fewer slots, in another shard, shows in its rows."""
    from supplyscope.llm.queries import op1_mix_sources

    sf, real = "/root/testdata/sf0.001", mixing.drawn
    rows = op1_mix_sources(spark, sf).collect()
    assert all((r.taken > 0) == (r.first_shard is not None) and (r.last_shard or 0) >= (r.first_shard or 0) for r in rows)
    assert rows == op1_mix_sources(spark, sf).collect() or sorted(rows) == sorted(op1_mix_sources(spark, sf).collect())
    few = lambda *a, **k: real(*a, **k).withColumn("count", F.ceil(F.col("count") / 2)).withColumn("shard", F.col("shard") + 70)
    monkeypatch.setattr(mixing, "drawn", few)
    half = op1_mix_sources(spark, sf).collect()
    assert 0 < sum(r.taken for r in half) < 0.7 * sum(r.taken for r in rows)
    assert {r.first_shard for r in half if r.taken} <= set(range(70, 200))


def test_sums_ahead_in_two_steps(spark):
    df = spark.range(50).select((F.col("id") % 2).alias("g"), F.floor(F.col("id") / 2).alias("at"), (F.col("id") * 3).alias("v"))
    for width in (1, 4, 100):
        got = {(r.g, r.at): r.b for r in mixing.before(df, "g", "at", "v", "b", width).collect()}
        assert got == {(g, a): sum(3 * (2 * x + g) for x in range(a)) for g in (0, 1) for a in range(25)}


def test_ranges_in_bounded_steps(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_RUN", 3)
    df = spark.createDataFrame([(0, 0, 25), (1, 5, 5), (2, 4, 3)], "sid long, a long, b long")
    got = mixing.explode_range(df, F.col("a"), F.col("b"), "i", 4).collect()
    assert sorted((r.sid, r.i) for r in got) == [(0, i) for i in range(26)] + [(1, 5)]


def test_mixed_documents(spark):
    df = docs(spark, AWKWARD)
    out = mixing.mixed_documents(df, block=4)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    rows = Counter((r.doc_id, r.text) for r in out.collect())
    known = Counter((r.doc_id, r.text) for r in df.collect())
    assert set(rows) <= set(known)
    for k, n in rows.items():
        assert n <= 3 * known[k]
        if not WORDS.findall(k[1] or ""):
            assert n == known[k]


def test_empty_table(spark):
    assert mixing.taken_words(docs(spark, [])).count() == 0
    assert mixing.mixed_documents(docs(spark, [])).count() == 0


def test_rows_with_one_id_are_rounded_each_for_itself(spark):
    """Distinct long texts without an id, and copies of one row: the mix meets the targets of their sources."""
    rows = [(None, f"t{i} " + "w " * 19, "a") for i in range(400)] + [(7, "v " * 20, "b")] * 200
    rows += [(i, "u " * 20 + f"x{i}", "c") for i in range(400)]
    df = docs(spark, rows)
    plan = {r.src: r.target / r.source_size for r in mixing.source_plan(mixing.sized(df)).collect()}
    assert sum(0.05 < t % 1 < 0.95 for t in plan.values()) >= 2          # there is something to round
    got = Counter(r.source for r in mixing.mixed_documents(df).collect())
    for s, n in (("a", 400), ("b", 200), ("c", 400)):
        assert abs(got[s] - plan[s] * n) <= 4 * (n / 4) ** 0.5 + 10
    pieces = mixing.packed(mixing.sized(df), mixing.source_plan(mixing.sized(df)).withColumn("pieces", F.lit(4).cast("long")))
    assert pieces.where("doc is null").agg(F.countDistinct("start")).first()[0] == 400
