"""Balanced label propagation: documents to shards, in DataFrame expressions only.

Law ``rows``: shard counts differ by one at most. Documents with equal texts
are linked; a group of copies is a star around its text's hash, so ``m``
copies cost ``m`` rows and never ``m * m`` links.

Each round counts, per group and shard, the linked members (a partial
aggregation, then a join by group), and the members of a group move to the
shard that holds most of them among those whose quota has room. The share of a
shard's demand that its room covers decides by a hash of the group which
groups move, so that copies move together; the others choose again in the next
round. A group larger than a shard's quota fills several shards by hashed
parts. Unlinked documents then fill the shards up to their exact quota; only
what exceeds a quota moves on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyscope.llm.common import reliable

SHARDS = 8
ROUNDS = 5
PIECE_ROWS = 50_000        # rows of one piece of a shard when slots are numbered


def nodes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, size, crc, g, g2, row)`` per row, lineage cut; ``g``, ``g2`` are hashes of the
    text (null reads as empty), ``row`` tells copies with one id apart."""
    t = F.coalesce(F.col(text), F.lit(""))
    return reliable(docs.select(F.col(key).alias("doc"), (F.octet_length(t).cast("long") + 1).alias("size"),
                                F.crc32(t.cast("binary")).alias("crc"), F.xxhash64(t).alias("g"),
                                F.xxhash64(F.lit(1), t).alias("g2"), F.monotonically_increasing_id().alias("row")))


def start_shard(shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), "doc", "g"), F.lit(shards)).cast("int")


def propagate(linked: DataFrame, total: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``linked(doc, row, g, g2, n, shard)`` with the members of each group moved to one shard, as far as quotas allow.

    What a round takes to the driver is two numbers a shard.
    """
    quota = total // shards
    by = ["g", "g2", "part"]
    # A group above a quota is cut into parts that fit one: each part moves as a group of its own.
    parts = F.ceil(F.col("n") / F.lit(max(1, quota))).cast("int")
    now = linked.withColumn("part", F.pmod(F.xxhash64(F.lit(3), "doc", "row"), parts).cast("int"))
    for r in range(rounds):
        held = now.groupBy(*by, "shard").agg(F.count(F.lit(1)).alias("c"))
        home = held.groupBy(*by).agg(F.count(F.lit(1)).alias("k"), F.sum("c").alias("c"), F.min("shard").alias("shard"))
        load = {x["shard"]: x["c"] for x in home.where("k = 1").groupBy("shard").agg(F.sum("c").alias("c")).collect()}
        room = {s: quota - load.get(s, 0) for s in range(shards) if load.get(s, 0) < quota}
        if not room:
            break
        # The shard with most neighbours among those with room; without any, one of them by hash.
        near = F.struct("c", F.xxhash64(F.lit(r), *by, "shard").alias("tie"), "shard")
        best = held.groupBy(*by).agg(F.count(F.lit(1)).alias("k"), F.sum("c").alias("members"),
                                     F.max(F.when(F.col("shard").isin(*room), near)).alias("b")).where("k > 1")
        any_ = F.element_at(F.array(*map(F.lit, room)), (F.pmod(F.xxhash64(F.lit(r), *by), F.lit(len(room))) + 1).cast("int"))
        best = best.select(*by, "members", F.coalesce("b.shard", any_).alias("to"))
        asked = {x["to"]: x["c"] for x in best.groupBy("to").agg(F.sum("members").alias("c")).collect()}
        if not asked:
            break
        share = F.element_at(F.array(*[F.lit(min(1.0, room.get(s, 0) / asked[s]) if s in asked else 0.0)
                                       for s in range(shards)]), F.col("to") + 1)
        draw = F.pmod(F.xxhash64(F.lit(11 + r), *by), F.lit(1 << 20)) / F.lit(float(1 << 20))
        goes = best.where(draw < share).select(*by, "to")
        now = reliable(now.join(goes, by, "left").withColumn("shard", F.coalesce("to", "shard")).drop("to"))
    return now.drop("part")


def numbered(rows: DataFrame, total: int) -> DataFrame:
    """Adds ``rank``, gapless from 0 in each shard, linked documents first and
    copies next to each other; two-level counts, no window over a whole shard."""
    pieces = max(1, -(-total // PIECE_ROWS))
    # Copies share a piece; a large group of copies is spread over pieces of its own.
    spread = F.when(F.col("n") > PIECE_ROWS, F.pmod(F.xxhash64(F.lit(5), "doc", "row"), F.ceil(F.col("n") / PIECE_ROWS)))
    rows = rows.withColumn("single", (F.col("n") == 1).cast("int"))
    rows = rows.withColumn("piece", F.pmod("g", F.lit(pieces))).withColumn("sub", F.coalesce(spread, F.lit(0)))
    by = ["shard", "single", "piece", "sub"]
    inside = Window.partitionBy(*by).orderBy("g", "g2", F.col("doc").asc_nulls_first())
    rows = rows.withColumn("_i", F.row_number().over(inside).cast("long") - 1)
    count = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_c"))
    over = Window.partitionBy("shard").orderBy("single", "piece", "sub")
    count = count.withColumn("_before", F.sum("_c").over(over) - F.col("_c")).drop("_c")
    return rows.join(count, by).withColumn("rank", F.col("_i") + F.col("_before")).drop("_i", "_before", *by[1:])


def fill(ranked: DataFrame, total: int, shards: int = SHARDS) -> DataFrame:
    """Exact quotas: rows ranked beyond their shard's quota go, in order, to the free slots."""
    have = {r["shard"]: r["c"] for r in ranked.groupBy("shard").agg(F.count(F.lit(1)).alias("c")).collect()}
    quota = [total // shards + (s < total % shards) for s in range(shards)]           # `shards` numbers
    over, under, moved, free = [], [], 0, 0
    for s in range(shards):
        over.append(moved - quota[s])                      # rank + over[s] = place among all that move
        moved += max(0, have.get(s, 0) - quota[s])
        under.append(free)
        free += max(0, quota[s] - have.get(s, 0))
    pick = lambda values, at: F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), at + 1)
    place = F.col("rank") + pick(over, F.col("shard"))
    goes = F.col("rank") >= pick(quota, F.col("shard"))
    to = F.lit(0)
    for s in range(1, shards):
        if quota[s] > have.get(s, 0):                      # the last shard whose free slots begin at or before it
            to = F.when(F.col("place") >= under[s], F.lit(s)).otherwise(to)
    first = next((s for s in range(shards) if quota[s] > have.get(s, 0)), 0)
    to = F.when(F.col("place") >= 0, F.greatest(to, F.lit(first)))
    out = ranked.withColumn("place", F.when(goes, place)).withColumn("to", to)
    slot = pick([have.get(s, 0) for s in range(shards)], F.col("to")) + F.col("place") - pick(under, F.col("to"))
    return (out.withColumn("slot", F.when(goes, slot).otherwise(F.col("rank")))
            .withColumn("shard", F.when(goes, F.col("to")).otherwise(F.col("shard"))).drop("rank", "place", "to"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``(doc, size, crc, law, shard, slot)`` for every row of ``docs``.

    Sizes are UTF-8 bytes plus 1. A null text counts as the empty text (size
    1, crc 0) and is grouped with it. Null or repeated ids are rows of their
    own. Empty tables give an empty result, tables smaller than ``shards``
    leave the last shards empty. Only the two named columns are read.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    rows = nodes(docs, key, text)
    total = rows.count()
    groups = rows.groupBy("g", "g2").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("shard", start_shard(shards))
    copies = reliable(groups.where("n > 1"))
    # A join between plain exchanges may be split at a hot group; one next to an aggregation by group may not.
    linked = propagate(reliable(rows.join(copies, ["g", "g2"])), total, shards, rounds)
    single = rows.join(copies, ["g", "g2"], "left_anti").withColumn("n", F.lit(1).cast("long"))
    ranked = reliable(numbered(linked.unionByName(single), total))
    out = fill(ranked, total, shards)
    return out.select("doc", "size", "crc", F.lit("rows").alias("law"), F.col("shard").cast("int"), "slot")
