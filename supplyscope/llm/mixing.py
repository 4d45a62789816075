"""Mixing sources to target weights, in DataFrame expressions only.

1. Sizes: words per document, summed per source.
2. Targets: weights 5, 2, 1 in turn over the sources by code point (null
   last) share all words; no target exceeds ``max_repeats`` times its source.
3. Packing: each source's documents form one word stream (in hash order of
   id and text), cut into blocks of ``block`` words.
4. Drawing: the mix has one slot per drawn block. A pseudorandom permutation
   deals all slots to output shards of ``SHARD_SLOTS``, and each shard counts
   its sources: multinomial counts given the corpus totals, so shards vary and
   the whole mix meets its targets.
5. Mapping: a source's counts, shard after shard, number its slots; slot ``j``
   reads block ``p(j mod blocks)`` under the pseudorandom permutation of pass
   ``j div blocks``. A block is read at most ``max_repeats`` times and passes
   differ in order.
6. The slots join the packed blocks by (source, block index).

Nothing is collected; every large step is keyed by document, block or slot,
so a source holding most rows spreads like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyscope.llm.common import WORD_REGEX, reliable

WEIGHTS = (5, 2, 1)        # in turn, over the sources in code-point order
MAX_REPEATS = 3
BLOCK = 64                 # words of a block
SHARD_SLOTS = 4096         # slots of an output shard
PIECE_DOCS = 2_000         # documents of one piece of a source's stream
TASK_SLOTS = 1 << 18       # slots that a task makes
ROUNDS = 12                # swap-or-not rounds of a permutation
_RUN = 4096                # longest array that one row explodes into


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """Position of ``x`` (0 <= x < n) in a keyed pseudorandom permutation of
    0..n-1, for any ``n``: in each round ``x`` and its mirror ``k - x mod n``
    change places or not, by a hash of the larger of the two."""
    def swap(acc: Column, i: Column) -> Column:
        mirror = F.pmod(F.xxhash64(i, *key) - acc, n)
        return F.when(F.pmod(F.xxhash64(i, F.greatest(acc, mirror), *key), F.lit(2)) == 1, mirror).otherwise(acc)

    # Never null, so that a join on it does not evaluate it once more to see.
    return F.coalesce(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, swap), F.lit(-1).cast("long"))


def explode_range(df: DataFrame, first: Column, last: Column, name: str, tasks: int | None = None) -> DataFrame:
    """One row per integer of first..last, in steps of arrays of at most ``_RUN`` entries for
    up to ``_RUN ** 3`` integers; ``tasks`` deals the runs before the last step."""
    df = df.withColumn("_f", first.cast("long")).withColumn("_l", last.cast("long")).where("_f <= _l")
    for step in (_RUN * _RUN, _RUN):
        df = df.withColumn("_f", F.explode(F.sequence("_f", "_l", F.lit(step).cast("long"))))
        df = df.withColumn("_l", F.least(F.col("_l"), F.col("_f") + F.lit(step - 1)))
    if tasks is not None:
        df = df.repartition(tasks, F.xxhash64("_f", *[c for c in df.columns if c in ("sid", "shard")]))
    return df.withColumn(name, F.explode(F.sequence("_f", "_l"))).drop("_f", "_l")


def before(df: DataFrame, by: str, at: str, value: str, name: str, width: int = _RUN) -> DataFrame:
    """Adds the sum of ``value`` over the rows of one ``by`` with a smaller ``at`` (whole numbers from 0): within stretches of
    ``width``, then over the stretches, so no window holds more than either."""
    df = df.withColumn("_s", F.floor(F.col(at) / width))
    inner = Window.partitionBy(by, "_s").orderBy(at)
    df = df.withColumn("_in", F.sum(value).over(inner) - F.col(value))
    whole = df.groupBy(by, "_s").agg(F.sum(value).alias("_w"))
    along = Window.partitionBy(by).orderBy("_s")
    whole = whole.select(by, "_s", (F.sum("_w").over(along) - F.col("_w")).alias("_b"))
    return df.join(whole, [by, "_s"]).withColumn(name, F.col("_in") + F.col("_b")).drop("_s", "_in", "_b")


def sized(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``(doc, src, size, th)`` for every row, lineage cut: the texts are read once. ``th`` is a hash of the text."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_REGEX)), F.lit(0)).cast("long")
    return reliable(docs.select(F.col(key).alias("doc"), F.col(source).alias("src"), size.alias("size"),
                                F.xxhash64(F.col(text)).alias("th")))


def source_plan(sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per source: size, weight, target, number of blocks, slots and
    the first slot. The windows run over the sources, not over documents."""
    s = sizes.groupBy("src").agg(F.sum("size").alias("source_size"),
                                 F.ceil(F.count(F.lit(1)) / F.lit(PIECE_DOCS)).alias("pieces"))
    s = s.withColumn("sid", F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())).cast("long") - 1)
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                                       (F.col("sid") % len(WEIGHTS)).cast("int") + 1))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(MAX_REPEATS)))
    # The level at which the weights meet the total: sources whose cap lies below it are full.
    order = Window.orderBy(F.col("cap") / F.col("w"), "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.withColumn("total", F.sum("source_size").over(everything))
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("w").over(rest))
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))
    s = s.withColumn("level", F.max(fits).over(everything))
    s = s.withColumn("target", F.least(F.col("cap"), F.col("level") * F.col("w")))
    s = s.withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block)))
    s = s.withColumn("slots", F.when(F.col("blocks") > 0, F.least(
        F.round(F.col("target") * F.col("blocks") / F.greatest("source_size", F.lit(1))).cast("long"),
        F.col("blocks") * MAX_REPEATS)).otherwise(F.lit(0).cast("long")))
    s = s.withColumn("first_slot", F.sum("slots").over(Window.orderBy("sid")) - F.col("slots"))
    s = s.withColumn("all_slots", F.sum("slots").over(everything))
    return s.select("sid", "src", "source_size", "target", "blocks", "slots", "first_slot", "all_slots", "pieces")


def packed(sizes: DataFrame, plan: DataFrame, seed: int = 0) -> DataFrame:
    """Each document with its offset in its source's word stream.

    The running sum is two-level: within hashed pieces of the stream, then over
    the pieces of a source, so no window holds a whole source.
    """
    docs = sizes.join(plan.select("sid", "src", "source_size", "target", "pieces"), sizes.src.eqNullSafe(plan.src))
    docs = docs.drop("src").withColumn("h", F.xxhash64(F.lit(seed), "doc", "th")).withColumn("piece", F.pmod("h", "pieces"))
    order = Window.partitionBy("sid", "piece").orderBy("h", F.col("doc").asc_nulls_first(), "th", "size")
    docs = docs.withColumn("_at", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    ahead = before(docs.groupBy("sid", "piece").agg(F.sum("size").alias("_n")), "sid", "piece", "_n", "_before").drop("_n")
    return docs.join(ahead, ["sid", "piece"]).select("doc", "sid", "size", "th", "source_size", "target",
                                                     (F.col("_at") + F.col("_before")).alias("start"))


def slot_tasks(plan: DataFrame) -> int:
    """Tasks that make slots, of ``TASK_SLOTS`` each: what they make is much larger than what they read."""
    return max(1, -(-(plan.agg(F.max("all_slots")).first()[0] or 0) // TASK_SLOTS))


def drawn(plan: DataFrame, seed: int = 0, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The draw: ``(shard, sid, count, from)``, how many of a shard's slots each source has
    and how many of the source's slots earlier shards have."""
    all_ = explode_range(plan.where("slots > 0"), F.lit(0), F.col("slots") - 1, "i", slot_tasks(plan))
    at = permuted(F.col("first_slot") + F.col("i"), F.col("all_slots"), F.lit(seed), F.lit(-1))
    counts = reliable(all_.select("sid", F.floor(at / shard_slots).alias("shard")).groupBy("shard", "sid").agg(
        F.count(F.lit(1)).alias("count")))
    return before(counts, "sid", "shard", "count", "from")


def slots(plan: DataFrame, seed: int = 0, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix: one row per slot, ``(shard, slot, sid, block, pass)``, from the shards' counts."""
    counts = drawn(plan, seed, shard_slots)
    sources = Window.partitionBy("shard").orderBy("sid")                       # a shard's sources: at most its slots
    counts = counts.withColumn("ahead", F.sum("count").over(sources) - F.col("count"))
    counts = counts.withColumn("filled", F.sum("count").over(Window.partitionBy("shard")))
    s = counts.join(plan.select("sid", "blocks"), "sid").repartition(slot_tasks(plan), "shard", "sid")
    s = s.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))    # at most a shard's slots
    j = F.col("from") + F.col("k")
    s = s.withColumn("pass", F.floor(j / F.col("blocks")))
    s = s.withColumn("block", permuted(j % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("sid"), F.col("pass")))
    slot = permuted(F.col("ahead") + F.col("k"), F.col("filled"), F.lit(seed), F.lit(-2), F.col("shard"))
    return s.select("shard", slot.alias("slot"), "sid", "block", "pass")


def pieces(packed_docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Packed blocks: one row per document part, ``(sid, block, doc.., words)``."""
    some = packed_docs.where("size > 0")
    end = F.col("start") + F.col("size")
    p = explode_range(some, F.floor(F.col("start") / block), F.floor((end - 1) / block), "block")
    return p.withColumn("words", F.least(end, (F.col("block") + 1) * block)
                        - F.greatest(F.col("start"), F.col("block") * block))


def mix(docs: DataFrame, block: int = BLOCK, seed: int = 0, **names: str) -> DataFrame:
    """The mixed corpus by reference: ``(shard, slot, sid, block, pass, doc,
    from_word, words)``, where ``from_word`` counts words of the document.

    Null or empty texts have no words and are in no slot; null ids and sources
    are carried as they are; repeated rows are rows of their own; an empty
    table gives an empty result. Columns other than the three named are not read.
    """
    sizes = sized(docs, **names)
    plan = reliable(source_plan(sizes, block))
    parts = pieces(packed(sizes, plan, seed), block)
    from_word = F.greatest(F.col("block") * block - F.col("start"), F.lit(0))
    return slots(plan, seed).join(parts.hint("merge"), ["sid", "block"]).select(
        "shard", "slot", "sid", "block", "pass", "doc", from_word.alias("from_word"), "words")


def _taken(sizes: DataFrame, plan: DataFrame, block: int, seed: int) -> DataFrame:
    placed = packed(sizes, plan, seed)
    uses = slots(plan, seed).groupBy("sid", "block").agg(F.count(F.lit(1)).alias("uses"), F.min("shard").alias("low"),
                                                         F.max("shard").alias("high"))
    # Sizes behind an explode are underestimated, so the join is told not to broadcast.
    read = pieces(placed, block).join(uses.hint("merge"), ["sid", "block"], "left")
    by = ["doc", "sid", "size", "th", "source_size", "target", "start"]
    some = read.groupBy(*by).agg(F.sum(F.col("words") * F.coalesce("uses", F.lit(0))).alias("taken"),
                                 F.min("low").alias("first_shard"), F.max("high").alias("last_shard"))
    none = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return some.unionByName(none, allowMissingColumns=True).drop("start")


def taken_words(docs: DataFrame, block: int = BLOCK, seed: int = 0, **names: str) -> DataFrame:
    """Per row of ``docs``: ``(doc, sid, size, source_size, target, taken, first_shard, last_shard)``;
    the shards are null where nothing is taken.

    Null or empty texts and texts of white space have size 0 and are taken 0
    times. A null source is a source, the last one. Rows with a null or
    repeated id are rows of their own. An empty table gives an empty result.
    Only the three named columns are read.
    """
    sizes = sized(docs, **names)
    return _taken(sizes, reliable(source_plan(sizes, block)), block, seed).drop("th")


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
                    block: int = BLOCK, seed: int = 0) -> DataFrame:
    """``docs`` as whole documents repeated to the mix: a document whose blocks
    the mix takes ``t`` times on average stands ``floor(t)`` times, and once
    more with the chance of the remainder, drawn by a hash of its id and text.
    Rows that repeat both draw each for itself, by their position. Texts without
    words have no weight in a mix and stay once. Columns are those of ``docs``;
    null ids and sources are values like any other; an empty table gives an
    empty result.
    """
    sizes = sized(docs, key, source, text)
    plan = reliable(source_plan(sizes, block))
    times = (_taken(sizes, plan, block, seed).where("size > 0").join(plan.select("sid", "src"), "sid")
             .groupBy("doc", "src", "size", "th").agg(F.avg(F.col("taken") / F.col("size")).alias("times"),
                                                       F.count(F.lit(1)).alias("rows")))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.col(key).alias("k"), F.col(source).alias("s"),
                      F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_REGEX)), F.lit(0)).cast("long").alias("n"),
                      F.xxhash64(F.col(text)).alias("t"), F.monotonically_increasing_id().alias("at"))
    row = row.join(times, row.k.eqNullSafe(times.doc) & row.s.eqNullSafe(times.src) & (row.n == times.size)
                   & (row.t == times.th), "left")
    own = F.when(F.col("rows") > 1, F.col("at")).otherwise(F.lit(0).cast("long"))
    chance = F.pmod(F.xxhash64(F.lit(seed + 1), "k", "t", own), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.when(F.col("n") == 0, F.lit(1)).otherwise(F.floor(F.col("times") + chance).cast("int"))
    return (row.withColumn("copies", copies).where("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*"))
