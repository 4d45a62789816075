"""Ranked lexical search of many items at once, by common subexpressions.

1. Mining. The items lie in shards of about ``SHARD_BYTES`` of text. In each,
   an item is the list of its terms, the most shared first; adjacent pairs
   that two items or more have in common become a node, again and again, so a
   node stands for a set of terms that its items share. What is left is a
   graph: nodes of two, and items as short lists of nodes.
2. Reading. The documents are cut into terms once, in blocks. A block keeps
   its postings of terms that may be an item's (told by a bit filter of fixed
   size) and a dictionary of these terms with their document counts.
   Dictionaries are shuffled by term to count documents, and bring weights
   and terms' places in the graph back to the blocks.
3. Scoring. A block's documents get one accumulator for each term and for
   each node, level by level, so a shared set is added up once; an item's score
   is the sum of its nodes. Each block passes on its best documents of every
   item, exactly ranked, and two rounds of windows rank them over all blocks.

Only one shard's graph is broadcast at a time. The postings of all blocks are
staged, so further shards read these and not the documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplyscope.llm.common import reliable, slices, stage_table
from supplyscope.session import drop_path

BEST = 10
SHARD_BYTES = 1 << 20      # item text of a shard; a longer item is a shard's only bound
_SLICE = 24 << 20          # bytes of text of a block
_CELLS = 1 << 22           # accumulators in memory at once
_BITS = 23                 # log2 of the bits of the term filter (1 MB)


# ---------------------------------------------------------------- terms
def _fold() -> np.ndarray:
    """Byte to byte: A-Z to a-z, other ASCII but letters and digits to a blank."""
    t = np.arange(256, dtype=np.uint8)
    word = np.zeros(256, bool)
    for lo, hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        word[lo:hi + 1] = True
    t[~word] = 0x20
    t[0x41:0x5B] += 0x20
    return t


FOLD = _fold()


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(first term of each text and the end, term numbers of all texts, terms by number); null has none."""
    raw = texts.cast(pa.large_binary()).fill_null(b"")
    off = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = raw.buffers()[2]
    flat = FOLD[np.frombuffer(data, np.uint8)[off[0]:off[-1]]] if data is not None and len(data) else np.zeros(0, np.uint8)
    folded = pa.LargeStringArray.from_buffers(len(raw), pa.py_buffer(off - off[0]), pa.py_buffer(flat))
    parts = pc.ascii_split_whitespace(folded)
    ends, words = parts.offsets.to_numpy().astype(np.int64), parts.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    at = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))[ends - ends[0]]
    coded = words.filter(real).dictionary_encode()
    return at, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def filter_bits(terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two positions of each term in the bit filter, from a polynomial hash of its bytes."""
    raw = terms.cast(pa.large_binary())
    size = pc.binary_length(raw).to_numpy().astype(np.int64)
    if not len(size):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(b"".join(raw.to_pylist()), np.uint8)
    start = np.cumsum(size) - size
    power = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
    at = (np.arange(len(data)) - np.repeat(start, size)) & 63
    h = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power[at], start)
    h ^= h >> np.uint64(29)
    return tuple(((h * np.uint64(k)) >> np.uint64(64 - _BITS)).astype(np.int64)
                 for k in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


# ---------------------------------------------------------------- mining
def share(lists: list[list[int]], leaves: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Nodes ``(left, right)`` numbered from ``leaves`` on, and the items as lists
    of leaves and nodes. Every round pairs neighbours that recur, the pair with
    more uses first where two overlap, until no pair is left that recurs."""
    nodes: list[tuple[int, int]] = []
    while True:
        uses = Counter(p for s in lists for p in zip(s, s[1:]))
        name: dict[tuple[int, int], int] = {}
        out = []
        for s in lists:
            i, new = 0, []
            while i < len(s):
                pair = (s[i], s[i + 1]) if i + 1 < len(s) else None
                n = uses[pair] if pair else 0
                if n > 1 and (i + 2 >= len(s) or n >= uses[s[i + 1], s[i + 2]]):
                    new.append(name.setdefault(pair, leaves + len(nodes) + len(name)))
                    i += 2
                else:
                    new.append(s[i])
                    i += 1
            out.append(new)
        if not name:
            return nodes, lists
        nodes += name
        lists = out


@dataclass
class Graph:
    """One shard: leaves are its terms, nodes add two earlier ones, items add their parts."""

    leaves: int
    left: np.ndarray
    right: np.ndarray
    uid: np.ndarray
    at: np.ndarray         # first part of each item
    parts: np.ndarray
    levels: list[np.ndarray]

    @classmethod
    def of(cls, row) -> Graph:
        get = lambda c: np.frombuffer(row[c], np.int64)
        left, right, leaves = get("lefts"), get("rights"), row["leaves"]
        depth = np.zeros(leaves + len(left), np.int32)
        for i, (a, b) in enumerate(zip(left, right)):
            depth[leaves + i] = 1 + max(depth[a], depth[b])
        own = depth[leaves:]
        return cls(leaves, left, right, get("uid"), get("starts"), get("parts"),
                   [np.flatnonzero(own == d) for d in range(1, int(own.max(initial=0)) + 1)])

    def scores(self, leaf: np.ndarray, doc: np.ndarray, value: np.ndarray, docs: int) -> np.ndarray:
        """(items, docs): every accumulator is made once and used by all above it."""
        acc = np.zeros((self.leaves + len(self.left), docs), np.int64)
        acc[leaf, doc] = value
        for some in self.levels:
            acc[self.leaves + some] = acc[self.left[some]] + acc[self.right[some]]
        return np.add.reduceat(acc[self.parts], self.at, axis=0)


def mined(items: DataFrame) -> DataFrame:
    """One row per shard of ``items(uid, shard, text)``: its terms and its graph. Items without terms are in none."""
    def run(t: pa.Table) -> pa.Table:
        text = t.column("text").combine_chunks()
        at, code, names = terms_of(text)
        some = np.flatnonzero(np.diff(at))
        held = np.zeros(len(names), np.int64)
        for i in some:
            held[np.unique(code[at[i]:at[i + 1]])] += 1
        place = np.lexsort((np.arange(len(names)), -held)).argsort()        # most shared first
        lists = [sorted(code[at[i]:at[i + 1]].tolist(), key=lambda c: place[c]) for i in some]
        nodes, lists = share(lists, len(names))
        size = np.array([len(s) for s in lists], np.int64)
        raw = lambda a: [np.asarray(a, np.int64).tobytes()]
        uid = t.column("uid").to_numpy()[some]
        out = [t.column("shard")[:1].to_pylist(), [names.to_pylist()], [len(names)], raw([n[0] for n in nodes]),
               raw([n[1] for n in nodes]), raw(uid), raw(np.cumsum(size) - size), raw([p for s in lists for p in s])]
        table = pa.table([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)
        return table if len(some) else table[:0]

    schema = pa.schema([("shard", pa.int32()), ("terms", pa.list_(pa.string())), ("leaves", pa.int64()), ("lefts", pa.binary()),
                        ("rights", pa.binary()), ("uid", pa.binary()), ("starts", pa.binary()), ("parts", pa.binary())])
    return items.select("uid", "shard", "text").groupBy("shard").applyInArrow(
        run, "shard int, terms array<string>, leaves long, lefts binary, rights binary, uid binary, starts binary, parts binary")


def term_filter(terms: DataFrame) -> np.ndarray:
    """Bits of all ``terms(term)``: tasks pass on words of the bitmap, at most
    ``2 ** (_BITS - 6)`` longs come back whatever the number of terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.concatenate(filter_bits(b.column("term")))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.int64(1) << (at & 63))], names=["i", "bits"])

    got = terms.mapInArrow(run, "i long, bits long").groupBy("i").agg(F.bit_or("bits").alias("bits")).toPandas()
    bitmap = np.zeros(1 << (_BITS - 6), np.int64)
    bitmap[got["i"]] = got["bits"]
    return bitmap


# ---------------------------------------------------------------- reading
def blocks(docs: DataFrame, bitmap: np.ndarray, key: str, text: str) -> DataFrame:
    """Rows of three kinds by block: a document ``(key, n, ids, tfs)`` with postings of
    kept terms, a kept term ``(term, id, df)``, and the block's totals ``(docs, words)``."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)               # 1 MB
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    base = pa.schema([("block", pa.int64()), ("key", pa.null()), ("n", pa.int64()), ("ids", pa.binary()), ("tfs", pa.binary()),
                      ("term", pa.string()), ("id", pa.int32()), ("df", pa.int64()), ("docs", pa.int64()), ("words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        for batch in batches:
            schema = base.set(1, batch.schema.field("key"))

            def made(rows: int, **cols) -> pa.RecordBatch:
                given = {"block": pa.array(np.full(rows, block))} | cols
                return pa.RecordBatch.from_arrays([given[f.name] if f.name in given else pa.nulls(rows, f.type) for f in schema],
                                                  schema=schema)

            for b in slices(batch, "text", _SLICE):
                at, code, names = terms_of(b.column("text"))
                n = np.diff(at)
                one, two = filter_bits(names)
                bit = lambda p: (shared.value[p >> 6] >> (p & 63)) & 1 == 1
                kept = bit(one) & bit(two)
                local = np.cumsum(kept) - 1
                use = np.flatnonzero(kept[code]) if len(code) else np.zeros(0, np.int64)
                doc = np.repeat(np.arange(len(n)), n)[use]
                m = max(1, int(kept.sum()))
                pair, tf = np.unique(doc * m + local[code[use]], return_counts=True)
                doc, term = pair // m, (pair % m).astype(np.int32)
                has, first = np.unique(doc, return_index=True)
                cut = lambda a: [x.tobytes() for x in np.split(a, first[1:])] if len(has) else []
                yield made(len(has), key=b.column("key").take(pa.array(has)), n=pa.array(n[has]),
                           ids=pa.array(cut(term), pa.binary()), tfs=pa.array(cut(tf.astype(np.int64)), pa.binary()))
                some = names.filter(pa.array(kept)).cast(pa.string())
                yield made(len(some), term=some, id=pa.array(np.arange(len(some), dtype=np.int32)),
                           df=pa.array(np.bincount(term, minlength=len(some)).astype(np.int64)))
                yield made(1, docs=pa.array([int((n > 0).sum())]), words=pa.array([int(n.sum())]))
                block += 1

    return rows.mapInArrow(run, f"block long, key {kind}, n long, ids binary, tfs binary, term string, id int, df long, "
                                "docs long, words long")


# ---------------------------------------------------------------- scoring
def lengths_norm(n: np.ndarray, docs: int, words: int) -> np.ndarray:
    """``100 - 75 + (75 * n * docs) div words``, exact also where the product leaves 64 bits."""
    if int(n.max(initial=0)) * 75 * docs < 1 << 63:
        return 25 + (75 * n * docs) // words
    return np.array([25 + 75 * int(x) * docs // words for x in n], np.int64)


def ranked(found: tuple[np.ndarray, ...], best: int) -> tuple[np.ndarray, ...]:
    """The ``best`` of each item among ``(item, score, position)``, equal scores by position."""
    item, score, at = found
    order = np.lexsort((at, -score, item))
    item, score, at = item[order], score[order], at[order]
    first = np.searchsorted(item, item, side="left")
    keep = np.arange(len(item)) - first < best
    return item[keep], score[keep], at[keep]


def best_of_block(texts: pa.Table, dictionary: pa.Table, g: Graph, docs: int, words: int, best: int) -> pa.Table:
    """``(block, uid, score, key)``: each item's best documents of a block."""
    texts = texts.take(pc.sort_indices(texts, sort_keys=[("key", "ascending")], null_placement="at_end"))
    known = dictionary.column("id").to_numpy()
    size = 1 + int(known.max(initial=-1))
    leaf, weight = np.full(size, -1), np.zeros(size, np.int64)
    leaf[known], weight[known] = dictionary.column("leaf").to_numpy(), dictionary.column("w").to_numpy()
    norm = lengths_norm(texts.column("n").to_numpy(), docs, words)
    step = max(1, _CELLS // (g.leaves + len(g.left) + len(g.parts)))
    held = (np.zeros(0, np.int64),) * 3
    least = np.zeros(len(g.uid), np.int64)                     # a later document must score more than this
    for i in range(0, len(texts) if size else 0, step):
        ids = [np.frombuffer(x, np.int32) for x in texts.column("ids")[i:i + step].to_pylist()]
        tf = np.concatenate([np.frombuffer(x, np.int64) for x in texts.column("tfs")[i:i + step].to_pylist()])
        doc, term = np.repeat(np.arange(len(ids)), [len(x) for x in ids]), np.concatenate(ids)
        on = term < size
        on[on] = leaf[term[on]] >= 0
        doc, term, tf = doc[on], term[on], tf[on]
        value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * norm[i + doc]))
        score = g.scores(leaf[term], doc, value, len(ids))
        item, at = np.nonzero(score > least[:, None])
        held = ranked(tuple(np.concatenate(p) for p in zip(held, (item, score[item, at], at + i))), best)
        full = np.bincount(held[0], minlength=len(least)) == best
        last = np.searchsorted(held[0], np.flatnonzero(full), side="right") - 1
        least[full] = held[1][last]
    item, score, at = held
    block = texts.column("block")[0].as_py() if len(texts) else 0
    return pa.table({"block": pa.array(np.full(len(item), block)), "uid": pa.array(g.uid[item]), "score": pa.array(score),
                     "key": texts.column("key").combine_chunks().take(pa.array(at))})


def shard_best(staged: DataFrame, dictionary: DataFrame, g: Graph, docs: int, words: int, best: int) -> DataFrame:
    """Best documents of one shard's items in each block; a block meets its own dictionary."""
    kind = staged.schema["key"].dataType.simpleString()
    shared = staged.sparkSession.sparkContext.broadcast(g)     # of a shard's bytes
    texts = staged.where("ids is not null").select("block", "key", "n", "ids", "tfs")

    def run(t: pa.Table, d: pa.Table) -> pa.Table:
        return best_of_block(t, d, shared.value, docs, words, best)

    out = reliable(texts.groupBy("block").cogroup(dictionary.groupBy("block")).applyInArrow(
        run, f"block long, uid long, score long, key {kind}"))
    shared.unpersist()
    return out


def search(docs: DataFrame, items: DataFrame, best: int = BEST, item_key: str = "item_id", item_text: str = "text",
           key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(item_key, rank, key, score)``: each item's ``best`` documents with a score
    above 0, highest first, equal scores by ascending key, null keys last.

    Null or empty texts and texts without terms match nothing and count in no
    figure. Repeated documents are documents of their own. Items that repeat
    id and text are one item; items that share an id but no text, or have no
    id, are ranked each for itself. Empty tables give an empty result. Only
    the named columns are read, whatever others are called.
    """
    spark = docs.sparkSession
    rows = items.select(F.col(f"`{item_key}`").alias("item"), F.col(f"`{item_text}`").alias("text")).where("text is not null")
    rows = rows.distinct().withColumn("uid", F.monotonically_increasing_id())
    rows, rows_path = stage_table(rows, "search-items")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    plans, plans_path = stage_table(mined(rows.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int"))),
                                    "search-plans")
    places = plans.select("shard", F.posexplode("terms").alias("leaf", "term"))
    bitmap = term_filter(places.select("term").distinct())
    staged, staged_path = stage_table(blocks(docs, bitmap, key, text), "search-blocks", compression="zstd")
    count, words, parts = staged.agg(F.sum("docs"), F.sum("words"), F.count("docs")).first()
    in_blocks = staged.where("term is not null").select("block", "term", "id", "df")
    weight = in_blocks.groupBy("term").agg(F.sum("df").alias("df"))
    weight = weight.select("term", F.floor(1000 * F.log((2 * F.lit(count or 0).cast("double") + 2) / (2 * F.col("df") + 1)))
                           .cast("long").alias("w"))
    placed, placed_path = stage_table(
        in_blocks.select("block", "term", "id").join(places.join(weight, "term"), "term").select("shard", "block", "id", "leaf", "w"),
        "search-terms", compression="zstd")
    every = [r["shard"] for r in plans.select("shard").orderBy("shard").collect()] if words else []
    kind = docs.schema[key].dataType.simpleString()
    found = [spark.createDataFrame([], f"block long, uid long, score long, key {kind}")]
    for s in every:
        graph = Graph.of(plans.where(F.col("shard") == s).drop("terms").first())     # of a shard's bytes
        found.append(shard_best(staged, placed.where(F.col("shard") == s).drop("shard"), graph, count, words, best))
    by = [F.desc("score"), F.col("key").asc_nulls_last()]
    some = reduce(DataFrame.unionByName, found).withColumn("part", F.pmod(F.xxhash64("block"), F.lit(int((parts or 1) ** 0.5) or 1)))
    some = some.withColumn("r", F.row_number().over(Window.partitionBy("uid", "part").orderBy(*by))).where(F.col("r") <= best)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("uid").orderBy(*by))).where(F.col("rank") <= best)
    out = reliable(some.join(rows.select("uid", "item"), "uid").select(
        F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score"))
    for path in (rows_path, plans_path, staged_path, placed_path):
        drop_path(spark, path)
    return out
