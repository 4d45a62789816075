"""SimHash near-duplicates: 64-bit fingerprints, pigeonhole blocks, Hamming check.

A fingerprint is cut into ``BLOCKS`` bit blocks. Two fingerprints that differ
in at most ``max_bits`` bits agree on at least ``BLOCKS - max_bits`` blocks, so
every close pair shares one of the keys made of that many blocks; rows meet
on these keys and the bit distance is checked exactly. No pair is lost and
none is taken on the key alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from supplyscope.llm.common import (components, free_names, group_starts, local_roots, pair_blocks, reliable, slices, texts_as_bytes,
                                    whole_groups)

SEED = 42
BLOCKS = 5
BLOCK_ROWS = 2048          # most rows of one side of a comparison group
_RUN = 1 << 16             # shingles whose hashes are in memory at once


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Fingerprint of one UTF-8 text (A-Z lower-cased). No words: zero."""
    words = text.lower().split()           # bytes: ASCII letters, ASCII white space
    n = len(words)
    if not n:
        return 0
    total = max(1, n - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, total, _RUN):
        run = words[at:min(at + _RUN, total) + shingle - 1]
        parts = [b" ".join(run)] if n < shingle else map(b" ".join, zip(*(run[i:] for i in range(shingle))))
        h = np.fromiter(map(xxh64_intdigest, parts, repeat(SEED)), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``fp`` (the 64 bits as a long) for every row; map-only."""
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, text):
                fp = np.array([fingerprint(t, shingle) for t in texts_as_bytes(b.column(text))], np.uint64)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(fp.view(np.int64))],
                                                 names=[*keep, "fp"])

    return docs.select(*keep, text).mapInArrow(run, schema)


def block_keys(fp: str, max_bits: int, blocks: int = BLOCKS) -> F.Column:
    """Array of long keys, one per choice of ``blocks - max_bits`` blocks."""
    if not 0 <= max_bits < blocks:
        raise ValueError("max_bits must be at least 0 and less than the number of blocks")
    edge = [64 * i // blocks for i in range(blocks + 1)]
    part = [F.shiftrightunsigned(F.col(fp), edge[i]).bitwiseAND(F.lit((1 << (edge[i + 1] - edge[i])) - 1))
            for i in range(blocks)]
    keys = [F.xxhash64(F.lit(c), *(part[i] for i in pick))
            for c, pick in enumerate(combinations(range(blocks), blocks - max_bits))]
    return F.array(*keys)


def close_stars(frames: Iterator[pd.DataFrame], max_bits: int) -> Iterator[pd.DataFrame]:
    """For each sorted group, the links within ``max_bits`` reduced to one star per
    linked set: at most one row per input row, never all pairs."""
    for f in whole_groups(frames, ["key", "pa", "pb"], 8192):
        fp = f["fp"].to_numpy().view(np.uint64)
        g = np.zeros(len(fp), np.int64)
        g[group_starts(f, ["key", "pa", "pb"])] = 1
        g = g.cumsum()
        a, b, i, d = [], [], np.arange(len(fp)), 1
        while True:
            i = i[i + d < len(fp)]
            i = i[g[i] == g[i + d]]
            if not len(i):
                break
            hit = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= max_bits]
            a.append(hit)
            b.append(hit + d)
            d += 1
        if not a:
            continue
        root = local_roots(len(fp), np.concatenate(a), np.concatenate(b))
        own = np.flatnonzero(root != np.arange(len(fp)))
        if len(own):
            yield pd.DataFrame({"a": fp.view(np.int64)[own], "b": fp.view(np.int64)[root[own]]}).drop_duplicates()


def links(distinct_fp: DataFrame, max_bits: int = 3, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges ``(a, b)`` whose closure is the closure of all pairs within ``max_bits``."""
    keyed = distinct_fp.select("fp", F.explode(block_keys("fp", max_bits)).alias("key"))
    dealt = pair_blocks(keyed, "key", "fp", block_rows).select("key", "pa", "pb", "fp")
    by = ["key", "pa", "pb"]
    return (dealt.repartition(*by).sortWithinPartitions(*by)
            .mapInPandas(lambda it: close_stars(it, max_bits), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, text: str = "text",
                    key: str = "doc_id") -> DataFrame:
    """``(key, fp, component_id)`` for every row: the smallest key reachable by links.

    Copies share a fingerprint and are linked by it; only distinct
    fingerprints are compared. Null text counts as the empty text (zero). A
    null key is a row like any other but never names a component unless the
    component has no other key. Repeated rows stay repeated; an empty table
    gives an empty result; other columns, whatever their names, are not read.
    """
    fps = reliable(fingerprints(docs, shingle, text, (key,)))
    reps = fps.groupBy("fp").agg(F.min(key).alias("_low"))
    tied = components(links(reps.select("fp"), max_bits))
    rooted = (reps.join(tied, reps.fp == tied.node, "left")
              .select("fp", "_low", F.coalesce("root", "fp").alias("_root")))
    low = rooted.groupBy("_root").agg(F.min("_low").alias("component_id"))
    return fps.join(rooted.join(low, "_root").select("fp", "component_id"), "fp").select(key, "fp", "component_id")


def representatives(docs: DataFrame, shingle: int = 3, max_bits: int = 3, text: str = "text",
                    key: str = "doc_id") -> DataFrame:
    """One row of ``docs`` per linked group, all columns as they are: the one with
    the smallest key (null last), among equals the one with the smallest hash.

    Rows are told apart by two hashes of all their columns, so rows that
    repeat each other wholly are one. The texts are shuffled once, to meet the
    rows that stay. Null, empty and wordless texts have the fingerprint zero
    and are linked like any other. An empty table gives an empty result;
    columns of any name are passed on.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    null = F.array(*[c.isNull() for c in columns])
    k1, k2 = free_names(docs, "_k1", "_k2")
    told = docs.select("*", F.xxhash64(null, *columns).alias(k1), F.xxhash64(F.lit(1), null, *columns).alias(k2))
    some = told.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(k1).alias("k1"), F.col(k2).alias("k2"))
    fps = reliable(fingerprints(some, shingle, "text", ("key", "k1", "k2")))
    distinct = fps.select("fp").distinct()
    tied = components(links(distinct, max_bits))
    rooted = fps.join(tied, fps.fp == tied.node, "left").withColumn("_root", F.coalesce("root", "fp"))
    best = F.min(F.struct(F.col("key").isNull().alias("n"), "key", "k1", "k2")).alias("best")
    stay = rooted.groupBy("_root").agg(best).select(F.col("best.k1").alias(k1), F.col("best.k2").alias(k2))
    return told.join(stay, [k1, k2], "left_semi").dropDuplicates([k1, k2]).select(*columns)
