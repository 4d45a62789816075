"""Near-duplicate embeddings by an inverted multi-index.

Unit vectors are split in halves, each half has a codebook of its own, and the
pairs of codewords form a product grid of cells. Every vector lies in the cell
of its nearest codewords and visits cells in the order of the distance it
would have to move to get there (to the borders of the half-cells), until the
distance exceeds what a neighbour's displacement reaches with the target
recall. Members and visitors of a cell meet in blocks of bounded size and are
verified by the cosine in double precision. Exact copies are one vector with
a count; links inside blocks are reduced to counts and to one star per
linked set, so no group of near copies is expanded into pairs.

The codebooks are fitted to at most ``SAMPLE`` rows (those with the smallest
hash); every row is indexed and every row is a query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyscope.llm.common import components, group_starts, hash_sample, local_roots, reliable, whole_groups

COSINE = 0.93
RECALL = 0.99              # for a neighbour just at the cosine, displaced in a random direction
CODES = 16                 # codewords of each half
SAMPLE = 20_000
ITERATIONS = 12
BLOCK_ROWS = 2048
GRID = ["label", "dim", "cell"]


def usable(vec: str, label: str) -> Column:
    """True if the vector can link: label and vector given, all components finite, not all zero."""
    bad = F.exists(F.col(vec), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(F.col(label).isNotNull() & F.col(vec).isNotNull() & ~bad
                      & F.exists(F.col(vec), lambda x: x != 0), F.lit(False))


def unit(vectors: list, dim: int) -> np.ndarray:
    m = np.array(vectors, np.float64).reshape(len(vectors), dim)
    m /= np.abs(m).max(axis=1, keepdims=True)          # no overflow in the squares
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def squared(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum(0, (h * h).sum(1)[:, None] - 2 * h @ codes.T + (codes * codes).sum(1))


def codebook(h: np.ndarray, codes: int, seed: int) -> np.ndarray:
    """Lloyd's k-means from distinct starting rows; fewer distinct rows give fewer codewords."""
    starts = np.unique(h, axis=0)
    rng = np.random.default_rng(seed)
    c = starts[rng.permutation(len(starts))[:codes]].copy()
    for _ in range(ITERATIONS):
        own = squared(h, c).argmin(1)
        for k in range(len(c)):
            if (own == k).any():
                c[k] = h[own == k].mean(0)
    return np.unique(c, axis=0)


def fit(vectors: DataFrame, codes: int = CODES, sample: int = SAMPLE) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Codebooks of both halves by dimension, from the ``sample`` usable rows with the smallest hash."""
    rows = hash_sample(vectors.where("ok").select("h1", "vec"), sample, "h1").toPandas()["vec"]
    out = {}
    for dim in sorted({len(v) for v in rows}):
        m = unit([v for v in rows if len(v) == dim], dim)
        out[dim] = tuple(codebook(h, codes, i) if h.shape[1] else np.zeros((1, 0))
                         for i, h in enumerate((m[:, :dim // 2], m[:, dim // 2:])))
    return out


def border(h: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest codeword, squared distance to the border of every codeword's half-cell)."""
    d = squared(h, codes)
    own = d.argmin(1)
    gap = np.sqrt(squared(codes, codes))[own]
    t = (d - d[np.arange(len(d)), own][:, None]) / np.where(gap > 0, 2 * gap, np.inf)
    t[np.arange(len(d)), own] = 0
    return own, t * t


def multi_sequence(a: np.ndarray, b: np.ndarray, reach: float) -> list[int]:
    """Cells ``i * len(b) + j`` in ascending order of ``a[i] + b[j]`` while the sum is at most ``reach``."""
    ia, ib = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    heap, out = [(float(a[ia[0]] + b[ib[0]]), 0, 0)], []
    while heap and heap[0][0] <= reach:
        _, i, j = heapq.heappop(heap)
        out.append(int(ia[i]) * len(b) + int(ib[j]))
        if j + 1 < len(b):
            heapq.heappush(heap, (float(a[ia[i]] + b[ib[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (float(a[ia[i + 1]] + b[ib[0]]), i + 1, 0))
    return out


def reach_of(cosine: float, recall: float, dim: int) -> float:
    """Squared border distance to go: a neighbour at the cosine is ``2 - 2 cos``
    away (squared), the share of a random direction along one border normal is
    Gaussian with variance ``1 / dim``; never more than the whole distance."""
    whole = 2 - 2 * cosine
    z = NormalDist().inv_cdf(recall) if recall < 1 else np.inf
    return float(min(whole, z * z * whole / dim))


def locate(reps: DataFrame, books: dict[int, tuple[np.ndarray, np.ndarray]], cosine: float, recall: float) -> DataFrame:
    """Adds ``dim``, the home ``cell`` and the visited ``cells`` of every representative.
    A dimension without a codebook has one cell."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f["dim"] = f["vec"].map(len)
            for dim, g in f.groupby("dim"):
                g = g.copy()
                if dim in books:
                    m = unit(list(g["vec"]), dim)
                    (i, a), (j, b) = border(m[:, :dim // 2], books[dim][0]), border(m[:, dim // 2:], books[dim][1])
                    reach = reach_of(cosine, recall, dim)
                    g["cell"] = i * len(books[dim][1]) + j
                    g["cells"] = [multi_sequence(x, y, reach) for x, y in zip(a, b)]
                else:
                    g["cell"], g["cells"] = 0, [[0]] * len(g)
                g["vec"] = [np.asarray(v, np.float64).tobytes() for v in g["vec"]]
                yield g[["uid", "label", "dim", "n", "vec", "cell", "cells"]]

    label = reps.schema["label"].dataType.simpleString()
    return reps.mapInPandas(run, f"uid long, label {label}, dim int, n long, vec binary, cell int, cells array<int>")


def meetings(located: DataFrame, block_rows: int) -> DataFrame:
    """Members and visitors of the cells, dealt so that each visitor meets each
    member of its cell in one group of at most about ``2 * block_rows`` rows."""
    member = located.select(*GRID, F.lit(True).alias("home"), "uid", "n", "vec", F.col("cell").alias("own"), "cells")
    visitor = located.select("label", "dim", F.explode("cells").alias("cell"), F.lit(False).alias("home"), "uid", "n", "vec",
                             F.col("cell").alias("own"), F.lit(None).cast("array<int>").alias("cells"))
    count = lambda rows, name: rows.groupBy(*GRID).agg(
        F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(name))
    cells = count(member, "_m").join(count(visitor, "_v"), GRID)          # cells without members take no visitor on
    rows = member.unionByName(visitor).join(cells, GRID)
    own = F.pmod(F.xxhash64("uid"), F.when(F.col("home"), F.col("_m")).otherwise(F.col("_v"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("home"), F.col("_v")).otherwise(F.col("_m")) - 1))
    rows = rows.withColumn("_own", own).withColumn("_other", other)
    return (rows.withColumn("mb", F.when(F.col("home"), F.col("_own")).otherwise(F.col("_other")))
            .withColumn("vb", F.when(F.col("home"), F.col("_other")).otherwise(F.col("_own")))
            .drop("_m", "_v", "_own", "_other"))


def verify(frames: Iterator[pd.DataFrame], cosine: float) -> Iterator[pd.DataFrame]:
    """Per group: the linked vectors (copies counted) of each visitor, and of each member
    that does not visit the cell of the visitor, so a link counts once for either
    side; and a star of links per linked set."""
    keys = [*GRID, "mb", "vb"]
    for f in whole_groups(frames, keys, 8192):
        s = group_starts(f, keys)
        for i, j in zip(s, [*s[1:], len(f)]):
            g = f.iloc[i:j]
            m = np.frombuffer(b"".join(g["vec"]), np.float64).reshape(len(g), -1)
            m = unit(m, m.shape[1])
            home, uid, n = g["home"].to_numpy(bool), g["uid"].to_numpy(), g["n"].to_numpy()
            h, v = np.flatnonzero(home), np.flatnonzero(~home)
            a, b = np.nonzero(m[v] @ m[h].T >= cosine)
            a, b = v[a], h[b]
            other = uid[a] != uid[b]
            a, b = a[other], b[other]
            if not len(a):
                continue
            links = np.bincount(a, n[b], len(g)).astype(np.int64)
            # A member that visits the visitor's own cell counts the link there.
            own, cells = g["own"].to_numpy(), list(g["cells"].iloc[h])
            every = np.concatenate(cells)
            visits = np.zeros((len(h), max(own.max(), every.max()) + 1), bool)
            visits[np.repeat(np.arange(len(h)), [len(c) for c in cells]), every] = True
            back = ~visits[np.searchsorted(h, b), own[a]]
            links += np.bincount(b[back], n[a[back]], len(g)).astype(np.int64)
            # The same vector may stand on both sides: one node per vector.
            _, node = np.unique(uid, return_inverse=True)
            low = np.full(node.max() + 1, len(g))
            np.minimum.at(low, node, np.arange(len(g)))
            root = low[local_roots(len(low), node[a], node[b])]
            at = low != root
            got = np.flatnonzero(links)
            yield pd.DataFrame({"a": np.r_[uid[got], uid[low[at]]], "b": np.r_[uid[got], uid[root[at]]],
                                "links": np.r_[links[got], np.zeros(at.sum(), np.int64)]})


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, codes: int = CODES,
                    block_rows: int = BLOCK_ROWS, key: str = "vec_id", vec: str = "embedding",
                    label: str = "label") -> DataFrame:
    """``(key, n_links, component_id, kept)`` for every row.

    Rows link when their labels are equal and not null, their dimensions are
    equal, and the cosine of their vectors is at least ``cosine``. Vectors that
    are null, empty, zero or hold null or non-finite components link with
    nothing: no links, their own component. Repeated rows link with each other
    as copies. A null key is a row like any other but names no component while
    another key is there. An empty table gives an empty result. Other columns
    are not read.
    """
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vec).alias("vec"))
    rows = rows.withColumn("ok", usable("vec", "label"))
    rows = rows.withColumn("h1", F.xxhash64("label", "vec")).withColumn("h2", F.xxhash64(F.lit(1), "vec", "label"))
    good = rows.where("ok")
    reps = good.groupBy("h1", "h2").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"),
                                        F.first("label").alias("label"), F.first("vec").alias("vec"))
    reps = reliable(reps.withColumn("uid", F.monotonically_increasing_id()))
    located = reliable(locate(reps.select("uid", "label", "n", "vec"), fit(rows, codes), cosine, recall))
    keys = [*GRID, "mb", "vb"]
    met = meetings(located, block_rows).repartition(*keys).sortWithinPartitions(*keys)
    found = reliable(met.mapInPandas(lambda it: verify(it, cosine), "a long, b long, links long"))
    links = found.where("links > 0").groupBy(F.col("a").alias("uid")).agg(F.sum("links").alias("links"))
    roots = components(found.where("links = 0").select("a", "b")).withColumnRenamed("node", "uid")
    known = (reps.select("uid", "h1", "h2", "low", "n").join(links, "uid", "left").join(roots, "uid", "left")
             .withColumn("root", F.coalesce("root", "uid")))
    low = known.groupBy("root").agg(F.min("low").alias("component"))
    known = known.join(low, "root").select("h1", "h2", "component",
                                           (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"))
    joined = good.select("id", "h1", "h2").join(known, ["h1", "h2"]).select("id", "links", "component")
    alone = rows.where(~F.col("ok")).select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    return joined.unionByName(alone).select(F.col("id").alias(key), F.col("links").alias("n_links"),
                                            F.col("component").alias("component_id"),
                                            F.col("id").eqNullSafe(F.col("component")).alias("kept"))
