"""Embedding whitening from the weighted covariance of distinct vectors.

Entries become integers (``floor(scale * c) + shift``) and identical integer
vectors are grouped, with map-side partial counts, so a group of copies is one
row before anything is multiplied. The covariance is that of the distinct
vectors with their counts (or one each) as weights: each task centres its rows
exactly (integers minus the integer part of the mean, then its fraction),
multiplies them as matrices and passes on one matrix; the sums over tasks are
a grouped sum of one row per matrix row. The eigenvectors of that matrix, one
``d x d`` problem for vectors of ``d`` entries however many rows there are, are
shared with all tasks, every distinct vector is projected once, and the rows
join their own vector back by two 64-bit hashes of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyscope.llm.common import reliable

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
RANK = 1e-12               # eigenvalues below this share of the largest are no components
EDGE = 1 << 52             # entries are held within +-EDGE, where doubles are whole numbers
_BATCH = 4096              # vectors multiplied at once


def whole(vec: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """Integer entries, held within ``EDGE``; the vector must have finite entries only."""
    held = lambda c: F.greatest(F.least(c * scale, F.lit(float(EDGE))), F.lit(float(-EDGE)))
    return F.transform(vec, lambda c: F.floor(held(c.cast("double"))).cast("long") + F.lit(shift).cast("long"))


def finite(vec: Column) -> Column:
    bad = F.exists(vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & ~bad, F.lit(False))


def distinct_vectors(vectors: DataFrame, vec: str = "vec") -> DataFrame:
    """``(x, dim, n)``: each distinct integer vector with the number of its rows."""
    return vectors.groupBy(F.col(vec).alias("x")).agg(F.count(F.lit(1)).alias("n")).withColumn("dim", F.size("x"))


@dataclass
class Fit:
    """One dimension's fit: rows, sums, integer and fractional mean, covariance, eigen-pairs by falling value."""

    n: int
    sums: list[int]
    base: np.ndarray
    part: np.ndarray
    trace: float = 0.0
    values: np.ndarray | None = None
    axes: np.ndarray | None = None         # (d, components)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - mean``: the integer part is subtracted exactly."""
        return (x - self.base).astype(np.float64) - self.part


def sums_of(distinct: DataFrame, weight: str) -> dict[int, Fit]:
    """Rows and exact sums by dimension. A task passes on two longs a position (the sums of
    the high and the low 20 bits), which are added up as decimals; one row per
    (dimension, position) reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for b in batches:
            w = b.column("n").to_numpy() if weight == "count" else np.ones(b.num_rows, np.int64)
            for dim, at, x in matrices(b):
                t = total.setdefault(dim, [0, 0, 0])
                for i, part in enumerate((w[at], w[at] @ (x >> 20), w[at] @ (x & 0xFFFFF))):
                    t[i] = t[i] + (part.sum() if i == 0 else part)
        for dim, (n, high, low) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([int(n)], pa.int64()), pa.array([high], pa.list_(pa.int64())),
                 pa.array([low], pa.list_(pa.int64()))], names=["dim", "n", "high", "low"])

    parts = distinct.select("x", "n").mapInArrow(run, "dim int, n long, high array<long>, low array<long>")
    exact = lambda c: F.sum(c.cast("decimal(28,0)"))
    got = (parts.select("dim", "n", F.posexplode(F.arrays_zip("high", "low")).alias("at", "p"))
           .groupBy("dim", "at").agg(F.sum("n").alias("n"), exact(F.col("p.high")).alias("high"), exact(F.col("p.low")).alias("low"))
           .orderBy("dim", "at").collect())
    out: dict[int, Fit] = {}
    for dim in sorted({r["dim"] for r in got}):
        rows = [r for r in got if r["dim"] == dim]
        n, sums = rows[0]["n"], [(int(r["high"]) << 20) + int(r["low"]) for r in rows]
        out[dim] = Fit(n, sums, np.array([s // n for s in sums], np.int64), np.array([(s % n) / n for s in sums]))
    return out


def matrices(batch: pa.RecordBatch, rows: int = _BATCH) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(dim, positions, integer matrix)`` of the batch's vectors, ``rows`` at a time."""
    x = batch.column("x")
    size = np.diff(x.offsets.to_numpy())
    for dim in np.unique(size[size > 0]):
        at = np.flatnonzero(size == dim)
        for i in range(0, len(at), rows):
            some = at[i:i + rows]
            yield int(dim), some, x.take(pa.array(some)).flatten().to_numpy().reshape(len(some), dim)


def covariance(distinct: DataFrame, fits: dict[int, Fit], weight: str) -> dict[int, np.ndarray]:
    """Weighted centred products over all distinct vectors, divided by the fit's rows."""
    shared = distinct.sparkSession.sparkContext.broadcast(fits)              # a few numbers per position

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            w = b.column("n").to_numpy().astype(np.float64) if weight == "count" else np.ones(b.num_rows)
            for dim, at, x in matrices(b):
                c = shared.value[dim].centred(x)
                total[dim] = total.get(dim, 0) + (c * w[at][:, None]).T @ c
        for dim, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)),
                                              pa.array(list(m), pa.list_(pa.float64()))], names=["dim", "i", "row"])

    parts = distinct.select("x", "n").mapInArrow(run, "dim int, i int, row array<double>")
    got = (parts.select("dim", "i", F.posexplode("row").alias("j", "v")).groupBy("dim", "i", "j")
           .agg(F.sum("v").alias("v")).toPandas())                           # d * d numbers
    shared.unpersist()
    out = {}
    for dim, g in got.groupby("dim"):
        m = np.zeros((dim, dim))
        m[g["i"], g["j"]] = g["v"]
        out[int(dim)] = (m + m.T) / (2 * fits[int(dim)].n)
    return out


def fit(distinct: DataFrame, components: int = COMPONENTS, weight: str = "count") -> dict[int, Fit]:
    """Mean, trace and leading eigen-pairs by dimension. ``weight`` is "count" (all rows) or "one" (each vector once)."""
    fits = sums_of(distinct, weight)
    for dim, v in covariance(distinct, fits, weight).items():
        values, axes = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:components]
        order = order[values[order] > RANK * max(values.max(), 0.0)]
        # Either sign is right; the entry of largest magnitude is made positive.
        axes = axes[:, order] * np.sign(axes[np.abs(axes[:, order]).argmax(0), order])
        f = fits[dim]
        f.trace, f.values, f.axes = float(np.trace(v)), values[order], axes
    return fits


def deviations(f: Fit, x: np.ndarray) -> pa.Array:
    """``sum((n * x - S) ** 2)`` per vector, exact; null where it does not fit a long."""
    rough = ((f.centred(x) * float(f.n)) ** 2).sum(1)
    fits = rough < 9.2e18
    d = (x[fits] - f.base) * f.n - np.array([s - f.n * int(b) for s, b in zip(f.sums, f.base)], np.int64)
    out = np.zeros(len(x), np.int64)
    out[fits] = (d * d).sum(1)
    return pa.array(out, mask=~fits)


def projected(distinct: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """``(x, n, dim, deviation, white)``, each distinct vector whitened once."""
    shared = distinct.sparkSession.sparkContext.broadcast(fits)              # d * components numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, at, x in matrices(b):
                f, some = shared.value[dim], b.take(pa.array(at))
                white = f.centred(x) @ f.axes / np.sqrt(f.values) if len(f.values) else np.zeros((len(x), 0))
                yield pa.RecordBatch.from_arrays(
                    [some.column("x"), some.column("n"), pa.array(np.full(len(x), dim, np.int32)), deviations(f, x),
                     pa.array(list(white), pa.list_(pa.float64()))], names=["x", "n", "dim", "deviation", "white"])

    return distinct.select("x", "n").mapInArrow(run, "x array<long>, n long, dim int, deviation long, white array<double>")


def identity_errors(white: DataFrame, fits: dict[int, Fit], weight: str) -> dict[int, float]:
    """Largest absolute entry of the whitened covariance minus the identity, by
    dimension; means first, then centred products, as grouped sums of at most
    ``components`` squared rows."""
    w = F.col("n") if weight == "count" else F.lit(1).cast("long")
    rows = white.select("dim", w.cast("double").alias("w"), "white")
    mean = (rows.select("dim", "w", F.posexplode("white").alias("i", "v")).groupBy("dim", "i")
            .agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("m")).collect())
    if not mean:
        return dict.fromkeys(fits, 0.0)
    by = {d: np.array([r["m"] for r in sorted((r for r in mean if r["dim"] == d), key=lambda r: r["i"])])
          for d in {r["dim"] for r in mean}}
    table = F.create_map(*[F.lit(v) for d, m in by.items() for v in (d, m.tolist())])
    c = rows.select("dim", "w", F.zip_with("white", table[F.col("dim")], lambda a, b: a - b).alias("c"))
    pairs = c.select("dim", "w", "c", F.posexplode("c").alias("i", "a")).select("dim", "w", "i", "a", F.posexplode("c").alias("j", "b"))
    cov = pairs.groupBy("dim", "i", "j").agg((F.sum(F.col("w") * F.col("a") * F.col("b")) / F.sum("w")).alias("v")).collect()
    return {d: max((abs(r["v"] - (r["i"] == r["j"])) for r in cov if r["dim"] == d), default=0.0) for d in fits}


def whitened(vectors: DataFrame, components: int = COMPONENTS, weight: str = "count", scale: int = SCALE,
             shift: int = SHIFT, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """``(key, component, n, deviation, whitened, explained, identity_error)``,
    one row per row of ``vectors`` and component.

    Rows whose vector is null or holds a null or non-finite entry are dropped.
    Vectors of different lengths are fitted apart, each length by itself; empty
    vectors have no components and give no rows. Components whose variance is
    (numerically) zero cannot be whitened and are left out, so copies of a
    single vector give no rows. A deviation beyond a long is null. Null and
    repeated keys and repeated rows are rows of their own and count in the fit. An empty
    table gives an empty result. Other columns are not read. Between steps
    the distinct vectors lie in the checkpoint folder.
    """
    rows = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vec}`").alias("v")).where(finite(F.col("v")))
    rows = rows.select("key", whole(F.col("v"), scale, shift).alias("x"))
    distinct = reliable(distinct_vectors(rows, "x"))
    fits = fit(distinct, components, weight)
    white = reliable(projected(distinct, fits))
    errors = identity_errors(white, fits, weight)
    # A hot vector's rows are split by adaptive execution: the other side has one row per vector.
    names = ("n", "error", "explained")
    facts = {d: (f.n, errors[d], (f.values / f.trace).tolist()) for d, f in fits.items() if f.values is not None and len(f.values)}
    if facts:
        table = F.create_map(*[c for d, v in facts.items()
                               for c in (F.lit(d), F.struct(*[F.lit(a).alias(b) for a, b in zip(v, names)]))])
        white = white.withColumn("fact", table[F.col("dim")]).where("fact is not null")
    else:
        white = white.withColumn("fact", F.lit(None).cast("struct<n:long,error:double,explained:array<double>>")).where("false")
    ids = lambda x: (F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2"))
    white = white.select(*ids(F.col("x")), "deviation", "white", "fact")
    out = rows.select("key", *ids(F.col("x"))).join(white.hint("merge"), ["h1", "h2"])
    out = out.select("key", "deviation", "fact", F.posexplode("white").alias("i", "whitened"))
    return out.select(F.col("key").alias(key), (F.col("i") + 1).alias("component"), F.col("fact.n").cast("long").alias("n"),
                      "deviation", "whitened", F.element_at("fact.explained", F.col("i") + 1).alias("explained"),
                      F.col("fact.error").alias("identity_error"))
