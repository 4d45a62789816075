"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are covered by overlapping chunks, whole. Bytes have
learned embeddings; learned filters slide over each chunk and are max-pooled
over its positions; the largest, mean and smallest pooled value over the
document's chunks are combined into one probability. Training is plain
backpropagation (the pooled maxima pick the windows that learn) with Adam.

The network is fitted by the driver to at most ``SAMPLE`` labelled rows of
each class (those with the smallest hash), all chunks of each; scoring reads
every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyscope.llm.common import hash_sample, plainly_named, slices, stage_table, texts_as_bytes
from supplyscope.session import drop_path

CHUNK, OVERLAP = 512, 64
WIDTH, STEP = 8, 2         # bytes of a filter, bytes between its positions
EMBED, FILTERS = 8, 32
SAMPLE = 1200              # labelled rows of each class
EPOCHS, BATCH, RATE = 14, 48, 0.01
GROUP_BYTES = 64 << 20     # text of the sample that the driver holds at once
_RUN = 256                 # chunks convolved at once

Model = dict[str, np.ndarray]


def chunk_starts(length: int) -> np.ndarray:
    """Starts of the chunks that cover ``length`` bytes; the last one ends with the text."""
    last = max(0, length - CHUNK)
    return np.append(np.arange(0, last, CHUNK - OVERLAP), last)


def chunked(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(padded bytes of all texts, chunk starts, first chunk of each text)."""
    pad = bytes(CHUNK)
    starts, first, at = [], [0], 0
    for t in texts:
        s = chunk_starts(len(t))
        starts.append(at + s)
        first.append(first[-1] + len(s))
        at += len(t) + CHUNK
    return np.frombuffer(pad.join([*texts, b""]), np.uint8), np.concatenate(starts or [np.zeros(0, int)]), np.array(first[:-1])


def windows(m: Model, chunks: np.ndarray) -> np.ndarray:
    """All filter windows of the chunks: (chunks, positions, WIDTH * EMBED), a view."""
    x = m["embed"][chunks].reshape(len(chunks), CHUNK * EMBED)
    return np.lib.stride_tricks.sliding_window_view(x, WIDTH * EMBED, axis=1)[:, ::EMBED * STEP]


def pooled(m: Model, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest filter response per chunk and filter (ReLU), and where it is."""
    w = windows(m, chunks)
    y = (w.reshape(-1, WIDTH * EMBED) @ m["filter"]).reshape(len(chunks), w.shape[1], -1)
    at = y.argmax(axis=1)
    return np.maximum(0, np.take_along_axis(y, at[:, None], axis=1)[:, 0] + m["shift"]), at


def combine(m: Model, pool: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probability per text, its features) from the pooled chunks."""
    count = np.diff(np.append(first, len(pool)))
    f = np.concatenate([np.maximum.reduceat(pool, first), np.add.reduceat(pool, first) / count[:, None],
                        np.minimum.reduceat(pool, first)], axis=1)
    return 1 / (1 + np.exp(-np.clip(f @ m["out"] + m["bias"], -30, 30))), f


def score_texts(m: Model, texts: list[bytes]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    data, starts, first = chunked(texts)
    inside = np.arange(CHUNK)
    pool = np.concatenate([pooled(m, data[starts[i:i + _RUN, None] + inside])[0] for i in range(0, len(starts), _RUN)])
    return combine(m, pool, first)[0].astype(np.float64)


def gradients(m: Model, chunks: list[np.ndarray], label: np.ndarray, weight: np.ndarray) -> tuple[float, Model]:
    """Weighted mean log loss of texts given by their chunks, with a small penalty on
    the combination, and its gradient by every parameter."""
    data = np.concatenate(chunks)
    size = np.array([len(c) for c in chunks])
    first = np.cumsum(size) - size
    runs = [pooled(m, data[k:k + _RUN]) for k in range(0, len(data), _RUN)]
    pool, at = (np.concatenate(x) for x in zip(*runs))
    p, f = combine(m, pool, first)
    kind = m["out"].dtype
    loss = float(-(weight * np.log(np.where(label == 1, p, 1 - p))).sum() / len(label) + 5e-5 * (m["out"] ** 2).sum())
    d = ((p - label) * weight / len(label)).astype(kind)
    g: Model = {"out": f.T @ d + 1e-4 * m["out"], "bias": d.sum(keepdims=True)}
    # Back to the pooled chunks: the largest and smallest chunk of each text (those that tie share it), and all for the mean.
    own = np.repeat(np.arange(len(size)), size)
    top, mean, low = np.split(d[:, None] * m["out"], 3, axis=1)
    back = mean[own] / size[own, None]
    for part, best in ((top, f[:, :FILTERS]), (low, f[:, 2 * FILTERS:])):
        hit = pool == best[own]
        back += hit * (part / np.add.reduceat(hit, first, dtype=kind))[own]
    back *= pool > 0
    g["shift"] = back.sum(0)
    g["filter"], g["embed"] = np.zeros_like(m["filter"]), np.zeros_like(m["embed"])
    for k in range(0, len(data), _RUN):
        b, pos = back[k:k + _RUN], at[k:k + _RUN] * STEP
        byte = data[k:k + _RUN][np.arange(len(b))[:, None, None], pos[:, :, None] + np.arange(WIDTH)]
        win = m["embed"][byte].reshape(len(b), FILTERS, WIDTH * EMBED)
        g["filter"] += np.einsum("cf,cfw->wf", b, win)
        flow = (b[:, :, None] * m["filter"].T).reshape(-1, EMBED)
        for e in range(EMBED):
            g["embed"][:, e] += np.bincount(byte.ravel(), flow[:, e], 256).astype(kind)
    return loss, g


class Held:
    """Labelled texts in memory."""

    def __init__(self, samples: list[tuple[bytes, int]]):
        self.samples = samples

    def count(self) -> dict[int, int]:
        return {y: sum(z == y for _, z in self.samples) for y in (0, 1)}

    def epoch(self, i: int) -> Iterator[tuple[bytes, int]]:
        return (self.samples[j] for j in np.random.default_rng(i).permutation(len(self.samples)))


class Staged:
    """Labelled texts ``(k, y, b)`` in a table, read group by group: groups of about ``GROUP_BYTES``
    of text by a hash of the key, in another order each epoch, so the driver holds one group at a time."""

    def __init__(self, rows: DataFrame):
        total = rows.agg(F.sum(F.length("b"))).first()[0] or 0
        self.groups = max(1, -(-total // GROUP_BYTES))
        self.rows = rows.withColumn("g", F.pmod(F.xxhash64("k", "y"), F.lit(self.groups)))

    def count(self) -> dict[int, int]:
        got = {r["y"]: r["count"] for r in self.rows.groupBy("y").count().collect()}
        return {y: got.get(y, 0) for y in (0, 1)}

    def epoch(self, i: int) -> Iterator[tuple[bytes, int]]:
        rng = np.random.default_rng(i)
        for g in rng.permutation(self.groups):
            some = self.rows.where(F.col("g") == int(g)).select("k", "y", "b").collect()
            some.sort(key=lambda r: (r["k"], r["y"]))
            yield from ((bytes(some[j]["b"]), some[j]["y"]) for j in rng.permutation(len(some)))


def batches(samples: Iterator[tuple[bytes, int]], size: int) -> Iterator[list[tuple[bytes, int]]]:
    while some := list(islice(samples, size)):
        yield some


def cut(text: bytes) -> np.ndarray:
    """All chunks of a text, padded: (chunks, CHUNK)."""
    data, starts, _ = chunked([text])
    return data[starts[:, None] + np.arange(CHUNK)]


def fit(samples: Held | Staged, seed: int = 0) -> Model:
    """Train on labelled whole texts; both classes weigh the same. Without
    samples, or with one class only, the untrained combination gives that
    class's side (0.5 without any)."""
    rng = np.random.default_rng(seed)
    f32 = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
    m: Model = {"embed": f32(256, EMBED, s=0.5), "filter": f32(WIDTH * EMBED, FILTERS, s=0.2),
                "shift": np.zeros(FILTERS, np.float32), "out": np.zeros(3 * FILTERS, np.float32),
                "bias": np.zeros(1, np.float32)}
    have = samples.count()
    if not have[0] or not have[1]:
        m["bias"] += 4 * (bool(have[1]) - bool(have[0]))
        return m
    share = have[1] / (have[0] + have[1])
    one, two = ({k: np.zeros_like(v) for k, v in m.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) + RATE / 20
        for some in batches(iter(samples.epoch(epoch)), BATCH):
            label = np.array([y for _, y in some], np.float32)
            _, g = gradients(m, [cut(t) for t, _ in some], label, np.where(label == 1, 0.5 / share, 0.5 / (1 - share)))
            step += 1
            for k in m:
                one[k] = 0.9 * one[k] + 0.1 * g[k]
                two[k] = 0.99 * two[k] + 0.01 * g[k] ** 2
                m[k] -= (rate * one[k] / (1 - 0.9 ** step) / (np.sqrt(two[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return m


def sampled(docs: DataFrame, labels: DataFrame, learn: Column, target: str, key: str, text: str, sample: int) -> DataFrame:
    """``(k, y, b)``: at most ``sample`` labelled texts of each class. A sampled id stands for one row of
    ``docs``: where it repeats, for the text with the smallest hash."""
    known = labels.where(learn & F.col(key).isNotNull() & F.col(target).isin(0, 1))
    known = known.select(F.col(key).alias("k"), F.col(target).cast("int").alias("y"))
    ids = [r for y in (0, 1) for r in hash_sample(known.where(F.col("y") == y), sample, "k", "y").collect()]
    few = docs.sparkSession.createDataFrame([(r["k"], r["y"]) for r in ids], known.schema)
    body = F.coalesce(F.encode(F.col(f"`{text}`"), "UTF-8"), F.lit(b""))
    rows = docs.select(F.col(f"`{key}`").alias("k"), body.alias("b")).join(F.broadcast(few), "k")      # 2 * sample ids
    return rows.groupBy("k", "y").agg(F.min_by("b", F.struct(F.xxhash64("b"), "b")).alias("b"))


def train(docs: DataFrame, labels: DataFrame, learn: Column, target: str = "quality", key: str = "doc_id",
          text: str = "text", sample: int = SAMPLE) -> Model:
    """Fit on the bounded sample of the labelled rows for which ``learn`` (over the key) holds.

    Null ids and labels other than 0 and 1 teach nothing; a null text is the
    empty text; an id that repeats in ``docs`` counts once (see :func:`sampled`).
    Without any sample the model says 0.5. The sample, whole texts, lies in the
    shared folder while the network is trained.
    """
    rows, path = stage_table(sampled(docs, labels, learn, target, key, text, sample), "quality-sample")
    model = fit(Staged(rows))
    drop_path(docs.sparkSession, path)
    return model


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with one more column, the probability of label 1 for the whole text.

    Null and empty texts are one chunk of padding and have a score like any
    other. Ids, ties and repeated rows do not matter to a score. An empty
    table gives an empty result; other columns are passed on unread.
    """
    if name in docs.columns:
        raise ValueError(f"the table already has a column {name}")
    shared = docs.sparkSession.sparkContext.broadcast(model)          # about 40 KB
    rows, (body,) = plainly_named(docs, text)
    schema = rows.select("*", F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, body, 4 << 20):
                score = score_texts(shared.value, texts_as_bytes(b.column(body)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], names=[*b.schema.names, "score"])

    return rows.mapInArrow(run, schema).toDF(*docs.columns, name)
