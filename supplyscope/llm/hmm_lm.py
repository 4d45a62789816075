"""Hidden Markov language model, trained by Baum-Welch over the whole training corpus.

Tokens are words and one end mark a text. Every training word has emissions of
its own in every state. They are learned in two steps:

1. Transitions and classes. Each token has a class: the end, each of the
   ``FREQUENT`` most frequent words, and for all other words, known or not, one
   of ``RARE`` classes by the hash of their last three characters. Baum-Welch
   runs over the class sequences of all training texts, in steps: the texts are
   dealt to ``PARTS`` parts, each part's expected counts are kept, and the
   model is maximized anew after each part, until another round over the corpus
   would gain next to nothing.
2. Words. One more pass adds up the expected counts of every (word, state):
   per block by local word number, then over all blocks by word. Within its
   class and state a word has its discounted expected count; the discounts go
   back to the words in proportion to what the class says about the state.

A class's unknown word has the class's share of discounted mass, so words
outside the training texts, and only these, are scored by their class.

The texts are read once, into blocks: rows of local word numbers with the
block's dictionary. Dictionaries, not tokens, are shuffled to add up counts and
to bring emissions back to the blocks. Expected counts are exact sums over
texts: where a text is longer than ``WHOLE`` times ``SEGMENT`` tokens, texts are cut into pieces that run
abreast, and products of the pieces' transfer matrices carry the recursions over the cuts. Scores
are exact: the scaled forward recursion runs over each whole text. A word's
distribution over the states travels in eight bits a state.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope.llm.common import give_back, reliable, slices, stage_table
from supplyscope.session import drop_path, setting

STATES = 8                 # one byte each of a word's packed shares
FREQUENT, RARE = 4096, 2048
LEAST_SHARE = 1 / (1 << 17)   # of a block's tokens: a word below it in every block is in a rare class
PARTS = 16                 # parts of the corpus, each followed by a maximization
SEGMENT = 4096             # longest piece of a text that is run through at once
WHOLE = 3                  # texts of a batch without one longer than so many pieces are not cut: steps cost less than matrices
SETTLED = 5e-4             # nats a token that another round must promise
SMOOTH = 0.1               # added to each count of the base model
SHARE = 255                # a word's share of a state, in whole steps
_SLICE = 16 << 20          # bytes of text of a block at most, but for a longer text
_BATCH = 12 << 20          # bytes at which rows go on to Python, so that texts make a block and blocks come one by one
_RUN = 1 << 21             # tokens of a training batch
_AT_ONCE = 1 << 15         # tokens whose figures are made at once, so that they stay in the cache


# ---------------------------------------------------------------- tokens and counts
def numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(local word numbers of all tokens, tokens per text, words by number), frequent
    words first; the end mark is the empty word."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    off = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    del parts                                                  # here and below: what is large goes before more is made
    words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int32, copy=False)
    del coded
    end = pc.index(words, "").as_py()                          # white space around a text leaves empty words
    if end < 0:
        end, words = len(words), pa.concat_arrays([words, pa.array([""])])
    real = code != end
    before = np.concatenate(([0], np.cumsum(real)))[off - off[0]]
    tokens = np.insert(code[real], before[1:], end)
    del code, real
    order = np.argsort(-np.bincount(tokens, minlength=len(words)), kind="stable")
    place = np.empty(len(words), np.int32)
    place[order] = np.arange(len(words), dtype=np.int32)
    return place[tokens], np.diff(before) + 1, words.take(pa.array(order))


def split_block(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """``numbered`` with the words as a list."""
    ids, count, words = numbered(texts)
    return ids, count, words.to_pylist()


def squeezed(ids: np.ndarray) -> bytes:
    """Word numbers as compressed bytes, all lowest bytes first: Spark holds and copies what it moves uncompressed."""
    return pa.Codec("zstd", 1).compress(ids.astype(np.int32).view(np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True)


def ids_of(b: pa.RecordBatch | pa.Table, i: int, tokens: int) -> np.ndarray:
    """The word numbers of block ``i``."""
    raw = pa.Codec("zstd").decompress(b.column("ids")[i].as_py(), 4 * tokens)
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view(np.int32).ravel()


def blocks(docs: DataFrame, held_out: Column, key: str, text: str) -> DataFrame:
    """One row per block: its texts (keys, held out or not, tokens, word numbers end to
    end), its dictionary (words by number with their counts in training texts, their classes
    without the frequent ones) and, of that, the words (the end mark apart) that make up
    ``LEAST_SHARE`` of its training tokens."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(held_out, F.lit(False)).alias("held"),
                       F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        none = pa.array([], pa.string())
        listed = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
        for batch in batches:
            for b in slices(batch, "text", _SLICE):
                ids, count, words = numbered(b.column("text"))
                held = b.column("held").to_numpy(zero_copy_only=False).astype(bool)
                tf = np.bincount(ids[np.repeat(~held, count)], minlength=len(words))
                often = np.flatnonzero((tf > 0) & (tf >= tf.sum() * LEAST_SHARE))
                often = often[pc.not_equal(words.take(pa.array(often)), "").to_numpy(zero_copy_only=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), listed(pa.concat_arrays([b.column("key")])), listed(pa.array(held)),
                     listed(pa.array(count)), pa.array([squeezed(ids)], pa.binary()), listed(words), listed(pa.array(tf)),
                     pa.array([classes_of(words, none).tobytes()], pa.binary()), listed(words.take(pa.array(often))), listed(pa.array(tf[often]))],
                    names=["block", "key", "held", "n", "ids", "words", "tf", "tails", "often", "often_tf"])
                block += 1
        give_back()

    return rows.mapInArrow(run, f"block long, key array<{kind}>, held array<boolean>, n array<long>, ids binary, "
                                "words array<string>, tf array<long>, tails binary, often array<string>, often_tf array<long>")


def stage_blocks(found: DataFrame) -> tuple[DataFrame, str]:
    """The blocks as a table. A row group is one block: Spark's writer holds, and its reader unpacks, a row group at once."""
    return stage_table(found, "lm-blocks", compression="zstd", **{"parquet.block.row.count.limit": "1"})


def dictionary(read: DataFrame) -> DataFrame:
    """``(block, id, word)``: the words of all blocks."""
    return read.select("block", F.posexplode("words").alias("id", "word"))


def frequent_words(read: DataFrame) -> list[str]:
    """The ``FREQUENT`` words (the end mark apart) with the highest counts over those blocks in
    which they make up ``LEAST_SHARE`` of the training tokens: at most 1 / ``LEAST_SHARE`` rows a
    block are shuffled. Ties go by the word."""
    often = read.select(F.explode(F.arrays_zip(F.col("often").alias("words"), F.col("often_tf").alias("tf"))).alias("w"))
    top = often.groupBy(F.col("w.words").alias("word")).agg(F.sum("w.tf").alias("c")).orderBy(F.desc("c"), "word").limit(FREQUENT)
    return [r["word"] for r in top.collect()]


def classes() -> int:
    return 1 + FREQUENT + RARE


def classes_of(words: pa.Array, frequent: pa.Array) -> np.ndarray:
    """Class of each word: 0 the end, 1.. the frequent words by rank, then the tails."""
    tails = pc.utf8_slice_codeunits(words, -3).dictionary_encode()
    tail = np.array([zlib.crc32(t.encode()) % RARE for t in tails.dictionary.to_pylist()], np.int64)
    cls = 1 + FREQUENT + tail[tails.indices.to_numpy(zero_copy_only=False)]
    rank = pc.index_in(words, frequent)
    known = rank.is_valid().to_numpy(zero_copy_only=False)
    cls[known] = 1 + rank.drop_null().to_numpy()
    cls[pc.equal(words, "").to_numpy(zero_copy_only=False)] = 0
    return cls.astype(np.uint16)


def training_tokens(b: pa.RecordBatch, i: int, frequent: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers of the block's training texts end to end, tokens per text, class of each word)."""
    held = b.column("held")[i].values.to_numpy(zero_copy_only=False).astype(bool)
    n = b.column("n")[i].values.to_numpy()
    ids = ids_of(b, i, n.sum())[np.repeat(~held, n)]
    return ids, n[~held], classes_of(b.column("words")[i].values, frequent)


def coded_parts(read: DataFrame, frequent: list[str]) -> DataFrame:
    """``(part, cls)``: classes of training texts end to end, a row for each block and part.
    Class 0 is the end mark and nothing else, so it tells the texts apart. A task takes
    blocks for about a batch of each part, so that a part is few files however many blocks there are."""
    top = pa.array(frequent, pa.string())
    tokens = read.agg(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0] or 0
    groups = 1 + tokens // (PARTS * _RUN * 3 // 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, n, cls = training_tokens(b, i, top)
                texts = np.split(cls[ids], np.cumsum(n)[:-1])
                rows = [np.concatenate([np.zeros(0, np.uint16), *texts[p::PARTS]]).tobytes() for p in range(PARTS)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(PARTS, dtype=np.int32)), pa.array(rows, pa.binary())],
                                                 names=["part", "cls"])
        give_back()

    few = read.select("held", "n", "ids", "words").coalesce(groups)
    return few.mapInArrow(run, "part int, cls binary").where(F.length("cls") > 0)


def class_counts(coded: DataFrame) -> np.ndarray:
    """Training tokens by class."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(classes(), np.int64)
        for f in frames:
            for c in f["cls"]:
                total += np.bincount(np.frombuffer(c, np.uint16), minlength=classes())
        some = np.flatnonzero(total)
        yield pd.DataFrame({"k": some, "n": total[some]})

    got = coded.select("cls").mapInPandas(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(classes())
    total[got["k"]] = got["n"]
    return total


# ---------------------------------------------------------------- Baum-Welch
@dataclass
class Model:
    start: np.ndarray      # (states)
    move: np.ndarray       # (states, states)
    emit: np.ndarray       # (classes, states)
    share: np.ndarray      # (states), how often each state is taken


def first_model(prior: np.ndarray, seed: int = 0) -> Model:
    rng = np.random.default_rng(seed)
    emit = prior[:, None] * rng.gamma(2.0, 0.5, (len(prior), STATES))
    move = np.full((STATES, STATES), 0.1 / max(1, STATES - 1))
    np.fill_diagonal(move, 0.9)
    even = np.full(STATES, 1 / STATES)
    return Model(even, move, emit / emit.sum(0), even)


@dataclass
class Pieces:
    """Texts cut into pieces of at most ``SEGMENT`` tokens, longest first and abreast:
    at step ``t`` the first ``live[t]`` pieces have a token."""

    at: np.ndarray         # position of the first token
    size: np.ndarray
    live: np.ndarray

    @classmethod
    def of(cls, at: np.ndarray, size: np.ndarray) -> Pieces:
        return cls(at, size, np.searchsorted(-size, -np.arange(size[0]), side="left"))


def spans(off: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of steps of about ``_AT_ONCE`` tokens; step ``t`` has the tokens from ``off[t]`` on."""
    new = np.flatnonzero(np.diff(off[:-1] // _AT_ONCE, prepend=-1))
    yield from zip(new.tolist(), [*new[1:].tolist(), len(off) - 1])


def transfers(m: Model, obs: np.ndarray, p: Pieces, on: np.ndarray) -> np.ndarray:
    """Per piece the matrix that takes the state before it to the state at its end,
    up to a factor; the move into the piece is part of it where ``on``."""
    emit, move = m.emit.astype(np.float32), m.move.astype(np.float32)
    x = np.where(on[:, None, None], move, np.eye(STATES, dtype=np.float32))
    for t, n in enumerate(p.live):
        y = x[:n] @ move if t else x[:n]
        y = y * emit[obs[p.at[:n] + t]][:, None]
        x[:n] = y / y.sum((1, 2), keepdims=True)
    return x


def edges(m: Model, obs: np.ndarray, at: np.ndarray, size: np.ndarray, on: np.ndarray,
          ) -> tuple[np.ndarray, np.ndarray]:
    """(state before, outlook after) each piece: ``alpha`` of the token before and
    ``beta`` of the last token, both up to a factor. Pieces are in text order."""
    before = np.tile(m.start, (len(at), 1))
    after = np.ones((len(at), STATES))
    go = np.append(on[1:], False)                             # the text goes on after the piece
    cut = np.flatnonzero(on | go)                             # pieces of texts with several
    by = cut[np.argsort(-size[cut], kind="stable")]
    matrix = np.empty((len(at), STATES, STATES), np.float32) if len(cut) else None
    for i in range(0, len(by), max(1, _RUN // (STATES * SEGMENT))):
        some = by[i:i + max(1, _RUN // (STATES * SEGMENT))]
        matrix[some] = transfers(m, obs, Pieces.of(at[some], size[some]), on[some])
    for i in cut[on[cut]]:
        x = before[i - 1] @ matrix[i - 1]
        before[i] = x / x.sum()
    for i in cut[go[cut]][::-1]:
        x = matrix[i + 1] @ after[i + 1]
        after[i] = x / x.sum()
    return before, after


def forward_backward(m: Model, cls: np.ndarray, ends: np.ndarray, into: np.ndarray | None = None, size_into: int = 0,
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts (emissions by class, moves, starts) of texts laid end to end,
    and their log-likelihood; ``ends`` marks each text's last token. With
    ``into``, emissions are counted by these numbers instead of the classes."""
    into, size_into = (cls, len(m.emit)) if into is None else (into, size_into)
    stop = np.flatnonzero(ends) + 1
    first = np.concatenate(([0], stop[:-1]))
    longest = int((stop - first).max())
    piece = SEGMENT if longest > WHOLE * SEGMENT else longest
    many = -(-(stop - first) // piece)
    j = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = np.repeat(first, many) + j * piece
    size, on = np.minimum(piece, np.repeat(stop, many) - at), j > 0
    before, after = edges(m, cls, at, size, on)
    emit, move, ones = m.emit.astype(np.float32), m.move.astype(np.float32), np.ones((STATES, STATES), np.float32)
    # Both recursions in one product: from a piece's first token on, and from its last one back. Sums over states are
    # products with ones, so that all arrays run along memory.
    step, sums = np.zeros((2, 2, STATES, 2, STATES), np.float32)
    step[0, :, 0], step[1, :, 1], sums[0, :, 0], sums[1, :, 1] = move, move.T, ones, ones
    step, sums = step.reshape(2 * STATES, -1), sums.reshape(2 * STATES, -1)
    by, moves, starts, like = np.zeros((STATES, size_into)), np.zeros((STATES, STATES)), np.zeros(STATES), 0.0
    # Pieces are independent now. Runs are of pieces of like size, so that only the first has many steps.
    order = np.argsort(-size, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff((np.cumsum(size[order]) - 1) // (_RUN // 4))) + 1):
        p, go = Pieces.of(at[some], size[some]), on[some]
        prior, outlook = before[some].astype(np.float32), after[some].astype(np.float32)
        off = np.concatenate(([0], np.cumsum(p.live)))
        seen = np.empty(off[-1], np.intp)                  # what the tokens are counted by, once and not once a state
        both = np.empty((off[-1], 2 * STATES), np.float32)
        x = np.hstack([np.where(go[:, None], prior @ move, prior), outlook])
        for a, b in spans(off):
            t, i = np.repeat(np.arange(a, b), p.live[a:b]), np.arange(off[a], off[b])
            i -= off[t]
            place = p.at[i] + t
            seen[off[a]:off[b]] = into[place]
            pair = np.stack([cls[place], cls[2 * p.at[i] + p.size[i] - 1 - place]], axis=1).astype(np.intp)
            see = emit.take(pair.ravel(), axis=0).reshape(-1, 2 * STATES)      # what each state says to each token
            at_step, o = off[a:b + 1].tolist(), int(off[a])
            for lo, hi in zip(at_step[:-1], at_step[1:]):
                here = both[lo:hi]
                if lo:
                    x = x[:hi - lo]
                    np.matmul(x, step, out=here)
                    here /= x @ sums
                    here *= see[lo - o:hi - o]
                else:
                    np.multiply(x, see[:hi], out=here)
                x = here
        halves, counted = both.reshape(-1, STATES), 0
        for a, b in spans(off):
            t, i = np.repeat(np.arange(a, b), p.live[a:b]), np.arange(off[a], off[b])
            i -= off[t]
            left = p.size[i] - 1 - t                       # tokens of the piece after this one
            last = np.flatnonzero(left == 0)
            ahead = halves.take(2 * (off[left - 1] + i) + 1, axis=0, mode="clip")   # the next token's, where there is one
            ahead /= ahead @ ones
            ahead[last] = 0
            alpha = both[off[a]:off[b], :STATES].copy()
            scale = alpha @ ones
            like += float(np.log(scale[:, 0]).sum(dtype=np.float64))
            alpha /= scale
            gamma = ahead @ move.T
            gamma[last] = outlook[i[last]]
            gamma *= alpha
            whole = gamma @ ones
            gamma /= whole
            alpha /= whole
            moves += alpha.T @ ahead
            both[off[a]:off[b], :STATES] = gamma
            if off[b] - counted >= size_into or off[b] == off[-1]:
                group, counted = slice(counted, off[b]), off[b]
                for s in range(STATES):
                    by[s] += np.bincount(seen[group], both[group, s], size_into)
        cut = np.flatnonzero(go)
        ahead = both[off[p.size[cut] - 1] + cut, STATES:]
        moves += prior[cut].T @ (ahead / (prior[cut] @ move * ahead).sum(1, keepdims=True))
        starts += both[:len(go), :STATES][~go].sum(0)
    return by.T, moves * m.move, starts, like


def expected(m: Model, cls: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return forward_backward(m, cls, ends)[:3]


def maximized(by: np.ndarray, moves: np.ndarray, starts: np.ndarray, prior: np.ndarray) -> Model:
    """The next model; one token's worth of ``prior`` keeps every class possible in every state."""
    emit = (by + prior[:, None]) / (by.sum(0) + 1)
    move = (moves + 0.1) / (moves + 0.1).sum(1, keepdims=True)
    start = (starts + 0.1) / (starts + 0.1).sum()
    return Model(start, move, emit, (by.sum(0) + 0.1) / (by.sum() + 0.1 * STATES))


def batches_of(cls: list[bytes], tokens: int) -> Iterator[np.ndarray]:
    """Class sequences joined to batches of about ``tokens`` tokens, a sequence at least."""
    held, have = [], 0
    for i, c in enumerate(cls):
        held.append(np.frombuffer(c, np.uint16))
        have += len(held[-1])
        if have >= tokens or i == len(cls) - 1:
            yield np.concatenate(held)
            held, have = [], 0


def baum_welch(train: DataFrame, m: Model) -> tuple[np.ndarray, float]:
    """Expected counts of ``train`` under ``m``, stacked (classes, moves, starts), and the
    log-likelihood. Each task adds up its own; the sums over tasks are a grouped
    sum of ``classes + states + 2`` keys."""
    shared = train.sparkSession.sparkContext.broadcast(m)                 # under 1 MB
    n = len(m.emit)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((n + STATES + 2, STATES))
        for f in frames:
            for cls in batches_of(list(f["cls"]), _RUN):
                by, moves, starts, like = forward_backward(shared.value, cls, cls == 0)
                total[:-1] += np.concatenate([by, moves, starts[None]])
                total[-1, 0] += like
        some = np.flatnonzero(total.any(axis=1))
        if len(some):
            yield pd.DataFrame({"k": some} | {f"s{i}": total[some, i] for i in range(STATES)})
        give_back()

    names = [f"s{i}" for i in range(STATES)]
    sums = train.select("cls").mapInPandas(run, "k int, " + ", ".join(f"{s} double" for s in names))
    got = sums.groupBy("k").agg(*(F.sum(s).alias(s) for s in names)).toPandas()
    total = np.zeros((n + STATES + 2, STATES))
    total[got["k"]] = got[names]
    shared.destroy()
    return total[:-1], float(total[-1, 0])


def settled(likes: list[float], tokens: float) -> bool:
    """True if the next round would gain less than ``SETTLED`` a token, as the last two gains foretell."""
    if len(likes) < 3:
        return False
    before, now = likes[-2] - likes[-3], likes[-1] - likes[-2]
    return now <= 0 or now * min(1.0, now / max(before, 1e-300)) < SETTLED * tokens


def fit(coded: DataFrame, counts: np.ndarray, rounds: int | None = None, seed: int = 0) -> Model:
    """Stepwise Baum-Welch over all parts, round after round until it settles, or as many rounds as asked for."""
    prior = (counts + SMOOTH) / (counts + SMOOTH).sum()
    m, likes, parts = first_model(prior, seed), [], {}
    n = len(prior)
    while counts.sum() and len(likes) != rounds:
        like = 0.0
        for p in range(PARTS):
            parts[p], gain = baum_welch(coded.where(F.col("part") == p), m)
            like += gain
            total = sum(parts.values())
            m = maximized(total[:n], total[n:-1], total[-1], prior)
        likes.append(like)
        if rounds is None and settled(likes, counts.sum()):
            break
    return m


# ---------------------------------------------------------------- words
def packed(expected: np.ndarray) -> np.ndarray:
    """Shares of the states in whole steps of 1 / ``SHARE``, one byte a state."""
    steps = np.empty(expected.shape, np.uint8)
    for i in range(0, len(steps), _AT_ONCE):
        some = expected[i:i + _AT_ONCE]
        total = some.sum(1, keepdims=True)
        steps[i:i + _AT_ONCE] = np.rint(some / np.where(total > 0, total, 1) * SHARE)
    return steps.view(np.int64).ravel()


def word_shares(read: DataFrame, m: Model, frequent: list[str]) -> DataFrame:
    """``(word, tf, p)``: for each training word of a block its count and its share of each state."""
    shared, top = read.sparkSession.sparkContext.broadcast(m), pa.array(frequent, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, _, cls = training_tokens(b, i, top)
                words, tf = b.column("words")[i].values, b.column("tf")[i].values
                code = cls[ids]
                by = (forward_backward(shared.value, code, code == 0, ids, len(words))[0] if len(ids)
                      else np.zeros((len(words), STATES)))
                some = pc.greater(tf, 0)
                yield pa.RecordBatch.from_arrays([words.filter(some), tf.filter(some), pa.array(packed(by)).filter(some)],
                                                 names=["word", "tf", "p"])
        give_back()

    return read.select("held", "n", "ids", "words", "tf").mapInArrow(run, "word string, tf long, p long")


def share_of(p: Column, s: int) -> Column:
    return F.shiftrightunsigned(p, 8 * s).bitwiseAND(F.lit(255))


def word_table(shares: DataFrame, frequent: list[str]) -> DataFrame:
    """``(word, c, cls, p)``: every training word with its count, class and shares over all blocks."""
    spark = shares.sparkSession
    sums = shares.groupBy("word").agg(F.sum("tf").alias("c"),
                                      *[F.sum(F.col("tf") * share_of(F.col("p"), s)).alias(f"q{s}") for s in range(STATES)])
    total = sum((F.col(f"q{s}") for s in range(STATES)), F.lit(0))
    p = F.lit(0).cast("long")
    for s in range(STATES):
        p = p.bitwiseOR(F.shiftleft(F.round(F.col(f"q{s}") * SHARE / F.greatest(total, F.lit(1))).cast("long"), 8 * s))
    # FREQUENT rows, from Arrow: a list would start Python workers of another kind, which stay beside those of the tasks.
    rank = spark.createDataFrame(pa.table({"word": pa.array(frequent, pa.string()), "rank": np.arange(1, len(frequent) + 1, dtype=np.int32)}))
    tail = F.lit(1 + FREQUENT) + F.pmod(F.crc32(F.right("word", F.lit(3)).cast("binary")), F.lit(RARE))
    cls = F.when(F.col("word") == "", 0).otherwise(F.coalesce("rank", tail)).cast("int")
    return sums.join(F.broadcast(rank), "word", "left").select("word", "c", cls.alias("cls"), p.alias("p"))


@dataclass
class Words:
    """What is needed beside a word's own count and shares: corpus figures, and by class its
    states, its words' discounted counts in each state, and its unknown word's share."""

    model: Model
    tokens: int
    distinct: int
    discount: float
    total: np.ndarray          # (classes) training tokens
    within: np.ndarray         # (classes, states) sum of the discounted counts of the class's words
    prior: np.ndarray          # (classes, states) the class's share of each state
    unknown: np.ndarray        # (classes)

    def emissions(self, cls: np.ndarray, c: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Probability of each word in each state; a word with ``c`` 0 is its class's unknown word."""
        out = np.empty((len(cls), STATES))
        for i in range(0, len(cls), _AT_ONCE):
            out[i:i + _AT_ONCE] = self._emissions(cls[i:i + _AT_ONCE], c[i:i + _AT_ONCE], p[i:i + _AT_ONCE])
        return out

    def _emissions(self, cls: np.ndarray, c: np.ndarray, p: np.ndarray) -> np.ndarray:
        out = self.model.emit[cls] * self.unknown[cls][:, None]
        known = np.flatnonzero(c > 0)
        k = cls[known]
        own, of = smoothed(p[known], c[known], self.discount, self.prior[k]), self.within[k]
        # In a state that none of the class's words ever takes, they have their corpus shares.
        part = np.where(of > 0, own / np.where(of > 0, of, 1), (c[known] / self.total[k])[:, None])
        out[known] = self.model.emit[k] * (1 - self.unknown[k])[:, None] * part
        return out


def smoothed(p: np.ndarray, c: np.ndarray, discount: float, prior: np.ndarray) -> np.ndarray:
    """A word's counts by state: its own less the discount, which follows the class."""
    q = p[:, None].view(np.uint8).astype(np.float64)
    q /= np.maximum(q.sum(1, keepdims=True), 1)
    return q * (c - discount)[:, None] + discount * prior


def word_model(table: DataFrame, m: Model) -> Words:
    """Figures over the whole word table: two grouped sums of ``classes`` rows."""
    shares = [share_of(F.col("p"), s) for s in range(STATES)]
    whole = F.greatest(sum(shares, F.lit(0)), F.lit(1))
    part = [s / whole for s in shares]
    by = table.groupBy("cls").agg(
        F.sum("c").alias("total"), F.count(F.lit(1)).alias("types"), F.count_if(F.col("c") == 1).alias("n1"),
        F.count_if(F.col("c") == 2).alias("n2"), *[F.sum(F.col("c") * x).alias(f"e{s}") for s, x in enumerate(part)],
        *[F.sum(x).alias(f"u{s}") for s, x in enumerate(part)]).toPandas()
    n, k = classes(), by["cls"].to_numpy()
    total, types, e, u = np.zeros(n), np.zeros(n), np.zeros((n, STATES)), np.zeros((n, STATES))
    total[k], types[k] = by["total"], by["types"]
    e[k], u[k] = by[[f"e{s}" for s in range(STATES)]], by[[f"u{s}" for s in range(STATES)]]
    rare = k > FREQUENT
    n1, n2 = int(by["n1"][rare].sum()), int(by["n2"][rare].sum())
    discount = min(0.9, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5
    prior = e / np.maximum(e.sum(1, keepdims=True), 1e-300)
    within = e - discount * u + discount * types[:, None] * prior
    unknown = np.where(total > 0, discount * types / np.maximum(total, 1), 1.0)
    unknown[:1 + FREQUENT] = np.where(total[:1 + FREQUENT] > 0, 0.0, 1.0)     # a frequent word is its class
    base = (total + SMOOTH) / (total + SMOOTH).sum()
    emit = (e + base[:, None]) / (e.sum(0) + 1)
    return Words(replace(m, emit=emit), int(total.sum()), int(types.sum()), discount, total, within, prior, unknown)


# ---------------------------------------------------------------- scoring
def log10_likelihoods(m: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Exact log10 probability of each class sequence: scaled forward recursion, all texts abreast."""
    size = np.array([len(t) for t in texts])
    order = np.argsort(-size, kind="stable")
    size, flat = size[order], np.concatenate([texts[i] for i in order])
    at = np.cumsum(size) - size
    total = np.zeros(len(texts))
    p, ones, x = Pieces.of(at, size), np.ones((STATES, STATES)), np.tile(m.start, (len(texts), 1))
    off = np.concatenate(([0], np.cumsum(p.live)))     # steps; each has a token of the texts longer than it
    for a, b in spans(off):
        t, i = np.repeat(np.arange(a, b), p.live[a:b]), np.arange(off[a], off[b])
        i -= off[t]
        see = m.emit.take(flat[at[i] + t].astype(np.intp), axis=0)
        at_step = (off[a:b + 1] - off[a]).tolist()
        for k, (lo, hi) in enumerate(zip(at_step[:-1], at_step[1:])):
            here = see[lo:hi]                          # becomes alpha, whose sum is the token's probability
            here *= x[:hi - lo] @ m.move / (x[:hi - lo] @ ones) if a + k else x
            x = here
        total += np.bincount(i, np.log(see @ ones[0]), len(texts))
    out = np.empty(len(texts))
    out[order] = total / np.log(10)
    return out


def scored(read: DataFrame, table: DataFrame, w: Words) -> DataFrame:
    """A row per text. Each block's known words come back from the word table by
    (block, number) and meet the block's texts. Frequent words are known, so the block
    itself tells the classes of all others."""
    kind = read.schema["key"].dataType.elementType.simpleString()
    shared = read.sparkSession.sparkContext.broadcast(w)
    known = dictionary(read).withColumnRenamed("block", "of").join(table, "word").drop("word")
    texts = read.select("block", "key", "n", "held", "tails", "ids")

    def run(b: pa.Table, d: pa.Table) -> pa.Table:
        v = shared.value
        out = []
        for i in range(b.num_rows):
            n = b.column("n")[i].values.to_numpy()
            cls = np.frombuffer(b.column("tails")[i].as_py(), np.uint16).copy()
            c, p = np.zeros(len(cls), np.int64), np.zeros(len(cls), np.int64)
            at = d.column("id").to_numpy()
            cls[at], c[at], p[at] = d.column("cls").to_numpy(), d.column("c").to_numpy(), d.column("p").to_numpy()
            ids, ends = ids_of(b, i, n.sum()), np.cumsum(n)
            like = log10_likelihoods(replace(v.model, emit=v.emissions(cls, c, p)), np.split(ids, ends[:-1]))
            base = np.log10((c + SMOOTH) / (v.tokens + SMOOTH * (v.distinct + 1)))
            sums = lambda x: np.add.reduceat(x[ids], ends - n)
            out.append(pa.table([b.column("key")[i].values, b.column("held")[i].values, pa.array(n), pa.array(sums((c > 0).astype(np.int64))),
                                 pa.array(sums(base)), pa.array(like)], names=names))
        give_back()
        return pa.concat_tables(out)

    names = ["key", "held", "n_tokens", "n_known", "base", "score"]
    return texts.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
        run, f"key {kind}, held boolean, n_tokens long, n_known long, base double, score double")


def let_go(spark: SparkSession) -> None:
    """Have the driver collect its garbage, so that shuffle files of finished steps are deleted now and not some time."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def score_documents(docs: DataFrame, held_out: Column, rounds: int | None = None, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``(key, held, n_tokens, n_known, train_tokens, base, score)`` for every row.

    The model and the counts learn from rows for which ``held_out`` is not true,
    until the log-likelihood settles unless a number of ``rounds`` is given.
    A null or empty text is the end mark alone. Null or repeated keys and
    repeated rows are rows of their own. Without training rows every word is
    unknown and the states are even; an empty table gives an empty result.
    Other columns are not read.
    """
    spark = docs.sparkSession
    with setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(_BATCH)):
        read, read_path = stage_blocks(blocks(docs, held_out, key, text))
        frequent = frequent_words(read)
        coded, coded_path = stage_table(coded_parts(read, frequent), "lm-classes", by="part", compression="zstd")
        m = fit(coded, class_counts(coded), rounds)
        drop_path(spark, coded_path)
        table, table_path = stage_table(word_table(word_shares(read, m, frequent), frequent), "lm-words", compression="zstd")
        w = word_model(table, m)
        let_go(spark)
        out = reliable(scored(read, table, w))
    for path in (read_path, table_path):
        drop_path(spark, path)
    return out.select(F.col("key").alias(key), "held", "n_tokens", "n_known", F.lit(w.tokens).cast("long").alias("train_tokens"),
                      "base", "score")
