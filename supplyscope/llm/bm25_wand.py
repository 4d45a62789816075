"""Benchmark decontamination: BM25 over the test items, block-max WAND, overlap check.

The index is inverted over the test items, cut into parts of at most
``PART_WORDS`` words: postings by term in part order, in blocks that know
their largest impact. Impacts are BM25 weights divided by the part's own
score, so a query that holds all of a part's terms scores 1 and one threshold
fits all parts.

Every document is cut into overlapping passages that cover it, long enough
for any part to lie whole in one of them. For all passages of a batch at
once, the largest impacts of their distinct terms are added up per block of
``RANGE`` parts; blocks that cannot reach the threshold are skipped, and the
others are traversed by block-max WAND, which gives every part above it.
Question and answer are parts of their own and are retrieved each for itself,
wherever in the document they are. Items of which both are found are then
verified word by word over the whole document: five-word shingles of the
question and of the answer must be in it, or of the whole item where nothing
marks an answer.

Test items are held in index shards of ``SHARD_ITEMS`` items; a larger
benchmark is several passes over the documents, each with one bounded index.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from supplyscope.llm.common import plainly_named, reliable, slices

K1, B = 1.2, 0.75
THRESHOLD = 0.6            # of a part's own BM25 score
OVERLAP = 0.8              # of the question's and of the answer's shingles, or of the whole item's
SHINGLE = 5
PART_WORDS = 64
STRIDE = 32
BLOCK = 64                 # postings of a block
RANGE = 8                  # parts that the passages' bounds cover
SHARD_ITEMS = 2_000
_SEGMENT = 1 << 20         # bytes that are scanned at once
_BOUNDS = 1 << 18          # rows of impacts in memory at once

_WORD = np.ones(256, bool)                       # letters, digits and all non-ASCII bytes
_WORD[:128] = [chr(i).isalnum() for i in range(128)]
_WORDS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(n, b, np.uint64)], dtype=np.uint64)
                      for b in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word, by differences of a running polynomial sum."""
    a = np.frombuffer(text, np.uint8)
    edge = np.diff(np.concatenate(([0], _WORD[a].view(np.int8), [0])))
    s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _power_tables(len(a) + 1)
    total = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[:len(a)], out=total[1:])
    h = (total[e] - total[s]) * down[s]
    return s, (h ^ (h >> np.uint64(32))) * _BASE


def normalized(column: pa.Array) -> list[bytes]:
    return pc.utf8_lower(column.fill_null("")).cast(pa.binary()).to_pylist()


def split_item(words: list[bytes], text: bytes) -> tuple[list[bytes], ...]:
    """(question, answer): the answer is what follows the last question mark or
    ``answer:``. (whole item) if there is no such mark or no word on one side of it."""
    mark = max(text.rfind(b"?") + 1, text.rfind(b"answer:") + len(b"answer:") if b"answer:" in text else 0)
    n = len(_WORDS.findall(text[:mark])) if mark else 0
    return (words[:n], words[n:]) if 0 < n < len(words) else (words,)


def shingles(words: list[bytes], k: int) -> set[bytes]:
    return {b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def item_parts(words: list[bytes], text: bytes) -> Iterator[tuple[int, Counter]]:
    """(side, words) of an item's parts: side 0 the question or the whole item, 1 the answer."""
    for side, some in enumerate(split_item(words, text)):
        for i in range(0, len(some), PART_WORDS):
            yield side, Counter(some[i:i + PART_WORDS])


class Index:
    """Inverted index of one shard of test items; small, built by the driver, sent to tasks.

    ``df`` (parts that hold a word), ``n`` (parts) and ``mean`` (words of a part)
    are those of the whole benchmark, or of ``items`` if not given.
    """

    def __init__(self, items: list[tuple[object, str | None]], df: dict[bytes, int] | None = None, n: int = 0,
                 mean: float = 0.0):
        self.items, self.words, self.texts = [], [], []
        parts: list[tuple[int, int, Counter]] = []
        for (item, _), low in zip(items, normalized(pa.array([t for _, t in items], pa.string()))):
            words = _WORDS.findall(low)
            if not words:
                continue                                      # nothing to find
            parts += [(len(self.items), side, c) for side, c in item_parts(words, low)]
            self.items.append(item)
            self.words.append(words)
            self.texts.append(low)
        self.item_of, self.side_of = (np.array([p[i] for p in parts], np.int64) for i in (0, 1))
        self.sides = [len(split_item(w, t)) for w, t in zip(self.words, self.texts)]
        if df is None:
            df = Counter(t for *_, c in parts for t in c)
            n, mean = len(parts), sum(c.total() for *_, c in parts) / max(1, len(parts))
        rows: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
        for p, (*_, c) in enumerate(parts):
            w = {t: np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * c.total() / mean))
                 for t, f in c.items()}
            own = sum(w.values())
            for t, x in w.items():
                rows[t].append((p, x / own))
        vocabulary = np.array([word_hashes(t)[1][0] for t in rows], np.uint64)
        order = np.argsort(vocabulary)
        terms = list(rows)
        self.vocabulary = vocabulary[order]
        self.parts = [[p for p, _ in rows[terms[i]]] for i in order]
        self.impacts = [[x for _, x in rows[terms[i]]] for i in order]
        self.block_last = [p[BLOCK - 1:-1:BLOCK] + p[-1:] for p in self.parts]
        self.block_max = [[max(x[i:i + BLOCK]) for i in range(0, len(x), BLOCK)] for x in self.impacts]
        self.most = np.array([max(x) for x in self.impacts], float)
        self.range_max = np.zeros((len(self.parts), -(-len(parts) // RANGE)), np.float32)
        for t, (p, x) in enumerate(zip(self.parts, self.impacts)):
            np.maximum.at(self.range_max[t], np.array(p) // RANGE, np.array(x, np.float32))
        self.longest = max((len(t) for t in self.texts), default=0)

    # ------------------------------------------------------------ retrieval
    def above(self, terms: list[int], theta: float, low: int = 0, high: int = 1 << 62) -> list[tuple[int, float]]:
        """Every part of low..high-1 whose score for the distinct ``terms`` reaches ``theta``: block-max WAND."""
        found = []
        cur = [[self.parts[t][i], t, i] for t in terms          # part under the cursor, term, position
               if (i := bisect_left(self.parts[t], low)) < len(self.parts[t]) and self.parts[t][i] < high]
        while cur:
            cur.sort()
            bound, pivot = 0.0, -1
            for i, (_, t, _) in enumerate(cur):
                bound += self.most[t]
                if bound >= theta:
                    pivot = i
                    break
            if pivot < 0:
                break
            at = cur[pivot][0]
            while pivot + 1 < len(cur) and cur[pivot + 1][0] == at:
                pivot += 1
            bound, skip = 0.0, cur[pivot + 1][0] if pivot + 1 < len(cur) else 1 << 62
            for _, t, _ in cur[:pivot + 1]:
                b = bisect_left(self.block_last[t], at)
                if b < len(self.block_last[t]):
                    bound += self.block_max[t][b]
                    skip = min(skip, self.block_last[t][b] + 1)
            if bound < theta:
                to, moved = max(skip, at + 1), cur[:pivot + 1]       # no part before `to` can reach it
            elif cur[0][0] == at:
                score = sum(self.impacts[t][i] for _, t, i in cur[:pivot + 1])
                if score >= theta:
                    found.append((at, score))
                to, moved = at + 1, cur[:pivot + 1]
            else:
                to, moved = at, [c for c in cur[:pivot] if c[0] < at]
            for c in moved:
                parts = self.parts[c[1]]
                c[2] = bisect_left(parts, to, c[2])
                c[0] = parts[c[2]] if c[2] < len(parts) and parts[c[2]] < high else -1
            cur = [c for c in cur if c[0] >= 0]
        return found

    def candidates(self, text: bytes, bounds: np.ndarray, theta: float) -> list[tuple[int, int, int, float]]:
        """(text, side, item, score) for the passages of the texts that lie in one buffer between ``bounds``."""
        at, h = word_hashes(text)
        if not len(h) or not len(self.vocabulary):
            return []
        term = np.searchsorted(self.vocabulary, h)
        term[term == len(self.vocabulary)] = 0
        known = self.vocabulary[term] == h
        word = np.searchsorted(at, bounds)
        n = np.diff(word)
        many = np.where(n > 0, np.maximum(1, -(-(n - PART_WORDS) // STRIDE)), 0)     # the last passage reaches the end
        doc = np.repeat(np.arange(len(n)), many)
        first = word[doc] + STRIDE * (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many))
        last = np.minimum(first + PART_WORDS + STRIDE, word[doc + 1])
        total = np.concatenate(([0.0], np.cumsum(np.where(known, self.most[term], 0.0))))
        may = total[last] - total[first] >= theta
        doc, first, last = doc[may], first[may], last[may]
        # From here on only words that some part holds count, each once a passage.
        count = np.concatenate(([0], np.cumsum(known)))
        kterm = term[known]
        order = np.argsort(kterm, kind="stable")
        again = kterm[order[1:]] == kterm[order[:-1]]
        before = np.full(len(kterm), -1)
        before[order[1:][again]] = order[:-1][again]
        lo, size = count[first], count[last] - count[first]
        out = []
        step = max(1, _BOUNDS // (PART_WORDS + STRIDE))
        for i in range(0, len(doc), step):
            sizes = size[i:i + step]
            ends = np.cumsum(sizes)
            pos = np.repeat(lo[i:i + step] - (ends - sizes), sizes) + np.arange(ends[-1])
            own = np.repeat(np.arange(len(sizes)), sizes)
            new = before[pos] < np.repeat(lo[i:i + step], sizes)
            pos, own = pos[new], own[new]
            start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            bound = np.add.reduceat(self.range_max[kterm[pos]], start, axis=0)
            stop = np.r_[start[1:], len(pos)]
            for k, r in np.argwhere(bound >= theta - 1e-4):
                p = i + own[start[k]]
                for part, score in self.above(kterm[pos[start[k]:stop[k]]].tolist(), theta, r * RANGE, (r + 1) * RANGE):
                    out.append((int(doc[p]), int(self.side_of[part]), int(self.item_of[part]), score))
        return out

    # ------------------------------------------------------------ verification
    def verified(self, have: Held, item: int) -> tuple[float, float]:
        """Shares of the item's question and answer shingles that a text holds;
        an item that is not split has one share, given twice."""
        share = []
        for part in split_item(self.words[item], self.texts[item]):
            n = min(SHINGLE, max(1, len(part)))
            want = shingles(part, n)
            share.append(len(want & have.shingles(n)) / len(want) if want else 1.0)
        return share[0], share[-1]


class Held:
    """Shingles of a whole text, by length, made when asked for."""

    def __init__(self, text: bytes):
        self.text, self.by = text, {}

    def shingles(self, n: int) -> set[bytes]:
        if n not in self.by:
            self.by[n] = shingles(_WORDS.findall(self.text), n)
        return self.by[n]


def segments(text: bytes, overlap: int) -> Iterator[bytes]:
    """``text`` in runs of bounded length; neighbours share ``overlap`` bytes or more and break between words."""
    at = 0
    while len(text) - at > _SEGMENT + 2 * overlap:
        end = at + _SEGMENT
        while end < len(text) and _WORD[text[end]]:
            end += 1
        yield text[at:end]
        at = max(at + 1, end - overlap)
        while at > 0 and _WORD[text[at - 1]]:
            at -= 1
    yield text[at:]


def buffers(texts: list[bytes], overlap: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """Segments of the texts, with their rows, gathered to about ``_SEGMENT`` bytes."""
    rows, parts, have = [], [], 0
    for row, text in enumerate(texts):
        for seg in segments(text, overlap):
            rows.append(row)
            parts.append(seg)
            have += len(seg)
            if have >= _SEGMENT:
                yield rows, parts
                rows, parts, have = [], [], 0
    if rows:
        yield rows, parts


def scan(index: Index, texts: list[bytes], theta: float, overlap: float) -> Iterator[tuple[int, object, float, float, float]]:
    """(row, item id, score, question share, answer share) of verified pairs, in row order."""
    found: dict[tuple[int, int], tuple[set[int], float]] = {}
    for rows, parts in buffers(texts, 8 * index.longest + 4096):
        bounds = np.cumsum([0, *(len(p) + 1 for p in parts)])
        for part, side, item, score in index.candidates(b"\n".join(parts) + b"\n", bounds, theta):
            sides, best = found.get((rows[part], item), (set(), 0.0))
            found[rows[part], item] = (sides | {side}, max(best, score))
    last, have = -1, None
    for (row, item), (sides, score) in sorted(found.items()):
        if len(sides) < index.sides[item]:
            continue                               # the question without the answer, or the other way round
        if row != last:
            last, have = row, Held(texts[row])
        q, a = index.verified(have, item)
        if min(q, a) >= overlap:
            yield row, index.items[item], score, q, a


def part_counts(dealt: DataFrame) -> DataFrame:
    """``(shard, word, df, words)`` of ``dealt(shard, text)``: parts that hold a word, and
    its occurrences; the null word has all parts and all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[int, bytes | None], list[int]] = defaultdict(lambda: [0, 0])
            for shard, low in zip(batch.column("shard").to_pylist(), normalized(batch.column("text"))):
                for _, part in item_parts(_WORDS.findall(low), low):
                    for word, count in [*part.items(), (None, part.total())]:
                        at = found[shard, word]
                        at[0] += 1
                        at[1] += count
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.int64()), pa.array([k[1] for k in found], pa.binary()),
                 pa.array([v[0] for v in found.values()], pa.int64()), pa.array([v[1] for v in found.values()], pa.int64())],
                names=["shard", "word", "df", "words"])

    counts = dealt.select("shard", "text").mapInArrow(run, "shard long, word binary, df long, words long")
    return counts.groupBy("shard", "word").agg(F.sum("df").alias("df"), F.sum("words").alias("words"))


def item_shards(items: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[Index]:
    """One bounded index after the other, all with the benchmark's own figures, so a
    score does not depend on the shards; null texts and texts without words are no items."""
    order = lambda r: (r["item"] is None, r["item"] or 0)
    count = items.count()
    shards = -(-count // SHARD_ITEMS)
    shard = F.pmod(F.xxhash64("item", "text"), F.lit(max(1, 2 * shards)))
    dealt = items.select(F.col(key).alias("item"), F.col(text).alias("text")).withColumn("shard", shard)
    if shards <= 1:
        if shards:
            yield Index([(r["item"], r["text"]) for r in sorted(dealt.collect(), key=order)])
        return
    by = reliable(part_counts(dealt))
    n, words = by.where("word is null").agg(F.sum("df"), F.sum("words")).first()
    total = by.where("word is not null").groupBy("word").agg(F.sum("df").alias("df"))
    known = reliable(by.where("word is not null").select("shard", "word").join(total, "word"))
    for s in range(2 * shards):
        part: list[Row] = dealt.where(F.col("shard") == s).collect()          # about SHARD_ITEMS / 2 rows
        df = {bytes(r["word"]): r["df"] for r in known.where(F.col("shard") == s).collect()}     # their words
        yield Index([(r["item"], r["text"]) for r in sorted(part, key=order)], df, n or 0, (words or 0) / max(1, n or 0))


def contaminated(docs: DataFrame, items: DataFrame, theta: float = THRESHOLD, overlap: float = OVERLAP,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, item_id, score, question_overlap, answer_overlap)`` per verified pair.

    Null and empty texts match nothing; repeated documents or items give
    repeated pairs; null ids are carried as they are; empty tables give an
    empty result. An item with fewer words than a shingle must occur as a
    whole. An item without a marked answer is verified as a whole, and both
    overlaps are the whole item's. Other columns are not read.
    """
    schema = (f"`{key}` {docs.schema[key].dataType.simpleString()}, item_id {items.schema['item_id'].dataType.simpleString()}, "
              "score double, question_overlap double, answer_overlap double")
    out = docs.sparkSession.createDataFrame([], schema)
    for index in item_shards(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for b in slices(batch, text):
                    found = list(scan(shared.value, normalized(b.column(text)), theta, overlap))
                    if found:
                        rows, *cols = zip(*found)
                        yield pa.RecordBatch.from_arrays(
                            [b.column(key).take(pa.array(rows)), *map(pa.array, cols)],
                            names=[key, "item_id", "score", "question_overlap", "answer_overlap"])

        out = out.unionByName(docs.select(key, text).mapInArrow(run, schema))
    return out


def clean_documents(docs: DataFrame, items: DataFrame, theta: float = THRESHOLD, overlap: float = OVERLAP,
                    text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a verified pair, all columns as they are.

    Null and empty texts hold no item and stay; repeated rows stay or go
    together; without items all rows stay; an empty table gives an empty
    result. Columns of any name are passed on unread.
    """
    rows, (body,) = plainly_named(docs, text)
    for index in item_shards(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for b in slices(batch, body):
                    hit = {r for r, *_ in scan(shared.value, normalized(b.column(body)), theta, overlap)}
                    yield b.filter(pa.array([i not in hit for i in range(b.num_rows)], pa.bool_()))

        rows = rows.mapInArrow(run, rows.schema)
    return rows.toDF(*docs.columns)
