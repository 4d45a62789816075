"""Token ids as raw binary shards with a minimal perfect hash index.

A shard is one file of little-endian unsigned ids (16 bits wide if the
vocabulary fits, else 32), documents in ascending key order, each closed by
an end id. The index maps a key to (shard, offset, length): keys are dealt to
index parts by hash; a part is a minimal perfect hash (levels of bit arrays,
a key sits at the first level where it is alone) and, by slot, a stored
fingerprint, the shard, the offset and the length. A lookup costs a constant
number of probes; the fingerprint rejects keys that are not there.

Files get a name of their own from each task attempt, and only files named
by the committed entries count, so lost executors and repeated attempts
leave no half-written shard in use. Files are written by pyarrow's file
systems, whatever store the root's address names.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from supplyscope.llm.common import group_starts, reliable, slices, whole_groups

PART_KEYS = 1_000_000      # keys of an index part
GAMMA = 2.0                # bits a remaining key gets on a level
_SLICE = 16 << 20          # bytes of text a task encodes at once
_WORDS = 4096              # distinct words encoded as one text
KNOWN_WORDS = 900_000      # distinct words a process remembers
_WORD_AND_MARKS = r'(?s)^(?P<core>.*\pL)(?P<tail>[.,;:!?%$#&*|)"-]+)$'
_READ = 1 << 22            # ids read at once


# ---------------------------------------------------------------- encoding
def _gather(flat: np.ndarray, size: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` (run ``c`` has ``size[c]`` ids) in the order of ``code``, and their sizes."""
    at, have = np.cumsum(size) - size, size[code]
    return flat[np.repeat(at[code] - (np.cumsum(have) - have), have) + np.arange(have.sum())], have


class WordEncoder:
    """A byte-level tokenizer that encodes each distinct word once.

    Words are those after a blank. Marks at the end of a word are encoded
    apart: a pre-token of letters always ends where marks begin (the apostrophe
    is no such mark). Many words are encoded as one text, since a token that
    begins with a blank begins a word. The known words stay with the process
    for its next slices and are forgotten beyond ``KNOWN_WORDS``; that changes
    the work, not the ids.
    """

    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        self.lead = np.zeros(self.tok.get_vocab_size(), bool)
        self.lead[[i for t, i in self.tok.get_vocab().items() if t.startswith("\u0120")]] = True  # a blank, byte-level
        self.forget()

    def forget(self) -> None:
        self.cores, self.flat, self.size = {}, np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        flat, size = [self.flat], [self.size]
        for i in range(0, len(words), _WORDS):
            run = words[i:i + _WORDS]
            ids = np.array(self.plain([" " + " ".join(run)])[0], np.uint32)
            at = np.flatnonzero(self.lead[ids])
            if len(at) != len(run) or at[0]:
                raise ValueError("not a byte-level tokenizer: blanks do not begin tokens")
            flat.append(ids)
            size.append(np.diff(np.r_[at, len(ids)]))
        self.flat, self.size = np.concatenate(flat), np.concatenate(size)

    def words(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per name) of names that each follow a blank and do not begin with white space."""
        if len(self.cores) > KNOWN_WORDS:
            self.forget()
        cut = pc.extract_regex(names, _WORD_AND_MARKS)
        core = pc.if_else(cut.is_valid(), cut.field("core"), names).dictionary_encode()
        tail = pc.if_else(cut.is_valid(), cut.field("tail"), "").dictionary_encode()
        known, new = self.cores, len(self.cores)
        core_id = np.array([known.setdefault(w, len(known)) for w in core.dictionary.to_pylist()], np.int64)
        self._learn(list(islice(known, new, None)))
        ends = self.plain(tail.dictionary.to_pylist())
        pair = np.stack([core_id[core.indices.to_numpy()], tail.indices.to_numpy() + len(known)], axis=1)
        every, have = _gather(np.concatenate([self.flat, np.array([i for e in ends for i in e], np.uint32)]),
                              np.r_[self.size, [len(e) for e in ends]].astype(np.int64), pair.ravel())
        return every, have.reshape(-1, 2).sum(axis=1)


@lru_cache(maxsize=2)
def load_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _merged(text: str) -> list[str]:
    """``text`` cut before each single blank that a non-blank follows."""
    out: list[str] = []
    for i, p in enumerate(text.split(" ")):
        if i and (not p or p[0].isspace()):
            out[-1] += " " + p
        else:
            out.append(" " + p if i else p)
    return out


def encode_column(enc: WordEncoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, ids per text); null reads as the empty text.

    A byte-level tokenizer always starts a new pre-token at a blank that a
    non-blank follows, so texts are cut there, each distinct word is encoded
    once, and the ids are gathered. Nothing else is assumed of the words.
    """
    texts = texts.fill_null("")
    parts = pc.split_pattern(texts, " ")
    off = parts.offsets.to_numpy().astype(np.int64)
    off -= off[0]
    coded = parts.flatten().dictionary_encode()
    names, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n, first = len(texts), off[:-1]
    odd = pc.or_(pc.equal(names, ""), pc.utf8_is_space(pc.utf8_slice_codeunits(names, 0, 1))).to_numpy(zero_copy_only=False)
    heads = enc.plain(names.take(pa.array(code[first])).to_pylist())
    flat, some = enc.words(names.filter(pa.array(~odd)))
    size = np.zeros(len(names) + n, np.int64)
    size[:len(names)][~odd] = some
    size[len(names):] = [len(h) for h in heads]
    flat = np.concatenate([flat, np.array([i for h in heads for i in h], np.uint32)])
    code[first] = len(names) + np.arange(n)
    every, have = _gather(flat, size, code)
    count = np.add.reduceat(have, first) if n else np.zeros(0, np.int64)
    odd = np.r_[odd, np.zeros(n, bool)]
    wrong = np.unique(np.searchsorted(off, np.flatnonzero(odd[code]), side="right") - 1)
    if len(wrong):                                   # runs of blanks: cut elsewhere
        docs = np.split(every, np.cumsum(count)[:-1])
        for i in wrong:
            docs[i] = np.array([t for e in enc.plain(_merged(texts[int(i)].as_py())) for t in e], np.uint32)
            count[i] = len(docs[i])
        every = np.concatenate(docs)
    return every, count


def write_shards(docs: DataFrame, root: str, tokenizer: str, end_id: int, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Encode and write; returns the committed entries ``(shard, file, width, key, copy, at, n)``.

    Rows are range-partitioned by key, one file per partition. Null keys come
    first. Rows that repeat a key stand next to each other, ordered by a hash
    of the text, numbered by ``copy``. Null texts are empty. An empty table
    writes no shard. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .repartitionByRange(F.col("key").asc_nulls_first())
            .sortWithinPartitions(F.col("key").asc_nulls_first(), F.xxhash64("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = file = None
        shard, at, last, copy = TaskContext.get().partitionId(), 0, (), 0
        for batch in batches:
            for b in slices(batch, "text", _SLICE):
                enc = load_encoder(tokenizer)
                width = 2 if max(len(enc.lead), end_id + 1) <= 1 << 16 else 4
                if out is None:
                    fs, base = pafs.FileSystem.from_uri(root)
                    fs.create_dir(base, recursive=True)
                    file = f"shard-{shard:06d}-{uuid.uuid4().hex}.ids"
                    out = fs.open_output_stream(f"{base}/{file}")
                ids, count = encode_column(enc, b.column("text"))
                out.write(np.insert(ids, np.cumsum(count), end_id).astype(f"<u{width}").tobytes())
                count = count + 1
                copies = []
                for k in b.column("key").to_pylist():
                    copy = copy + 1 if (k,) == last else 0
                    last = (k,)
                    copies.append(copy)
                m = len(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * m, pa.int32()), pa.array([file] * m), pa.array([width] * m, pa.int32()),
                     b.column("key"), pa.array(copies, pa.int64()), pa.array(at + np.cumsum(count) - count),
                     pa.array(count)], names=["shard", "file", "width", "key", "copy", "at", "n"])
                at += int(count.sum())
        if out is not None:
            out.close()

    return reliable(rows.mapInArrow(run, f"shard int, file string, width int, key {kind}, copy long, at long, n long"))


# ---------------------------------------------------------------- minimal perfect hash
def _mix(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    x = h1 + h2 * np.uint64(2 * level + 1)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def mph_build(h1: np.ndarray, h2: np.ndarray) -> dict[str, np.ndarray]:
    """Bit arrays of all levels (as 64-bit words), their sizes, and the keys before each word."""
    words, sizes, left = [], [], np.arange(len(h1))
    while len(left):
        if len(sizes) > 200:
            raise ValueError("two keys share their whole 128-bit hash")
        m = max(64, int(GAMMA * len(left)) + 63 & ~63)
        place = (_mix(h1[left], h2[left], len(sizes)) % np.uint64(m)).astype(np.int64)
        alone = np.bincount(place, minlength=m) == 1
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        sizes.append(m)
        left = left[~alone[place]]
    bits = np.concatenate(words) if words else np.zeros(0, np.uint64)
    ones = np.bitwise_count(bits).astype(np.int64)
    return {"bits": bits, "sizes": np.array(sizes, np.int64), "before": np.cumsum(ones) - ones}


def mph_slot(f: dict[str, np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Slot of each key; -1 where no level holds it."""
    slot, left, base = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
    for level, m in enumerate(f["sizes"]):
        place = (_mix(h1[left], h2[left], level) % np.uint64(m)).astype(np.int64)
        word, bit = base + (place >> 6), (place & 63).astype(np.uint64)
        hit = (f["bits"][word] >> bit) & np.uint64(1) == 1
        below = f["bits"][word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
        slot[left[hit]] = f["before"][word[hit]] + np.bitwise_count(below)
        left, base = left[~hit], base + int(m) // 64
    return slot


def _hashed(rows: DataFrame, parts: int) -> DataFrame:
    """Adds two hashes of (key, copy) and the index part."""
    null = F.col("key").isNull()
    rows = rows.withColumn("h1", F.xxhash64(null, "key", "copy")).withColumn("h2", F.xxhash64(F.lit(1), null, "copy", "key"))
    return rows.withColumn("part", F.pmod(F.shiftright("h1", 20), F.lit(parts)).cast("int"))


def build_index(entries: DataFrame, root: str, part_keys: int = PART_KEYS) -> tuple[DataFrame, int]:
    """Writes one file per index part; returns the committed ``(part, index_file)`` and the number of parts."""
    parts = max(1, -(-entries.count() // part_keys))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in whole_groups(frames, ["part"], 1):
            for i, j in zip(s := group_starts(f, ["part"]), [*s[1:], len(f)]):
                g = f.iloc[i:j]
                h1, h2 = g["h1"].to_numpy().view(np.uint64), g["h2"].to_numpy().view(np.uint64)
                mph = mph_build(h1, h2)
                slot = mph_slot(mph, h1, h2)
                by = np.empty(len(g), np.int64)
                by[slot] = np.arange(len(g))
                data = io.BytesIO()
                np.savez(data, **mph, fingerprint=(h2 >> np.uint64(32)).astype(np.uint32)[by],
                         **{c: g[c].to_numpy()[by] for c in ("shard", "at", "n")})
                fs, base = pafs.FileSystem.from_uri(root)
                fs.create_dir(base, recursive=True)
                part = int(g["part"].iloc[0])
                name = f"index-{part:06d}-{uuid.uuid4().hex}.npz"
                with fs.open_output_stream(f"{base}/{name}") as out:
                    out.write(data.getvalue())
                yield pd.DataFrame({"part": [part], "index_file": [name]})

    rows = _hashed(entries, parts).select("part", "h1", "h2", "shard", "at", "n")
    rows = rows.repartition(parts, "part").sortWithinPartitions("part")
    return reliable(rows.mapInPandas(run, "part int, index_file string")), parts


def find(keys: DataFrame, index: DataFrame, parts: int, root: str) -> DataFrame:
    """``keys(key, copy)`` with ``shard, at, n`` from the index; null where a key is not there."""
    kind = keys.schema["key"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, part = None, {}
        for f in frames:
            s = group_starts(f, ["part"]) if len(f) else []
            for i, j in zip(s, [*s[1:], len(f)]):
                g = f.iloc[i:j]
                if name != g["index_file"].iloc[0]:
                    name = g["index_file"].iloc[0]
                    fs, base = pafs.FileSystem.from_uri(root)
                    with fs.open_input_file(f"{base}/{name}") as src:
                        part = dict(np.load(io.BytesIO(src.read())))
                h1, h2 = g["h1"].to_numpy().view(np.uint64), g["h2"].to_numpy().view(np.uint64)
                slot = mph_slot(part, h1, h2)
                here = slot >= 0
                here[here] = part["fingerprint"][slot[here]] == (h2[here] >> np.uint64(32)).astype(np.uint32)
                out = g[["key", "copy"]].copy()
                for c in ("shard", "at", "n"):
                    out[c] = pd.array(np.where(here, part[c][np.maximum(slot, 0)], 0), "Int64")
                    out.loc[~here, c] = pd.NA
                yield out

    rows = _hashed(keys.select("key", "copy"), parts).join(index, "part")
    rows = rows.repartition("part").sortWithinPartitions("part")
    return rows.mapInPandas(run, f"key {kind}, copy long, shard long, at long, n long")


def read_back(keys: DataFrame, entries: DataFrame, index: DataFrame, parts: int, root: str) -> DataFrame:
    """Read each key's ids from the shards, found through the index:
    ``(key, copy, start, n_tokens, ids_crc32)``; ``start`` counts the ids of all
    documents before it. Each shard is read forward by one task, in runs of
    bounded length."""
    kind = keys.schema["key"].dataType.simpleString()
    shards = entries.groupBy("shard", "file", "width").agg(F.sum("n").alias("ids"))       # one row per shard
    shards = shards.withColumn("base", F.sum("ids").over(Window.orderBy("shard")) - F.col("ids"))
    found = find(keys, index, parts, root).where("n is not null")
    rows = (found.join(shards.select(F.col("shard").cast("long").alias("shard"), "file", "width", "base"), "shard")
            .repartition("shard").sortWithinPartitions("shard", "at"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = src = None
        for f in frames:
            crc = []
            for file, width, at, n in zip(f["file"], f["width"], f["at"], f["n"]):
                if file != name:
                    if src is not None:
                        src.close()
                    fs, base = pafs.FileSystem.from_uri(root)
                    name, src = file, fs.open_input_file(f"{base}/{file}")
                src.seek(at * width)
                value = 0
                for done in range(0, n, _READ):
                    ids = np.frombuffer(src.read(min(_READ, n - done) * width), f"<u{width}")
                    value = zlib.crc32(ids.astype("<u4").tobytes(), value)
                crc.append(value)
            yield pd.DataFrame({"key": f["key"], "copy": f["copy"], "start": f["base"] + f["at"],
                                "n_tokens": f["n"], "ids_crc32": np.array(crc, np.int64)})
        if src is not None:
            src.close()

    return rows.mapInPandas(run, f"key {kind}, copy long, start long, n_tokens long, ids_crc32 long")
