"""Token counts of whole texts by batch encoding in Arrow functions that return lengths only.

A batch is a run of texts of about ``BATCH_BYTES`` bytes, whatever number of
rows that is. A longer text is cut into segments of about that size at safe
boundaries: ASCII white space, else between a punctuation mark and an ASCII
letter or digit. Where the tokenizer is additive over white space (it drops
it and lets no token span it, which a probe decides), a batch is cut further
into words, each distinct word of the batch is encoded once, and its length is
added up over the occurrences. A tokenizer that is not additive gets whole
texts, uncut. Ids never leave the library's own batch; only lengths do.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.llm.common import slices

BATCH_BYTES = 16 << 20     # bytes of text that are cut and counted at once
ENCODE_WORDS = 20_000      # distinct words handed to the library at once
LIMIT = 2048               # tokens beyond which a text is over the limit

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_MARK = re.compile(rb"[.,;:!?](?=[0-9A-Za-z])")
_PROBE = ["a b", "it's\t1 x2", "  two  \n lines ", "été é ́x", "word, word. 漢字 \U0001f600 'll we 'd",
          "ABC\r\nabc", "x   y", "1 2 34", "... !? ..."]


# ---------------------------------------------------------------- tokenizers
class Counter:
    """Lengths of encoded texts by one of the two libraries, told by the file's ending."""

    def __init__(self, path: str):
        self.lengths = self._tokenizers(path) if path.endswith(".json") else self._pieces(path)
        self.additive = self._additive()

    @staticmethod
    def _tokenizers(path: str) -> Callable[[list[str]], list[int]]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # a Spark task has one core
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        return lambda texts: [len(e) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _pieces(path: str) -> Callable[[list[str]], list[int]]:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        return lambda texts: [len(e) for e in model.encode(texts, num_threads=1)]

    def _additive(self) -> bool:
        """True if on all probes a text's length is the sum of its words' lengths."""
        words = [[w.decode() for w in _SPACE.split(t.encode()) if w] for t in _PROBE]
        return self.lengths(_PROBE) == [sum(self.lengths(w)) for w in words]


@lru_cache(maxsize=2)
def load_counter(path: str) -> Counter:
    return Counter(path)


# ---------------------------------------------------------------- batches
def cut(text: bytes, size: int) -> Iterator[bytes]:
    """Segments of about ``size`` bytes that end at a safe boundary; a stretch
    without one stays whole."""
    at = 0
    while len(text) - at > size:
        stop = _SPACE.search(text, at + size) or _MARK.search(text, at + size)
        if stop is None:
            break
        yield text[at:stop.end()]
        at = stop.end()
    yield text[at:]


def word_lengths(counter: Counter, segments: list[bytes]) -> np.ndarray:
    """Tokens of each segment, every distinct word encoded once."""
    parts = pc.ascii_split_whitespace(pa.array(segments, pa.large_binary()).cast(pa.large_string()))
    off = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    size = np.array([n for i in range(0, len(names), ENCODE_WORDS) for n in counter.lengths(names[i:i + ENCODE_WORDS])],
                    np.int64)
    code = coded.indices.to_numpy(zero_copy_only=False)
    upto = np.concatenate(([0], np.cumsum(size[code] if len(code) else np.zeros(0, np.int64))))
    return upto[off[1:] - off[0]] - upto[off[:-1] - off[0]]


def lengths(counter: Counter, texts: list[bytes], batch_bytes: int = BATCH_BYTES) -> np.ndarray:
    """Tokens of each text, batch by batch."""
    if not counter.additive:
        return np.array(counter.lengths([t.decode() for t in texts]), np.int64)
    total, held, of, have = np.zeros(len(texts), np.int64), [], [], 0

    def flush() -> None:
        np.add.at(total, np.array(of, np.int64), word_lengths(counter, held))

    for i, t in enumerate(texts):
        for s in cut(t, batch_bytes):
            if held and have + len(s) > batch_bytes:
                flush()
                held, of, have = [], [], 0
            held.append(s)
            of.append(i)
            have += len(s)
    if held:
        flush()
    return total


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, key: str = "doc_id", text: str = "text",
                 batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``(key, n_bytes, n_tokens, over_limit)`` for every row, in one map over the texts.

    No begin, end or other special token is added; their strings inside a text
    count as the library counts them by default. A null or empty text, or one
    of white space that the tokenizer drops, has 0 tokens. Null and repeated
    keys and repeated rows are rows of their own. An empty table gives an empty
    result. Other columns are not read, whatever their names.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load_counter(tokenizer)
        for batch in batches:
            for b in slices(batch, "text", batch_bytes):
                texts = b.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [b.column("key"), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array(lengths(counter, texts, batch_bytes))], names=["key", "n_bytes", "n_tokens"])

    out = rows.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
