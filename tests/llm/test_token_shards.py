import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from supplyscope.llm import token_shards as T
from supplyscope.session import scratch_path

from .helpers import AWKWARD, docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


TOK = Tokenizer.from_file(PATH)


def plain(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(4))
def test_cut_texts_have_the_ids_of_whole_texts(seed):
    r = random.Random(seed)
    alphabet = ["a", "b", "The", "é", "漢", " ", " ", " ", "  ", "\n", "\t", ".", ",", "!!", "'s", "'", "don't", "12", "3",
                "́", " ", " ", "\x1c", "<|endoftext|>", "%%%", "-", ")", "\U0001f600"]
    texts = ["".join(r.choices(alphabet, k=r.randint(0, 30))) for _ in range(300)] + [None, "", " ", "  "]
    enc = T.WordEncoder(PATH)
    for _ in range(2):                                      # the second time all words are known
        ids, count = T.encode_column(enc, pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == [plain(t) for t in texts]


def test_minimal_perfect_hash():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000, 20000):
        h1, h2 = (rng.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(2))
        f = T.mph_build(h1, h2)
        assert sorted(T.mph_slot(f, h1, h2).tolist()) == list(range(n))
    with pytest.raises(ValueError):
        T.mph_build(np.array([5, 5], np.uint64), np.array([6, 6], np.uint64))


def check(spark, rows):
    root = scratch_path(spark, "test-shards")
    entries = T.write_shards(docs(spark, rows), root, PATH, 2)
    index, parts = T.build_index(entries, root, part_keys=4)
    got = T.read_back(entries.select("key", "copy"), entries, index, parts, root).orderBy("start").collect()
    keys = [r.key for r in got]
    assert keys == sorted((i for i, *_ in rows), key=lambda k: (k is not None, k or 0))
    start, want = 0, {}
    for i, t, _ in rows:
        want.setdefault(i, []).append(plain(t) + [2])
    for r in got:
        ids = next(x for x in want[r.key] if zlib.crc32(np.array(x, "<u4").tobytes()) == r.ids_crc32)
        want[r.key].remove(ids)
        assert (r.start, r.n_tokens) == (start, len(ids))
        start += len(ids)
    return entries, index, parts, root


def test_round_trip_and_absent_keys(spark):
    entries, index, parts, root = check(spark, AWKWARD + [(100 - i, f"text {i}", "s") for i in range(40)])
    ask = spark.createDataFrame([(1, 0), (1, 1), (12345, 0), (None, 0)], "key long, copy long")
    found = {(r.key, r.copy): r.n for r in T.find(ask, index, parts, root).collect()}
    assert found[1, 0] is not None and found[None, 0] is not None
    assert found[1, 1] is None and found[12345, 0] is None


def test_empty_table(spark):
    root = scratch_path(spark, "test-shards")
    entries = T.write_shards(docs(spark, []), root, PATH, 2)
    index, parts = T.build_index(entries, root)
    assert T.read_back(entries.select("key", "copy"), entries, index, parts, root).count() == 0
