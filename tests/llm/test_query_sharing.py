import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from supplyscope.llm import query_sharing as qs
from tests.llm.helpers import AWKWARD, docs

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def naive(rows, items, best=10):
    """By the formula, item by item and document by document."""
    bags = [(k, Counter(terms(t))) for k, t in rows]
    n_docs, words = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for key, bag in bags:
            n = sum(bag.values())
            score = 0
            for t in terms(text):
                if bag[t]:
                    m = 25 + 75 * n * n_docs // words
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (
                        1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        out += [(item, i + 1, f[3], -f[0]) for i, f in enumerate(sorted(found, key=lambda f: f[:3])[:best])]
    return sorted(out, key=str)


def corpus(n=150, seed=5):
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "Beta", "gamma", "delta", "é", "x1", "ZETA", "eta"] + [f"w{i}" for i in range(60)])
    return [(i, " ".join(word() for _ in range(rng.randint(1, 40)))) for i in range(n)]


ITEM = "item_id long, text string, shard int, uid string, doc_id int, score long"


def items_table(spark, items):
    return spark.createDataFrame([(i, t, 3, "u", 4, 5) for i, t in items], ITEM)


ITEMS = [(1, "alpha beta gamma w1 w2"), (2, "alpha beta gamma w3"), (3, "ALPHA, beta; gamma! alpha"), (4, "w59"),
         (5, "nothing-here"), (6, ""), (7, None), (8, "w1 w1 w1 w2 w2"), (9, "é x1 é"), (10, "alpha beta gamma w1 w2 w3 w4 w5")]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 20])
def test_against_the_formula(spark, shard_bytes):
    rows = corpus() + [(i, t) for i, t, _ in AWKWARD]
    got = qs.search(docs(spark, [(i, t, "s") for i, t in rows]), items_table(spark, ITEMS), shard_bytes=shard_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == naive(rows, ITEMS)


def test_ties_copies_and_null_keys(spark):
    rows = [(i % 7 or None, "alpha beta") for i in range(40)] + [(50, "other words")] * 30
    got = qs.search(docs(spark, [(i, t, "s") for i, t in rows]), items_table(spark, [(1, "alpha"), (1, "alpha"), (None, "beta")]))
    assert sorted(map(tuple, got.collect()), key=str) == naive(rows, [(1, "alpha"), (None, "beta")])


def test_small_blocks_and_batches_rank_alike(spark, monkeypatch):
    rows = corpus(80)
    bitmap = np.full(1 << (qs._BITS - 6), -1, np.int64)
    assert qs.blocks(docs(spark, [(i, t, "s") for i, t in rows]), bitmap, "doc_id", "text").where("term is not null").count()
    out = qs.search(docs(spark, [(i, t, "s") for i, t in rows]).repartition(17), items_table(spark, ITEMS), best=3)
    assert sorted(map(tuple, out.collect()), key=str) == naive(rows, ITEMS, 3)


def test_shared_sets_are_added_up_once():
    lists = [[0, 1, 2, 3], [0, 1, 2, 4], [0, 1, 2, 5], [0, 1, 6], [7]]
    nodes, left = qs.share(lists, 8)
    size = [1] * 8
    for a, b in nodes:
        size.append(size[a] + size[b])
    assert [sum(size[p] for p in s) for s in left] == [len(s) for s in lists]
    assert max(size) >= 3                                           # 0, 1, 2 is one node
    adds = len(nodes) + sum(len(s) - 1 for s in left)
    assert adds < sum(len(s) - 1 for s in lists)


def test_graph_scores_are_the_plain_sums():
    rng = random.Random(1)
    lists = [sorted(rng.choices(range(12), k=rng.randint(1, 9))) for _ in range(20)]
    nodes, left = qs.share([list(s) for s in lists], 12)
    size = np.array([len(s) for s in left])
    raw = lambda a: np.asarray(a, np.int64).tobytes()
    g = qs.Graph.of({"leaves": 12, "lefts": raw([n[0] for n in nodes]), "rights": raw([n[1] for n in nodes]),
                     "uid": raw(range(20)), "starts": raw(np.cumsum(size) - size), "parts": raw([p for s in left for p in s])})
    value = np.arange(1, 25).reshape(12, 2) ** 2
    leaf, doc = np.divmod(np.arange(24), 2)
    assert (g.scores(leaf, doc, value.ravel(), 2) == [value[s].sum(0) for s in lists]).all()


def test_norm_beyond_64_bits():
    n = np.array([10 ** 9, 5])
    assert qs.lengths_norm(n, 10 ** 12, 10 ** 14).tolist() == [25 + 75 * 10 ** 9 * 10 ** 12 // 10 ** 14, 25 + 75 * 5 * 10 ** 12 // 10 ** 14]


def test_empty_tables(spark):
    some, none = docs(spark, [(1, "alpha", "s")]), docs(spark, [])
    assert qs.search(none, items_table(spark, ITEMS)).collect() == []
    assert qs.search(some, items_table(spark, [])).collect() == []
    assert qs.search(docs(spark, [(1, None, "s"), (2, " ,", "s")]), items_table(spark, ITEMS)).collect() == []
