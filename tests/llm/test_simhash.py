import random
import re

import pytest
import xxhash

from supplyscope.llm import common, simhash

from .helpers import AWKWARD, docs


def by_definition(text, k=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, bits=3):
    fp = [by_definition(t) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    low = {}
    for i, (k, *_) in enumerate(rows):
        r = find(i)
        low[r] = k if low.get(r) is None else low[r] if k is None else min(low[r], k)
    return sorted(((k, fp[i], low[find(i)]) for i, (k, *_) in enumerate(rows)), key=str)


def near(n, seed=0):
    r = random.Random(seed)
    base = [f"w{r.randint(0, 999)}" for _ in range(300)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = f"v{r.randint(0, 99)}"
        out.append((100 + i, " ".join(w), "s"))
    return out


@pytest.mark.parametrize("block_rows", [2048, 3])
def test_against_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(simhash.links, "__defaults__", (3, block_rows))
    rows = AWKWARD + near(60) + [(900 + i, "the same text again and again", "s") for i in range(40)]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == brute(rows)


def test_close_fingerprints_share_a_key(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(200)]
    flip = [b ^ sum(1 << i for i in r.sample(range(64), 3)) for b in base]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(a), signed(b)) for a, b in zip(base, flip)], "a long, b long")
    for x in df.select(simhash.block_keys("a", 3).alias("x"), simhash.block_keys("b", 3).alias("y")).collect():
        assert set(x.x) & set(x.y)


def test_representatives(spark):
    rows = AWKWARD + near(30)
    df = docs(spark, rows)
    out = simhash.representatives(df)
    assert out.dtypes == df.dtypes
    low = {c for _, _, c in brute(rows)}
    kept = [r.doc_id for r in out.collect()]
    assert sorted(kept, key=str) == sorted(low, key=str)


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.representatives(docs(spark, [])).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    order = list(range(40))
    random.Random(3).shuffle(order)
    edges = list(zip(order, order[1:])) + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (1001, 1000)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 40)} | {1000 + i: 1000 for i in range(1, 50)}
