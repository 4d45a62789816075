import math

import numpy as np
import pytest

from supplyscope.llm import whitening as wh

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, n int, x string, i int, fact string, white double"


def table(spark, rows):
    """Rows of (vec_id, embedding); the clashing columns are filled with noise."""
    return spark.createDataFrame([(i, v, 1, "x", 2, None, 0.5) for i, v in rows], SCHEMA)


def vectors(n=120, d=6, copies=40, seed=3):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, d)) * np.array([5, 3, 2, 1, 0.5, 0.2][:d]) + rng.normal(size=d)
    m[:copies] = m[0]                                          # a third of the rows is one vector
    return m


def naive(x, weights=None):
    """By definition, without grouping."""
    x = np.array(x, dtype=object)
    n, s = len(x), x.sum(0)
    dev = [sum(int(n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    c = np.array([[float(n * a - b) / n for a, b in zip(r, s)] for r in x])
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    return n, dev, c, v, e[::-1], u[:, ::-1]


@pytest.mark.parametrize("d", [3, 6])
def test_against_the_definition(spark, d):
    m = vectors(d=d)
    rows = [(i, r.tolist()) for i, r in enumerate(m)]
    out = wh.whitened(table(spark, rows + [(None, None), (900, [1.0] * (d - 1) + [None]), (901, [NAN] * d), (902, [INF] * d)]))
    got = out.collect()
    x = [[math.floor(1024 * c) + 100_000 for c in r] for r in m.tolist()]
    n, dev, c, v, e, u = naive(x)
    k = min(8, d)
    assert len(got) == n * k and {r["n"] for r in got} == {n}
    white = np.zeros((n, k))
    for r in got:
        assert r["deviation"] == dev[r["vec_id"]]
        assert abs(r["explained"] / (e[r["component"] - 1] / np.trace(v)) - 1) < 1e-10
        white[r["vec_id"], r["component"] - 1] = r["whitened"]
    want = c @ u[:, :k] / np.sqrt(e[:k])
    sign = np.sign((white * want).sum(0))
    assert np.abs(white - want * sign).max() < 1e-9
    cov = white.T @ white / n
    assert np.abs(cov - np.eye(k)).max() < 1e-9
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_one_as_weight_counts_a_vector_once(spark):
    m = np.unique(vectors(), axis=0)
    once = wh.whitened(table(spark, [(i, r.tolist()) for i, r in enumerate(m)]), weight="one").collect()
    many = wh.whitened(table(spark, [(i, r.tolist()) for i, r in enumerate(m)] + [(500 + i, m[0].tolist()) for i in range(50)]),
                       weight="one").collect()
    key = lambda r: (r["vec_id"], r["component"])
    kept = sorted((r for r in many if r["vec_id"] < 500), key=key)
    assert np.allclose([r["whitened"] for r in sorted(once, key=key)], [r["whitened"] for r in kept])
    assert {r["n"] for r in many} == {len(m)}


def test_copies_are_one_row_before_the_products(spark):
    m = vectors()
    rows = table(spark, [(i, r.tolist()) for i, r in enumerate(m)]).select("vec_id", wh.whole("embedding").alias("x"))
    got = wh.distinct_vectors(rows, "x").collect()
    assert len(got) == len(m) - 39 and max(r["n"] for r in got) == 40 and sum(r["n"] for r in got) == len(m)


def test_null_and_repeated_keys_and_rows(spark):
    m = vectors(30, 4, 3)
    got = wh.whitened(table(spark, [(None if i % 3 else 7, r.tolist()) for i, r in enumerate(m)])).collect()
    assert len(got) == 30 * 4 and {r["n"] for r in got} == {30}


def test_lengths_are_fitted_apart(spark):
    a, b = vectors(20, 3, 1), vectors(25, 5, 1, seed=9)
    rows = [(i, r.tolist()) for i, r in enumerate(a)] + [(100 + i, r.tolist()) for i, r in enumerate(b)] + [(999, [])]
    got = wh.whitened(table(spark, rows)).collect()
    alone = wh.whitened(table(spark, rows[:20])).collect()
    assert len(got) == 20 * 3 + 25 * 5
    assert sorted((r["vec_id"], r["component"], round(r["whitened"], 9)) for r in got if r["vec_id"] < 100) == sorted(
        (r["vec_id"], r["component"], round(r["whitened"], 9)) for r in alone)
    assert {r["n"] for r in got} == {20, 25}


def test_degenerate_tables(spark):
    assert wh.whitened(table(spark, [])).collect() == []
    assert wh.whitened(table(spark, [(1, None), (2, [NAN])])).collect() == []
    assert wh.whitened(table(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect() == []      # no variance
    flat = wh.whitened(table(spark, [(i, [float(i), 2.0]) for i in range(5)])).collect()       # one direction only
    assert {r["component"] for r in flat} == {1} and all(abs(r["explained"] - 1) < 1e-12 for r in flat)
    big = wh.whitened(table(spark, [(i, [1e300 * (-1) ** i, float(i)]) for i in range(4)])).collect()
    assert all(r["deviation"] is None for r in big) and len(big) >= 4


def test_query_on_the_whole_table(spark):
    from supplyscope.llm.queries import op12_whitening

    sf = "/root/testdata/sf0.001"
    p = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = [[math.floor(1024 * float(c)) + 100_000 for c in r["embedding"]] for r in p]
    n, dev, *_ = naive(x)
    got = op12_whitening(spark, sf).collect()
    assert {(r["vec_id"], r["deviation"]) for r in got} == set(zip([r["vec_id"] for r in p], dev))
    assert max(r["component"] for r in got) == 8 and got[0]["identity_error"] < 1e-9
