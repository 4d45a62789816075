import numpy as np
import pytest

from supplyscope.llm import multi_index as M

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, links int, cell string"


def brute(rows, cosine):
    n = len(rows)
    ok = [v is not None and l is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
          for _, v, l in rows]
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i + 1, n):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], np.float32).astype(float) for k in (i, j))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    root[find(j)] = find(i)
    low = {}
    for i in range(n):
        k = rows[i][0]
        low[find(i)] = k if low.get(find(i)) is None else min(low[find(i)], low[find(i)] if k is None else k)
    return sorted(((rows[i][0], links[i], low[find(i)], rows[i][0] == low[find(i)]) for i in range(n)), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, l, "x", 1, "y") for i, v, l in rows], SCHEMA)
    out = M.near_duplicates(df, **kw)
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out.collect()), key=str)


def vectors(n, groups, seed=0, dim=16):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim).tolist(), int(rng.integers(3))) for i in range(n)]
    for g in range(groups):
        base, label = rng.normal(size=dim), int(rng.integers(3))
        for _ in range(12):
            v = base + rng.normal(size=dim) * 0.12 * np.linalg.norm(base) / np.sqrt(dim)
            rows.append((len(rows), v.tolist(), label))
    return rows


@pytest.mark.parametrize("block_rows", [2048, 5])
def test_against_brute_force(spark, block_rows):
    rows = vectors(120, 8) + [(1000 + i, [1.0] * 16, 2) for i in range(30)]       # a group of copies
    assert run(spark, rows, block_rows=block_rows, recall=0.9999) == brute(rows, 0.93)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], None), (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
            (7, [None, 1.0], 1), (8, [], 1), (9, [2.0, 0.0], 1), (9, [2.0, 0.0], 1), (None, [3.0, 0.1], 1), (10, [1.0, 0.0, 0.0], 1),
            (11, [1e30, 1e-30], 1), (12, [5.0], 2), (13, [7.0], 2), (14, [-7.0], 2)]
    assert run(spark, rows) == brute(rows, 0.93)
    assert run(spark, []) == []


def test_a_link_that_one_side_finds_counts_for_both(spark):
    """Pairs near 0.93, few cells visited: both of a pair have the link and the component, or neither."""
    rng = np.random.default_rng(4)
    x = M.unit(list(rng.normal(size=(300, 16))), 16)
    d = rng.normal(size=x.shape)
    d -= (d * x).sum(1, keepdims=True) * x
    y = 0.94 * x + np.sqrt(1 - 0.94 ** 2) * d / np.linalg.norm(d, axis=1, keepdims=True)
    rows = [(2 * i + k, v.tolist(), i) for i, pair in enumerate(zip(x, y)) for k, v in enumerate(pair)]
    got = {i: (links, component) for i, links, component, _ in run(spark, rows, recall=0.7)}
    both = [(got[2 * i], got[2 * i + 1]) for i in range(300)]
    assert all(p == ((1, 2 * i), (1, 2 * i)) or p == ((0, 2 * i), (0, 2 * i + 1)) for i, p in enumerate(both))
    assert 0 < sum(p[0][0] for p in both)


def test_multi_sequence_visits_in_order():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.random(6), rng.random(5)
        got = M.multi_sequence(a, b, 0.8)
        want = sorted((a[i] + b[j], i * 5 + j) for i in range(6) for j in range(5) if a[i] + b[j] <= 0.8)
        assert got == [c for _, c in want]


def test_recall_of_neighbours_at_the_cosine():
    """Share of neighbours exactly at the cosine, in random directions, whose cell is visited."""
    rng = np.random.default_rng(2)
    x = M.unit(list(rng.normal(size=(3000, 64))), 64)
    books = [M.codebook(x[:2000, h], M.CODES, i) for i, h in enumerate((slice(0, 32), slice(32, 64)))]
    d = rng.normal(size=x.shape)
    d -= (d * x).sum(1, keepdims=True) * x
    y = 0.93 * x + np.sqrt(1 - 0.93 ** 2) * d / np.linalg.norm(d, axis=1, keepdims=True)
    (_, a), (_, b) = M.border(x[:, :32], books[0]), M.border(x[:, 32:], books[1])
    i, j = M.squared(y[:, :32], books[0]).argmin(1), M.squared(y[:, 32:], books[1]).argmin(1)
    k = np.arange(len(x))
    assert (a[k, i] + b[k, j] <= M.reach_of(0.93, M.RECALL, 64)).mean() >= 0.97
