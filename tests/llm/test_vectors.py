"""Nearest neighbours and inner products against brute force."""

import numpy as np
import pytest

from tickloom.llm import metric_tree, multi_index, vectors

ROWS = "vec_id long, embedding array<float>, label int, vector int, shard string"


def table(spark, vectors_by_id):
    return spark.createDataFrame([(i, v, 0, 0, "") for i, v in vectors_by_id], ROWS)


def random_rows(n, d=12, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)).astype(np.float32)
    x[50:90] = x[50]  # one common vector
    return [(k, [float(c) for c in row]) for k, row in enumerate(x)]


def brute_products(rows, k=10):
    x = np.floor(1024 * np.array([v for _, v in rows], dtype=np.float64)).astype(np.int64)
    ids = np.array([i for i, _ in rows])
    out = set()
    for n in np.flatnonzero(ids % 100 == 0):
        s = x @ x[n]
        order = [j for j in np.lexsort((ids, -s)) if j != n][:k]
        out |= {(int(ids[n]), r + 1, int(ids[j]), int(s[j])) for r, j in enumerate(order)}
    return out


def products(spark, rows):
    return {tuple(r) for r in metric_tree.search(table(spark, rows)).select("query_id", "rank", "vec_id", "score").collect()}


@pytest.mark.parametrize("shard_rows", [4096, 150])
def test_tree_search_is_exact(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(vectors, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 3)
    rows = random_rows(900)
    assert products(spark, rows) == brute_products(rows)


def test_tree_bounds_avoid_products():
    r = np.random.default_rng(1)
    centers = r.normal(size=(40, 8)) * 4000
    x = np.floor(np.repeat(centers, 100, axis=0) + r.normal(size=(4000, 8)) * 50)
    tree = metric_tree.Tree(metric_tree.build(0, np.arange(4000), x), 8)
    best = sorted(tree.search(-1, x[7], 10), key=lambda b: (-b[0], b[1]))
    s = (x @ x[7]).astype(int)
    assert best == [(int(s[j]), int(j)) for j in np.lexsort((np.arange(4000), -s))[:10]]
    assert tree.computed < 2000


def test_large_components_stay_exact(spark):
    rows = [(k, [60000.0 + k, -50000.0 + 3 * k, 0.25]) for k in range(0, 300, 10)]
    assert products(spark, rows) == brute_products(rows)


def test_largest_components_take_part(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD_ROWS", 40)
    r = np.random.default_rng(4)
    rows = [(k, [float(c) for c in r.normal(size=8).astype(np.float32)]) for k in range(150)]
    # All as queries and candidates: products of about 2 ** 58 and 2 ** 61, and one that is 0 with a component beyond a long.
    rows += [(200, [70000.0] * 8), (201, [70000.0] * 7 + [65536.0]), (300, [3e5, -3e5] * 3 + [3e5, 0.0]), (301, [3e5] * 8), (401, [0.0] * 7 + [-3e38]), (403, [1.0] * 7 + [0.0])]
    rows[100] = (100, [2.0] * 7 + [0.0])
    rows[0] = (0, [1.0] * 7 + [0.0])
    whole = {i: [int(np.floor(np.float64(np.float32(c)) * 1024)) for c in v] for i, v in rows}
    expected = set()
    for q in (i for i in whole if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        expected |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:10])}
    assert products(spark, rows) == expected


def test_only_scores_beyond_a_long_are_errors(spark):
    high = [(100, [3e38, 1.0]), (101, [3e38, 1.0]), (102, [1.0, 1.0])]
    with pytest.raises(Exception, match="does not fit a long"):
        products(spark, high)
    with pytest.raises(Exception, match="does not fit a long"):
        products(spark, [(100, [3e38, 1.0]), (101, [-3e38, 1.0])])
    beside = [(100, [3e10, 1.0]), (101, [-3e10, 1.0]), *[(k, [0.0, 1.0]) for k in range(1, 11)]]
    assert products(spark, beside) == {(100, k, k, 1024 * 1024) for k in range(1, 11)}


def test_neighbours_are_found(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD_ROWS", 400)
    rows = random_rows(1500, seed=3)
    x, ids = np.array([v for _, v in rows], dtype=np.float64), np.arange(1500)
    found = multi_index.search(table(spark, rows)).collect()
    hits = 0
    for q in range(0, 1500, 100):
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 11)) and q not in {r.vec_id for r in own}
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        assert all(r.score == d[r.vec_id] for r in own)
        d[q] = np.inf
        hits += len({r.vec_id for r in own} & set(np.lexsort((ids, d))[:10].tolist()))
    assert hits >= 0.9 * 150


def test_cells_are_visited_by_distance():
    first, second, sizes = np.array([0.0, 5.0]), np.array([1.0, 0.5]), np.array([3, 0, 2, 4])
    assert multi_index.visit(first, second, sizes, 100).tolist() == [0, 3, 2]
    assert multi_index.visit(first, second, sizes, 3).tolist() == [0]


def test_odd_rows_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(100, None), (200, []), (300, [nan, 1.0]), (400, [inf, 1.0]), (500, [None, 1.0]), (600, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 0.0]), (0, [1.0, 0.0]), (3, [1.0, 0.0]), *odd]
    near = multi_index.search(table(spark, rows)).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in near] == [(0, 1, 3, 0.0), (0, 2, 1, 2**0.5)]
    high = metric_tree.search(table(spark, rows)).orderBy("rank").collect()
    assert [(r["rank"], r.vec_id, r.score) for r in high] == [(1, 3, 1024 * 1024), (2, 1, 0), (3, 2, 0)]
    for search in (multi_index.search, metric_tree.search):
        assert search(table(spark, [])).count() == 0 and search(table(spark, odd)).count() <= 1
        assert search(table(spark, [(100, [1.0, 2.0])])).count() == 0
