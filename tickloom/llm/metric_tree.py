"""Exact top-k inner products by best-first search in M-trees.

Each shard of rows (see ``vectors``) is a tree of pages. A page has a routing vector;
an inner page lists child pages with their covering radius and distance to its own
routing vector, a leaf page lists rows with their distance to it. Pages are rows of a
written table, so a search reads them and builds nothing.

A search takes the page with the highest bound from a heap. The bound of a page or row
at distance d from the routing vector p, with covering radius r, is <q, p> + |q| (d + r)
before anything of it is computed; only what that stored triangle-inequality bound does
not rule out has its own product computed, which gives a page the bound
<q, c> + |q| r. The search ends when no bound reaches the k-th score.

Vectors become floor(1024 x) in double precision. While products stay below 2 ** 53
they are exact in floating point; else a leaf's are made in 64-bit integers, and those that
may not fit them in Python's. A score among the k best that does not fit a long (its
least value included) is an error, as in SQL.

Rows: see ``vectors.usable``; zero vectors take part. Components of 2 ** 400 or more,
which no float has, are an error. A query never finds its own row; ties go to the
smaller vec_id. An empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm import vectors as V
from tickloom.llm.common import bounded_batches, written

PAGE, SCALE = 64, 1024
PAGES = pa.schema([
    ("shard", pa.int32()), ("page", pa.int32()), ("leaf", pa.bool_()), ("ids", pa.list_(pa.int64())),
    ("vectors", pa.list_(pa.float64())), ("to_parent", pa.list_(pa.float64())), ("radius", pa.list_(pa.float64()))])
PAGES_DDL = "shard int, page int, leaf boolean, ids array<bigint>, vectors array<double>, to_parent array<double>, radius array<double>"
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
# Bounds are raised by this share of the largest product: rounding never rules out a tie.
SLACK = 1e-9
LEAST, MOST = -(2**63), 2**63 - 1


def spread_rows(x: np.ndarray, parts: int) -> np.ndarray:
    """Rows far from one another, to route by: each the farthest from those before."""
    chosen = [0]
    away = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < parts and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return np.array(chosen)


def build(shard: int, ids: np.ndarray, x: np.ndarray) -> pa.Table:
    """Bulk load: split the rows of a page among routing vectors until they fit a page."""
    pages: list[tuple] = []

    def load(rows: np.ndarray, routing: np.ndarray) -> tuple[int, float]:
        """Makes the page of these rows; its number and covering radius."""
        number = len(pages)
        pages.append(())
        own = np.sqrt(((x[rows] - routing) ** 2).sum(axis=1))
        if len(rows) <= PAGE:
            pages[number] = (shard, number, True, ids[rows], x[rows].ravel(), own, np.zeros(len(rows)))
            return number, float(own.max(initial=0.0))
        centers = x[rows][spread_rows(x[rows], min(PAGE, -(-2 * len(rows) // PAGE)))]
        near = ((centers**2).sum(axis=1) - 2 * x[rows] @ centers.T).argmin(axis=1)
        if near.min() == near.max():  # all rows are equal, or nearly: any split will do
            centers = np.repeat(centers[near[:1]], PAGE, axis=0)
            near = np.arange(len(rows)) * PAGE // len(rows)
        children = [(load(rows[near == c], centers[c]), centers[c]) for c in np.unique(near)]
        middle = np.stack([c for _, c in children])
        pages[number] = (
            shard, number, False, np.array([n for (n, _), _ in children]), middle.ravel(),
            np.sqrt(((middle - routing) ** 2).sum(axis=1)), np.array([r for (_, r), _ in children]))
        return number, float(own.max(initial=0.0))

    load(np.arange(len(ids)), x.mean(axis=0))
    return pa.table([pa.array([p[c] for p in pages], type=PAGES.field(c).type) for c in range(len(PAGES))], schema=PAGES)


class Tree:
    """The pages of one shard, in memory for the search of a block of queries."""

    def __init__(self, table: pa.Table, dimension: int):
        order = np.argsort(V.numbers(table, "page"))
        columns = [table.column(c).to_pylist() for c in ("leaf", "ids", "vectors", "to_parent", "radius")]
        self.pages = [
            (columns[0][k], np.array(columns[1][k], dtype=np.int64), np.array(columns[2][k]).reshape(-1, dimension),
             np.array(columns[3][k]), np.array(columns[4][k]))
            for k in order]
        self.reach = max((float(np.sqrt((x**2).sum(axis=1).max(initial=0.0))) for _, _, x, _, _ in self.pages), default=0.0)
        self.computed = 0  # products made so far, for tests and reports

    def products(self, q: np.ndarray, x: np.ndarray, leaf: bool) -> np.ndarray:
        self.computed += len(x)
        norm = float(np.sqrt(q @ q))
        if not leaf or norm * self.reach < 2**52:
            return x @ q
        large = max(norm, 1.0) * np.maximum(np.sqrt((x**2).sum(axis=1)), 1.0) >= 2**62
        if not large.any():
            return x.astype(np.int64) @ q.astype(np.int64)
        out, whole = np.empty(len(x), dtype=object), [int(c) for c in q.tolist()]
        if not large.all():
            out[~large] = (x[~large].astype(np.int64) @ q.astype(np.int64)).tolist()
        for n in np.flatnonzero(large).tolist():
            out[n] = sum(int(a) * b for a, b in zip(x[n].tolist(), whole))
        return out

    def search(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, vec_id) of the k best rows."""
        norm = float(np.sqrt(q @ q))
        slack = SLACK * (1 + norm * self.reach)
        best: list[tuple[float, int]] = []  # a heap of (score, -vec_id), the worst first
        # (minus the bound, page, product of the query with the page's routing vector)
        heap: list[tuple[float, int, float]] = [(-np.inf, 0, np.nan)]
        worst = -np.inf
        while heap and -heap[0][0] >= worst:
            _, number, with_routing = heapq.heappop(heap)
            leaf, ids, x, to_parent, radius = self.pages[number]
            if np.isnan(with_routing):
                open_ = np.arange(len(ids))
            else:
                before = with_routing + norm * (to_parent + radius)
                open_ = np.flatnonzero(before + slack >= worst)
            if not len(open_):
                continue
            scores = self.products(q, x[open_], leaf)
            if leaf:
                for s, vec_id in zip(scores.tolist(), ids[open_].tolist()):
                    if vec_id != query_id:
                        if len(best) < k:
                            heapq.heappush(best, (s, -vec_id))
                        elif (s, -vec_id) > best[0]:
                            heapq.heapreplace(best, (s, -vec_id))
                if len(best) == k:
                    worst = float(best[0][0])
            else:
                bounds = scores + norm * radius[open_] + slack
                for bound, child, s in zip(bounds.tolist(), ids[open_].tolist(), scores.tolist()):
                    if bound >= worst:
                        heapq.heappush(heap, (-bound, child, s))
        return [(int(s), -minus) for s, minus in best]


def search(rows: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k highest products."""
    bounded_batches(rows.sparkSession)
    # Doubles of 2 ** 53 or more are whole; F.floor gives a long.
    scaled = F.transform("vector", lambda x: F.when(F.abs(x) >= float(2**400), F.raise_error(F.lit("a component of 2 ** 400 or more")).cast("double"))
                         .when(F.abs(x * SCALE) >= float(2**53), x * SCALE).otherwise(F.floor(x * SCALE).cast("double")))
    base = written(V.usable(rows, forbid_zero=False).select("vec_id", scaled.alias("vector")), "metric-rows")
    total = base.count()
    shards = V.groups_of(total, V.SHARD_ROWS)

    def of_shard(key: tuple, table: pa.Table) -> pa.Table:
        order = np.argsort(V.numbers(table, "vec_id"))
        return build(key[0].as_py(), V.numbers(table, "vec_id")[order], V.matrix(table.column("vector"))[order])

    dealt = base.withColumn("shard", V.deal("vec_id", shards))
    pages = written(dealt.groupBy("shard").applyInArrow(of_shard, PAGES_DDL), "metric-pages")
    queries = V.query_rows(base).select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"))
    blocks = V.groups_of(queries.count(), V.BLOCK_ROWS)

    def of_block(pages: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(pages) or not len(asked):
            return FOUND.empty_table()
        q = V.matrix(asked.column("query"))
        tree, out = Tree(pages, q.shape[1]), []
        for query_id, one in zip(V.numbers(asked, "query_id").tolist(), q):
            found = tree.search(query_id, one, k)
            if any(s > MOST for s, _ in found):
                raise OverflowError(f"a score of query {query_id} does not fit a long")
            # One too small may give way to other shards' rows.
            out.append(pa.table([[query_id] * len(found), [v for _, v in found], [max(s, LEAST) for s, _ in found]], schema=FOUND))
        return V.stacked(out, FOUND)

    held = V.for_each(pages, "block", blocks)
    asked = V.for_each(queries.withColumn("block", V.deal("query_id", blocks)), "shard", shards)
    found = held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(
        of_block, "query_id bigint, vec_id bigint, score bigint")
    fits = F.when(F.col("score") > LEAST, F.col("score")).otherwise(F.raise_error(F.lit("a score does not fit a long")).cast("bigint"))
    return V.merged(found, k, ascending=False).withColumn("score", fits)
