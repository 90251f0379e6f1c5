"""What the vector searches share: usable vectors, shards, query blocks, merged ranks.

A search compares a stated query set with all rows. Rows are dealt by a hash of vec_id
into shards of about ``SHARD_ROWS`` and queries into blocks of about ``BLOCK_ROWS``;
each pair of a shard and a block is one group of bounded size. Many equal or close
vectors are spread over all shards, so no group grows with them.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

SHARD_ROWS, BLOCK_ROWS = 4096, 512


def usable(rows: DataFrame, forbid_zero: bool) -> DataFrame:
    """vec_id and vector (doubles) of rows that take part in a search.

    Left out: null ids, null or empty vectors, null or non-finite components, zero
    vectors if so asked, vectors not of the usual length (that of most rows, of equally
    usual ones the least). Of rows with one vec_id the least vector counts.
    """
    vector = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if forbid_zero:
        fine = fine & F.exists("vector", lambda x: x != 0)
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)).filter(F.coalesce(fine, F.lit(False)))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    length = lengths[0]["n"] if lengths else 0
    return rows.filter(F.size("vector") == length).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def query_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("vec_id") % 100 == 0)


def deal(column: str, groups: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(groups)).cast("int")


def groups_of(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def for_each(rows: DataFrame, name: str, groups: int) -> DataFrame:
    """Every row once for each of so many groups."""
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k least scores, ties to the smaller id."""
    if len(scores) > k:
        bound = np.partition(scores, k - 1)[k - 1]
        near = np.flatnonzero(scores <= bound)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], scores[near]))][:k]


def merged(found: DataFrame, k: int, ascending: bool) -> DataFrame:
    """Rank the shards' best rows of each query."""
    order = F.asc("score") if ascending else F.desc("score")
    ranks = Window.partitionBy("query_id").orderBy(order, "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def stacked(tables: list[pa.Table], schema: pa.Schema) -> pa.Table:
    return reduce(lambda a, b: pa.concat_tables([a, b]), tables, schema.empty_table())
