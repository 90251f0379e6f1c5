"""Documents of many sources mixed to target weights.

The words of a source, one document after the other, are cut into blocks of ``block_words``
words; its last block may be shorter. What the mix takes of a source is a row of slots,
each of which holds one block: as many passes over all blocks as the target holds, then
part of a pass, whose last slot takes part of its block so that the words taken are the
target rounded to a whole word. Slot i of a pass holds the block a pseudorandom permutation
of the source's block numbers gives for i (a Feistel network with keys by source and pass),
so the block follows from the slot's number alone. The slots of all sources are dealt to
output shards by multinomial draws under the condition that every source's counts add up
to its slots: plain draws would miss the target by the root of it and take a scarce
source's blocks too often. Slots and blocks are then joined by (source, block).

Targets: source weights share the size of all documents; a source's target ends at
``most_passes`` times its size, and what is over is shared again by weight.

Rows: a null text has no words; an empty one is taken 0 times. A null source is a source.
Rows of the same doc_id, or wholly equal rows, are documents of their own. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import mix as hashed, written
from tickloom.operators.ranks import position, running_total

WEIGHTS = (1, 2, 3)
MOST_PASSES = 3
BLOCK_WORDS = 256
SHARD_SLOTS = 1024
# Shards whose counts are drawn together; their slots are held by one task at a time.
DRAWN_SHARDS = 16
SEED = 11

# A source is known by these two: joins and windows are then without nulls.
SOURCE = ["no_source", "source_name"]

_STEP = 0x9E3779B97F4A7C15  # an odd factor


def _times_step(n: int) -> np.uint64:
    return np.uint64(n * _STEP % (1 << 64))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("bigint")


def sized(docs: DataFrame) -> DataFrame:
    """Per document its size and ``at``, the words of its source before it, as a written table."""
    rows = docs.select(
        "doc_id", F.col("source").isNull().alias(SOURCE[0]), F.coalesce("source", F.lit("")).alias(SOURCE[1]),
        n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_text"))
    # Rows equal in all of these are taken alike, in whatever order they come.
    order = [F.col("doc_id"), F.col("size"), F.col("_text")]
    return written(running_total(rows, SOURCE, order, F.col("size"), "at").drop("_text"), "mix-sizes")


def _exact(number: int) -> Column:
    return F.lit(str(number)).cast("decimal(38,0)")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_passes: int = MOST_PASSES) -> DataFrame:
    """Per source: source_size, weight, target. Weights repeat over the sources by code point, null last.

    The uncapped sources have one rate of words per weight. It only rises as more sources
    are capped, so a source is capped if and only if its bound lies below that rate: a few
    sums over the table of sources find it, in whole numbers.
    """
    totals = sizes.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    ranked = position(totals, [], SOURCE)
    choices = F.array(*[F.lit(w).cast("bigint") for w in weights])
    table = written(ranked.select(
        *SOURCE, "source_size", F.get(choices, (F.col("_position") % len(weights)).cast("int")).alias("weight")), "mix-sources")
    bound = (F.col("source_size") * most_passes).cast("decimal(38,0)")
    words, shares, capped = 0, 1, -1
    while True:
        over = bound * _exact(shares) < F.col("weight") * _exact(words)
        found = table.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(over, bound).otherwise(_exact(0))).alias("bounded"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("shares"), F.count_if(over).alias("capped")).first()
        if found["capped"] == capped or not found["shares"]:
            break
        words, shares, capped = int(found["all"]) - int(found["bounded"]), found["shares"], found["capped"]
    free = F.col("weight") * F.lit(float(words)) / F.lit(float(shares))
    return table.withColumn("target", F.when(over, bound.cast("double")).otherwise(free))


def _with_slots(sources: DataFrame, block_words: int) -> DataFrame:
    """Whole blocks, words of the tail, words and slots taken: per source that gives any."""
    block = F.lit(block_words).cast("bigint")
    counted = sources.filter((F.col("source_size") > 0) & (F.round("target") > 0)).select(
        *SOURCE, F.round("target").cast("bigint").alias("words"), "source_size",
        F.expr(f"source_size DIV {block_words}").alias("whole"), (F.col("source_size") % block).alias("tail"))
    # Of the part of a pass, whole blocks come first and the tail last.
    return counted.withColumn("slots", F.expr(
        "(words DIV source_size) * (whole + IF(tail > 0, 1L, 0L))"
        f" + (words % source_size + {block_words - 1}) DIV {block_words}"))


def _quotas(sources: DataFrame, groups: int) -> DataFrame:
    """Each source's slots over groups of shards in equal parts: (source, group, first slot, number).

    One row per group with any slot; a source of fewer slots than groups begins at a place of its own.
    """
    parts = F.least("slots", F.lit(groups).cast("bigint"))
    first = F.expr("CAST((CAST(_k AS DECIMAL(38,0)) * slots) DIV _parts AS BIGINT)")
    after = F.expr("CAST((CAST(_k + 1 AS DECIMAL(38,0)) * slots) DIV _parts AS BIGINT)")
    turn = F.pmod(F.xxhash64(*SOURCE), F.lit(groups).cast("bigint"))
    place = F.expr(f"CAST((CAST(_k AS DECIMAL(38,0)) * {groups}) DIV _parts AS BIGINT)")
    return (
        sources.withColumn("_parts", parts).withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)))
        .select(*sources.columns, F.pmod(place + turn, F.lit(groups).cast("bigint")).alias("group"),
                first.alias("first"), (after - first).alias("quota"))
    )


def permuted(places: np.ndarray, size: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """A permutation of 0..size-1 per key, applied to each place: four Feistel rounds over the
    next even power of two, gone on with until the number is below the size."""
    half = np.maximum((np.ceil(np.log2(np.maximum(size, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2), np.uint64(1))
    mask, out = (np.uint64(1) << half) - np.uint64(1), places.astype(np.uint64)
    keys, open_ = keys.astype(np.uint64), np.arange(len(places))
    while len(open_):
        h, m, k, x = half[open_], mask[open_], keys[open_], out[open_]
        left, right = x >> h, x & m
        for turn in range(4):
            left, right = right, left ^ (hashed(right + k + _times_step(turn)) & m)
        out[open_] = (left << h) | right
        open_ = open_[out[open_] >= size[open_].astype(np.uint64)]
    return out.astype(np.int64)


def source_keys(absent: Sequence[bool], names: Sequence[str], seed: int) -> np.ndarray:
    """A 64-bit key per source."""
    return hashed(np.array([(zlib.crc32(n.encode()) << 2) + 2 * a + 1 for a, n in zip(absent, names)], dtype=np.uint64)
                  + _times_step(seed))


def draw_counts(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Slots of each source per shard: multinomial draws one shard after the other from what is left."""
    left, out = quotas.astype(np.int64).copy(), []
    for shard in range(shards):
        size = -(-int(left.sum()) // (shards - shard))
        out.append(rng.multivariate_hypergeometric(left, size, method="marginals"))
        left -= out[-1]
    return np.array(out)


_SLOTS = "shard long, place long, no_source boolean, source_name string, block long, words long"


def _deal(block_words: int, shard_slots: int, seed: int):
    """Slots of a group of shards: drawn, put in order, and filled with blocks."""

    def step(key: tuple[pa.Scalar], group: pa.Table) -> pa.Table:
        number = key[0].as_py()
        group = group.sort_by([(SOURCE[0], "ascending"), (SOURCE[1], "ascending"), ("first", "ascending")])
        column = {c: group.column(c).to_numpy() for c in ("first", "quota", "whole", "tail", "words", "source_size")}
        quota = column["quota"]
        shards = max(1, -(-int(quota.sum()) // shard_slots))
        rng = np.random.default_rng([seed, number])
        counts = draw_counts(quota, shards, rng)
        used = np.cumsum(counts, axis=0) - counts
        keys = source_keys(group.column(SOURCE[0]).to_pylist(), group.column(SOURCE[1]).to_pylist(), seed)
        rows, slots, shard, place = [], [], [], []
        for s in range(shards):
            n = int(counts[s].sum())
            row = np.repeat(np.arange(len(quota)), counts[s])
            within = np.arange(n) - np.repeat(np.cumsum(counts[s]) - counts[s], counts[s])
            rows.append(row)
            slots.append(column["first"][row] + used[s][row] + within)
            shard.append(np.full(n, (number << 20) + s))
            place.append(rng.permutation(n))
        row, slot = np.concatenate(rows), np.concatenate(slots)
        whole, tail, size = column["whole"][row], column["tail"][row], column["source_size"][row]
        per_pass = whole + (tail > 0)
        turn, inside = slot // per_pass, slot % per_pass
        block = whole.copy()
        full = inside < whole
        block[full] = permuted(inside[full], whole[full], hashed(keys[row[full]] + turn[full].astype(np.uint64)))
        # Words left for a slot of the part of a pass; any slot of a whole pass has them all.
        left = column["words"][row] - turn * size - inside * block_words
        words = np.minimum(np.where(full, block_words, tail), left)
        source = group.select(SOURCE).take(pa.array(row))
        return pa.table([
            pa.array(np.concatenate(shard)), pa.array(np.concatenate(place).astype(np.int64)), *source.columns,
            pa.array(block), pa.array(words)], names=[c.split(" ")[0] for c in _SLOTS.split(", ")])

    return step


def slots_of(sources: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mix as slots: shard, place in it, source, block of the source, words taken of the block.

    A group of shards holds at most about ``DRAWN_SHARDS * shard_slots`` slots, however many
    there are in all; groups are independent and follow from their number and the seed.
    """
    taken = written(_with_slots(sources, block_words), "mix-slots")
    total = taken.agg(F.sum("slots")).first()[0] or 0
    groups = max(1, -(-total // (DRAWN_SHARDS * shard_slots)))
    return _quotas(taken, groups).groupBy("group").applyInArrow(_deal(block_words, shard_slots, seed), _SLOTS)


def pieces_of(sizes: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every document's words by block: (source, block, at, size, doc_id, begin in the block, length)."""
    block = F.lit(block_words).cast("bigint")
    blocks = F.expr(f"sequence(at DIV {block_words}, (at + size - 1) DIV {block_words})")
    cut = sizes.filter(F.col("size") > 0).withColumn("block", F.explode(blocks))
    begin = F.greatest(F.col("at") - F.col("block") * block, F.lit(0))
    end = F.least(F.col("at") + F.col("size") - F.col("block") * block, block)
    return cut.select(*SOURCE, "block", "doc_id", "at", "size", begin.alias("begin"), (end - begin).alias("length"))


def mixed(sizes: DataFrame, sources: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mix: per slot the stretches of documents it takes, ``start`` and ``length`` in words of the document.

    A block meets at most ``most_passes`` + 1 slots, and a slot at most ``block_words``
    documents, so no key of the join holds much. Both sides grow with the documents: they
    are merged, never broadcast.
    """
    slots, pieces = slots_of(sources, block_words, shard_slots, seed), pieces_of(sizes, block_words)
    taken = F.least(F.col("length"), F.col("words") - F.col("begin"))
    return pieces.join(slots.hint("merge"), [*SOURCE, "block"]).withColumn("length", taken).filter("length > 0").select(
        "shard", "place", *SOURCE, "block", "doc_id", "at", (F.col("block") * block_words + F.col("begin") - F.col("at")).alias("start"), "length")


def takes(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_passes: int = MOST_PASSES, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, size, its source's size and target, and the words the mix takes of it."""
    sizes = sized(docs)
    sources = targets(sizes, weights, most_passes)
    # A document with words is known by its source and place; those without are taken 0 times.
    by_place = mixed(sizes, sources, block_words, seed=seed).groupBy(*SOURCE, "at").agg(F.sum("length").alias("taken"))
    with_words = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("bigint")
    return sizes.join(by_place.hint("merge"), [*SOURCE, "at"], "left").join(sources, SOURCE).select(
        "doc_id", "size", "source_size", "target", with_words.alias("taken"))
