"""Last-writer-wins: the newest row per key, and keyed upserts.

Both reduce on the map side, so a key holding a large share of all rows still
sends one row per task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

PARTITION = "kafka_partition"
OFFSET = "kafka_offset"

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _is_fixed_width(df: DataFrame, columns: Sequence[str]) -> bool:
    return all(isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in columns)


def _pick(df: DataFrame, values: Sequence[str], order: Column) -> list[Column]:
    """One ``max_by`` per column when every buffer fits a hash aggregate, else one struct.

    All ``max_by`` of one aggregate see the same rows in the same order, so they
    settle on the same row.
    """
    if _is_fixed_width(df, values):
        return [F.max_by(c, order).alias(c) for c in values]
    return [F.max_by(F.struct(*values), order).alias("_row")]


def _flatten(df: DataFrame, keys: Sequence[str], rest: Sequence[str]) -> DataFrame:
    return df.select(*keys, "_row.*", *rest) if "_row" in df.columns else df


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    *,
    across_partitions: str = "offset",
    partition: str = PARTITION,
    offset: str = OFFSET,
) -> DataFrame:
    """Row with the highest offset per key.

    First per (key, log partition) on the bare offset, then across the few
    partitions a key was seen in. ``across_partitions`` says which counts first
    there: ``offset`` for candle history, ``arrival`` (partition, then offset) for
    live state. One symbol lives in one partition, where the two agree; after a
    change of the partition count neither is the true arrival order.
    """
    values = [c for c in df.columns if c not in {*keys, partition, offset}]
    inner_keys = [*keys, partition]
    inner = _flatten(
        df.groupBy(*inner_keys).agg(*_pick(df, values, F.col(offset)), F.max(offset).alias(offset)),
        inner_keys, [offset],
    )
    order = F.struct(offset, partition) if across_partitions == "offset" else F.struct(partition, offset)
    outer = inner.groupBy(*keys).agg(F.max_by(F.struct(*values, partition, offset), order).alias("_row"))
    return outer.select(*keys, "_row.*").select(*df.columns)


def override(base: DataFrame, newer: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both by key; where both have a key, the row of ``newer`` is taken."""
    columns = base.columns
    both = base.withColumn("_source", F.lit(0)).unionByName(newer.select(*columns).withColumn("_source", F.lit(1)))
    values = [c for c in columns if c not in keys]
    merged = both.groupBy(*keys).agg(*_pick(both, values, F.col("_source")))
    return _flatten(merged, keys, []).select(*columns)


def upsert(snapshot: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update-else-insert; ``updates`` must hold one row per key."""
    return override(snapshot, updates, keys)


def upsert_arrivals(
    snapshot: DataFrame, arrivals: DataFrame, keys: Sequence[str], *, partition: str = PARTITION, offset: str = OFFSET
) -> DataFrame:
    """The snapshot after ``arrivals``: per key the last to arrive (partition, then offset), else its own row.

    One aggregation, combined before the shuffle: any arrival outranks the snapshot.
    """
    columns = snapshot.columns
    values = [c for c in columns if c not in keys]
    at = F.struct(F.col(partition).cast("int").alias("partition"), F.col(offset).cast("bigint").alias("offset"))
    held = snapshot.withColumn("_at", F.lit(None).cast("struct<partition:int,offset:bigint>"))
    both = held.unionByName(arrivals.select(*columns, at.alias("_at")))
    order = F.struct(F.col("_at").isNotNull().alias("arrived"), "_at")
    newest = both.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_row"))
    return newest.select(*keys, "_row.*").select(*columns)


# --- Changes of a table ---------------------------------------------------------

CHANGE, INSERTED, UPDATED, DELETED = "change", "insert", "update", "delete"


def changes_between(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What turns one state of a table into the next: a row per key that differs, with ``change``.

    Both states hold one row per key and have the same columns; keys are not null. An
    insert or update has the new row, a delete the key alone. Values are compared null-safe.
    """
    columns, values = after.columns, [c for c in after.columns if c not in keys]
    old = before.select(*keys, F.struct(*values).alias("_old"), F.lit(True).alias("_was"))
    new = after.select(*keys, F.struct(*values).alias("_new"), F.lit(True).alias("_is"))
    change = (
        F.when(F.col("_was").isNull(), INSERTED).when(F.col("_is").isNull(), DELETED)
        .when(~F.col("_old").eqNullSafe(F.col("_new")), UPDATED)
    )
    differing = old.join(new, list(keys), "full_outer").withColumn(CHANGE, change).filter(F.col(CHANGE).isNotNull())
    return differing.select(*[c if c in keys else F.col(f"_new.{c}").alias(c) for c in columns], CHANGE)


def apply_changes(state: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The next state; ``changes`` holds at most one row per key."""
    kept = state.join(changes.select(*keys), list(keys), "left_anti").select(state.columns)
    return kept.unionByName(changes.filter(F.col(CHANGE) != DELETED).select(state.columns))
