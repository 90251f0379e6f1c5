"""Running totals and ranks of any number of rows per key, without one task per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.session import new_work_dir

_RANGE = "_range"


def _in_ranges(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Rows dealt by range, each with the number of its range, as a written table.

    It is written because range borders come from a sample: a range must hold the same
    rows whenever it is read again.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_work_dir(spark, "ranges")
    dealt = rows.repartitionByRange(ranges, *keys, *order).withColumn(_RANGE, F.spark_partition_id())
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def running_total(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: Column, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over the earlier rows of the same keys; 0 for the first.

    A key may hold any share of the rows: they are cut into ranges, each range is summed,
    and only the sums are put in order in one place, at most one per key and range. Keys
    are not null. Rows equal in ``order`` come in any order.
    """
    ranged = _in_ranges(rows.withColumn("_value", value), keys, order)
    same_key = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*keys, _RANGE).agg(F.sum("_value").alias("_sum"))
    offsets = sums.select(*keys, _RANGE, F.coalesce(F.sum("_sum").over(same_key), F.lit(0)).alias("_offset"))
    earlier = Window.partitionBy(*keys, _RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("_value").over(earlier), F.lit(0))
    return (
        ranged.withColumn("_within", within).join(offsets, [*keys, _RANGE])
        .select(*rows.columns, (F.col("_offset") + F.col("_within")).alias(name))
    )


def position(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "_position") -> DataFrame:
    """``name``: the row's place among those of the same keys, from 0."""
    return running_total(rows, keys, order, F.lit(1).cast("bigint"), name)
