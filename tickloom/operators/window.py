"""Bounded rolling candle window with slack, and slices of a candle series.

A window keeps the newest ``keep`` candles per symbol by open time. A candle
already held is updated in place; a new one is inserted, and only an insert that
takes the window past ``keep + slack`` trims it back to ``keep``. What is held
therefore depends on the order of arrival.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.market import composite_key
from tickloom.operators.ranks import position
from tickloom.schemas import DEFAULT_VISIBLE, KLINE, LIVE_KLINE_SECOND, MIN_VISIBLE, WINDOW_INTERVAL, WINDOW_KEEP, WINDOW_SLACK


def window_arrivals(decoded: DataFrame) -> DataFrame:
    """One-second candles only, with their arrival position."""
    candles = decoded.filter((F.col("kind") == KLINE) & (F.col(f"{KLINE}.interval") == WINDOW_INTERVAL))
    return candles.select(F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), f"{KLINE}.*").withColumn(
        "id", composite_key(F.col("symbol"), F.col("open_time"))).select(*LIVE_KLINE_SECOND.names, "kafka_partition", "kafka_offset")


def trim_cutoff(times: Column, keep: int, slack: int) -> Column:
    """Open time below which candles are dropped; NULL while there is room."""
    return F.when(F.size(times) > keep + slack, F.get(F.sort_array(times, asc=False), keep - 1))


def held_after_inserts(before: Column, inserts: Column, keep: int, slack: int) -> Column:
    """Candles held after ``inserts`` new ones arrived oldest first."""
    total = before + inserts
    return F.when(total <= keep + slack, total).otherwise(
        F.lit(keep) + (total - F.lit(keep + slack + 1)) % F.lit(slack + 1)
    )


def _newest(df: DataFrame, keys: Sequence[str], at_most: int) -> DataFrame:
    """Rank by newest open time, cut at a constant so each task keeps only its own newest."""
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("open_time"))
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter(F.col("_rank") <= at_most)


def _simulate(keep: int, slack: int):
    """Replay arrivals numbered per symbol, in order; memory holds one window."""

    def held_rows(symbol: str, times: list[int]) -> pd.DataFrame:
        return pd.DataFrame({"symbol": [symbol] * len(times), "open_time": times})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, times = None, []
        for batch in batches:
            for symbol, open_time, step in zip(batch["symbol"], batch["open_time"], batch["_step"]):
                if step == 1:
                    if times:
                        yield held_rows(current, times)
                    current, times = symbol, []
                at = bisect_left(times, open_time)
                if at < len(times) and times[at] == open_time:
                    continue
                insort(times, open_time)
                if len(times) > keep + slack:
                    times = times[-keep:]
        if times:
            yield held_rows(current, times)

    return run


def _position(partition: str, offset: str) -> Column:
    return F.struct(F.col(partition).cast("int").alias("partition"), F.col(offset).cast("bigint").alias("offset"))


def reduce_arrivals(
    held: DataFrame, arrivals: DataFrame, *, partition: str = "kafka_partition", offset: str = "kafka_offset"
) -> DataFrame:
    """One row per (symbol, open_time) over held rows and arrivals: the newest
    ``_row``, its first and last arrival, and whether it was held before."""
    values = [c for c in held.columns if c not in ("symbol", "open_time")]
    position = _position(partition, offset)
    none = F.lit(None).cast("struct<partition:int,offset:bigint>")
    batch = arrivals.groupBy("symbol", "open_time").agg(
        F.max_by(F.struct(*values), position).alias("_row"),
        F.min(position).alias("_first"),
        F.max(position).alias("_last"),
    ).withColumn("_held", F.lit(False))
    before = held.select(
        "symbol", "open_time", F.struct(*values).alias("_row"), none.alias("_first"), none.alias("_last"),
        F.lit(True).alias("_held"),
    )
    return before.unionByName(batch).groupBy("symbol", "open_time").agg(
        F.max_by("_row", ~F.col("_held")).alias("_row"),
        F.max("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.bool_or("_held").alias("_held"),
    )


def window_after(
    reduced: DataFrame,
    held: DataFrame,
    arrivals: DataFrame,
    keep: int = WINDOW_KEEP,
    slack: int = WINDOW_SLACK,
    *,
    partition: str = "kafka_partition",
    offset: str = "kafka_offset",
) -> DataFrame:
    """Window rows after ``arrivals``, given the same reduced once.

    Exact for any arrival order. Per symbol:

    * no trim can happen: everything is held;
    * times arrived in order: the number held has a closed form, always the newest;
    * otherwise the order matters: (symbol, open_time) pairs alone are sorted by
      arrival and replayed in a stream that keeps one window in memory.

    The last case runs a symbol's replay in one task because each step depends on
    the one before. It carries two columns per arrival of such symbols only.
    ``reduced`` is used several times, so persist it where that pays.
    """
    columns, merged = held.columns, reduced
    totals = merged.groupBy("symbol").agg(
        F.count_if("_held").alias("_before"),
        F.count_if(~F.col("_held")).alias("_inserts"),
        F.max(F.when(F.col("_held"), F.col("open_time"))).alias("_held_max"),
    )
    trimming = totals.filter(F.col("_before") + F.col("_inserts") > keep + slack)
    # In order: nothing earlier in time arrived after a candle's first arrival.
    earlier = Window.partitionBy("symbol").orderBy("open_time").rowsBetween(Window.unboundedPreceding, -1)
    last_before = F.max("_last").over(earlier)
    late = F.when(F.col("_held"), last_before.isNotNull()).otherwise(
        F.coalesce(last_before > F.col("_first"), F.lit(False))
        | F.coalesce(F.col("_held_max") > F.col("open_time"), F.lit(False))
    )
    out_of_order = (
        merged.join(trimming.select("symbol", "_held_max"), "symbol")
        .select("symbol", late.alias("_late"))
        .groupBy("symbol").agg(F.bool_or("_late").alias("_late"))
        .filter("_late").select("symbol")
    )

    counted = totals.join(out_of_order, "symbol", "left_anti").select(
        "symbol", held_after_inserts(F.col("_before"), F.col("_inserts"), keep, slack).alias("_keep")
    )
    in_order = (
        _newest(merged.select("symbol", "open_time", "_row"), ["symbol"], keep + slack)
        .join(counted, "symbol").filter(F.col("_rank") <= F.col("_keep"))
        .select("symbol", "open_time", "_row")
    )

    start = F.struct(F.lit(-1).alias("partition"), F.col("open_time").alias("offset"))
    # Numbering the steps is what sorts them: a window needs one partition per symbol
    # in this order, which a plain repartition and local sort do not guarantee once
    # the plan is changed at run time.
    in_arrival_order = Window.partitionBy("symbol").orderBy("_at", "open_time")
    sequence = (
        held.select("symbol", "open_time", start.alias("_at"))
        .unionByName(arrivals.select("symbol", "open_time", _position(partition, offset).alias("_at")))
        .join(out_of_order, "symbol", "left_semi")
        .select("symbol", "open_time", F.row_number().over(in_arrival_order).alias("_step"))
    )
    replayed = merged.select("symbol", "open_time", "_row").join(
        sequence.mapInPandas(_simulate(keep, slack), "symbol string, open_time bigint"),
        ["symbol", "open_time"], "left_semi",
    )
    return in_order.unionByName(replayed).select("symbol", "open_time", "_row.*").select(*columns)


def update_window(
    held: DataFrame, arrivals: DataFrame, keep: int = WINDOW_KEEP, slack: int = WINDOW_SLACK
) -> DataFrame:
    """Window after ``arrivals`` on top of the rows ``held`` before them."""
    return window_after(reduce_arrivals(held, arrivals), held, arrivals, keep, slack)


def visible_slice(
    candles: DataFrame,
    keys: Sequence[str] = ("symbol", "interval"),
    count: int | None = None,
    start: int | None = None,
) -> DataFrame:
    """Newest ``count`` candles per series, or ``count`` from position ``start``.

    Expects one row per candle. Following the newest edge (no ``start``) keeps a
    bounded number of rows per task. A ``start`` needs every candle's place in its
    series, which is counted over ranges of open times: a long series is spread over tasks.
    """
    count = max(MIN_VISIBLE, DEFAULT_VISIBLE if count is None else count)
    if start is None:
        return _newest(candles, keys, count).drop("_rank")
    totals = candles.groupBy(*keys).agg(F.count("*").alias("_total"))
    last_start = F.greatest(F.lit(0), F.col("_total") - count)
    first = F.greatest(F.lit(0), F.least(F.lit(start), last_start))
    placed = position(candles, keys, ["open_time"]).join(totals, list(keys))
    return placed.filter(F.col("_position").between(first, first + count - 1)).select(candles.columns)


def price_range(visible: DataFrame, keys: Sequence[str] = ("symbol", "interval")) -> DataFrame:
    """Lowest low and highest high per series, padded at both ends for display."""
    bounds = visible.groupBy(*keys).agg(
        F.min("low").cast("double").alias("_low"), F.max("high").cast("double").alias("_high")
    )
    low, high = F.col("_low"), F.col("_high")
    extent = (
        F.when(high != low, high - low)
        .when(F.abs(high) * F.lit(0.001) != 0, F.abs(high) * F.lit(0.001))
        .otherwise(F.lit(1.0))
    )
    pad = extent * F.lit(0.08)
    return bounds.select(*keys, (low - pad).alias("range_min"), (high + pad).alias("range_max"))
