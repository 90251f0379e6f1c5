"""Validation and coverage reports over symbols, intervals and feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tickloom.functions.market import exchange_symbol, interval_ms, is_valid_interval, stream_symbol
from tickloom.schemas import AGG_TRADE_SUFFIX, BOOK_TICKER_SUFFIX, KLINE_SUFFIX_PREFIX, MAX_STREAMS


def invalid_intervals(klines: DataFrame) -> DataFrame:
    """Intervals outside the accepted set, with how often they occur."""
    return klines.groupBy("interval").agg(F.count("*").alias("rows")).filter(~is_valid_interval(F.col("interval")))


def symbol_validation(rows: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Each symbol text in both spellings, and whether it names an allowed symbol."""
    wanted = [symbol.upper() for symbol in allowed]
    return (
        rows.groupBy("symbol").agg(F.count("*").alias("rows"))
        .select(
            "symbol", exchange_symbol(F.col("symbol")).alias("exchange_symbol"),
            stream_symbol(F.col("symbol")).alias("stream_symbol"),
            F.upper("symbol").isin(wanted).alias("is_allowed"), "rows",
        )
    )


def stream_catalogue(symbols: DataFrame, intervals: Sequence[str]) -> DataFrame:
    """Expected stream names: two feeds plus one per interval, for each symbol."""
    feeds = [AGG_TRADE_SUFFIX, BOOK_TICKER_SUFFIX, *[KLINE_SUFFIX_PREFIX + i for i in intervals]]
    return symbols.select(
        "symbol", F.explode(F.array(*[F.lit(feed) for feed in feeds])).alias("feed")
    ).select("symbol", F.concat(stream_symbol(F.col("symbol")), F.lit("@"), "feed").alias("stream"))


def require_stream_limit(symbols: Sequence[str], intervals: Sequence[str]) -> int:
    """Number of streams of one connection; raises past its limit."""
    streams = len(symbols) * (2 + len(intervals))
    if streams > MAX_STREAMS:
        raise ValueError(f"{streams} streams exceed the limit of {MAX_STREAMS} per connection")
    return streams


def feed_coverage(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Expected streams never observed. ``observed`` has one ``stream`` per frame."""
    seen = observed.groupBy("stream").agg(F.count("*").alias("frames"))
    return expected.join(seen, "stream", "left_anti")


def series_staleness(klines: DataFrame, as_of_ms: int | None = None) -> DataFrame:
    """Newest candle per series and its age in candle lengths.

    Without ``as_of_ms`` the age is taken against the newest candle of all.
    """
    newest = klines.groupBy("symbol", "interval").agg(F.max("open_time").alias("newest_open_time"))
    if as_of_ms is None:
        as_of = newest.agg(F.max("newest_open_time")).scalar()
        newest = newest.withColumn("as_of_ms", as_of)
    else:
        newest = newest.withColumn("as_of_ms", F.lit(as_of_ms).cast("bigint"))
    length = interval_ms(F.col("interval"))
    age = F.col("as_of_ms") - F.col("newest_open_time")
    return newest.select(
        "symbol", "interval", "newest_open_time", age.alias("age_ms"),
        F.floor(age / length).alias("candles_behind"),
    )


def symbol_mismatches(decoded: DataFrame) -> DataFrame:
    """Candle events whose outer and nested symbols differ."""
    return decoded.filter(
        (F.col("kind") == "kline") & (F.col("kline.event_symbol") != F.col("kline.symbol"))
    ).groupBy(
        F.col("kline.event_symbol").alias("event_symbol"), F.col("kline.symbol").alias("symbol")
    ).agg(F.count("*").alias("rows"))
