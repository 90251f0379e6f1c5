"""Scalar market expressions: keys, topics, intervals, sides, spreads."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F, types as T

from tickloom.schemas import (
    AGG_TRADE, BOOK_TICKER, BOOK_TICKERS_TOPIC, DEFAULT_LIMIT, DLQ_SUFFIX, INTERVAL_MS, KLINE,
    KLINES_TOPIC, TRADES_TOPIC, VALID_INTERVALS,
)


def page_size(limit: int | None, most: int | None = None) -> int:
    """Rows of a page: the caller's number; a server may name the most it gives."""
    size = max(1, DEFAULT_LIMIT if limit is None else limit)
    return size if most is None else min(size, most)


def topic_for(kind: Column) -> Column:
    return (
        F.when(kind == AGG_TRADE, TRADES_TOPIC)
        .when(kind == BOOK_TICKER, BOOK_TICKERS_TOPIC)
        .when(kind == KLINE, KLINES_TOPIC)
    )


def dlq_topic(topic: Column) -> Column:
    return F.concat(topic, F.lit(DLQ_SUFFIX))


def composite_key(*parts: Column) -> Column:
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def exchange_symbol(symbol: Column) -> Column:
    return F.upper(symbol)


def stream_symbol(symbol: Column) -> Column:
    return F.lower(symbol)


def is_valid_interval(interval: Column) -> Column:
    return interval.isin(*VALID_INTERVALS)


def interval_list(raw: Column) -> Column:
    """Column form of the comma list: split, trim, drop empties."""
    return F.filter(F.transform(F.split(raw, ","), lambda part: F.trim(part)), lambda part: part != "")


def interval_ms(interval: Column) -> Column:
    """Nominal length of one candle in milliseconds; NULL for unknown intervals."""
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v).cast("bigint")) for k, v in INTERVAL_MS.items()))
    return F.try_element_at(table, interval)


def spread(bid: Column, ask: Column) -> Column:
    return F.round(ask - bid, 2).cast(T.DecimalType(38, 2))


def aggressor_side(is_buyer_maker: Column) -> Column:
    return F.when(is_buyer_maker, "sell").otherwise("buy")


def candle_direction(open_: Column, close: Column) -> Column:
    return F.when(close >= open_, "up").otherwise("down")
