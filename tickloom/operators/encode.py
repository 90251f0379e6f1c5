"""Topic records: envelopes around decoded events, and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.market import dlq_topic, topic_for
from tickloom.schemas import (
    AGG_TRADE, BOOK_TICKER, Field, KLINE, KLINE_EVENT_FIELDS, KLINE_FIELDS, SCHEMA_VERSION,
    TICKER_FIELDS, TRADE_FIELDS,
)


def _wire(event: Column, fields: tuple[Field, ...]) -> list[Column]:
    return [event[f.name].alias(f.wire) for f in fields]


def payload_struct(kind: str) -> Column:
    """Event struct of ``kind`` back under its wire key names."""
    event = F.col(kind)
    if kind == AGG_TRADE:
        return F.struct(*_wire(event, TRADE_FIELDS))
    if kind == BOOK_TICKER:
        return F.struct(*_wire(event, TICKER_FIELDS))
    return F.struct(*_wire(event, KLINE_EVENT_FIELDS), F.struct(*_wire(event, KLINE_FIELDS)).alias("k"))


def envelope_json(kind: str) -> Column:
    return F.to_json(
        F.struct(
            F.lit(kind).alias("event_type"),
            F.lit(SCHEMA_VERSION).alias("schema_version"),
            payload_struct(kind).alias("payload"),
        )
    )


def to_topic_rows(decoded: DataFrame, *keep: str) -> DataFrame:
    """``key``, ``value``, ``topic`` of every decoded event; one pass over the input.

    The key is the outer event symbol, so one symbol stays in one partition.
    """
    kind = F.col("kind")
    key = (
        F.when(kind == AGG_TRADE, F.col(f"{AGG_TRADE}.symbol"))
        .when(kind == BOOK_TICKER, F.col(f"{BOOK_TICKER}.symbol"))
        .when(kind == KLINE, F.col(f"{KLINE}.event_symbol"))
    )
    value = (
        F.when(kind == AGG_TRADE, envelope_json(AGG_TRADE))
        .when(kind == BOOK_TICKER, envelope_json(BOOK_TICKER))
        .when(kind == KLINE, envelope_json(KLINE))
    )
    return decoded.filter(kind.isin(AGG_TRADE, BOOK_TICKER, KLINE)).select(
        *keep, kind.alias("event_type"), key.alias("key"), value.alias("value"), topic_for(kind).alias("topic")
    )


def dead_letters(decoded: DataFrame, consumer: str) -> DataFrame:
    """Undecodable records for the sibling topic: key and value as they came.

    ``consumer`` tags which path parked the record, since both paths may.
    """
    def header(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), F.encode(value.cast("string"), "UTF-8").alias("value"))

    headers = F.array(
        header("dlq.error", F.col("error")),
        header("dlq.source_topic", F.col("topic")),
        header("dlq.partition", F.col("partition")),
        header("dlq.offset", F.col("offset")),
    )
    # A record without a key is parked under an empty one.
    key = F.coalesce(F.col("key").cast("binary"), F.lit("").cast("binary"))
    return decoded.filter(F.col("error").isNotNull()).select(
        key.alias("key"), F.col("value").cast("binary").alias("value"),
        dlq_topic(F.col("topic")).alias("topic"), headers.alias("headers"), F.lit(consumer).alias("consumer"),
    )
