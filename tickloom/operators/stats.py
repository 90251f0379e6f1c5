"""Counters and manifests over decoded events and lake rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.schemas import AGG_TRADE, BOOK_TICKER, CONTROL, KLINE, LakeTable


def decode_counters() -> list[Column]:
    """Aggregates over ``kind`` and ``error``; also usable with ``observe``."""
    kind = F.col("kind")
    return [
        F.count_if(kind.isin(AGG_TRADE, BOOK_TICKER, KLINE)).alias("events"),
        F.count_if(kind == AGG_TRADE).alias("agg_trades"),
        F.count_if(kind == BOOK_TICKER).alias("book_tickers"),
        F.count_if(kind == KLINE).alias("klines"),
        F.count_if(F.col("error").isNotNull()).alias("decode_errors"),
        F.count_if(kind == CONTROL).alias("server_shutdowns"),
    ]


def decode_stats(decoded: DataFrame) -> DataFrame:
    """One row of counts; errors and control frames are not events."""
    return decoded.agg(*decode_counters())


def stats_line(stats: DataFrame) -> DataFrame:
    return stats.select(
        F.format_string(
            "%d events (agg_trade=%d, book_ticker=%d, kline=%d); %d decode errors; %d server-shutdowns",
            "events", "agg_trades", "book_tickers", "klines", "decode_errors", "server_shutdowns",
        ).alias("line")
    )


def error_budget(stats: DataFrame, max_decode_errors: int = 0) -> DataFrame:
    return stats.select(
        "events", "decode_errors", F.lit(max_decode_errors).cast("bigint").alias("max_decode_errors"),
        (F.col("decode_errors") <= max_decode_errors).alias("within_budget"),
        (F.col("events") == 0).alias("no_events"),
    )


def require_error_budget(stats: DataFrame, max_decode_errors: int = 0) -> None:
    """Raise when decode errors exceed the budget (reads the single stats row)."""
    errors = stats.first()["decode_errors"]
    if errors > max_decode_errors:
        raise ValueError(f"too many undecodable frames: {errors}, at most {max_decode_errors} may occur")


def flush_manifest(lake_rows: DataFrame, table: LakeTable) -> DataFrame:
    """Offset range and row count per (log partition, lake directory)."""
    return lake_rows.groupBy("kafka_partition", *table.path_columns).agg(
        F.min("kafka_offset").alias("min_offset"),
        F.max("kafka_offset").alias("max_offset"),
        F.count("*").alias("rows"),
    )


def object_name(manifest: DataFrame) -> DataFrame:
    """Deterministic name of a flush; lexical order is offset order."""
    return manifest.withColumn(
        "object_name",
        F.concat(
            F.lit("p"), F.col("kafka_partition").cast("string"),
            F.lit("-off-"), F.lpad(F.col("min_offset").cast("string"), 20, "0"),
            F.lit("-"), F.lpad(F.col("max_offset").cast("string"), 20, "0"), F.lit(".parquet"),
        ),
    )


def commit_offsets(records: DataFrame, topic: str = "topic", partition: str = "partition", offset: str = "offset") -> DataFrame:
    """Next offset to read per (topic, partition)."""
    return records.groupBy(topic, partition).agg((F.max(offset) + 1).alias("next_offset"))


def path_counters(decoded: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Applied and dead-lettered records."""
    return decoded.groupBy(*keys).agg(
        F.count_if(F.col("error").isNull()).alias("applied"),
        F.count_if(F.col("error").isNotNull()).alias("dead_lettered"),
    )


_COUNTED = ("records", "empty_payloads", "applied", "dead_lettered")


def path_metrics(records: DataFrame, decoded: DataFrame) -> DataFrame:
    """What a path did with a batch, per topic: records, those without a value, applied, dead-lettered."""
    none = F.lit(0).cast("bigint")
    read = records.groupBy("topic").agg(F.count("*").alias("records"), F.count_if(F.col("value").isNull()).alias("empty_payloads"))
    done = path_counters(decoded, ["topic"])
    both = read.select("*", none.alias("applied"), none.alias("dead_lettered")).unionByName(
        done.select("*", none.alias("records"), none.alias("empty_payloads")))
    return both.groupBy("topic").agg(*[F.sum(c).alias(c) for c in _COUNTED])


def total_metrics(batches: DataFrame) -> DataFrame:
    """Totals per path and topic over all batches."""
    return batches.groupBy("path", "topic").agg(*[F.sum(c).alias(c) for c in _COUNTED])


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("n"))


# Ranges that a count of values is cut into.
_RANGES = 4096


def middle_value(rows: DataFrame, column: str) -> int | None:
    """The lower median of whole numbers, as ``percentile_disc(0.5)`` gives it; None without values.

    Values are counted by range, then the range that holds the middle is cut again: a few
    counts of at most ``_RANGES`` groups, where a percentile would hold every value in one task.
    """
    value = F.col(column)
    lowest, highest, total = rows.agg(F.min(value), F.max(value), F.count(value)).first()
    before, wanted = 0, (total + 1) // 2
    while total and lowest < highest:
        width = -(-(highest - lowest + 1) // _RANGES)
        within = rows.filter(value.between(F.lit(lowest), F.lit(highest)))
        counts = within.groupBy(F.floor((value - F.lit(lowest)) / F.lit(width)).alias("_range")).count().orderBy("_range")
        for number, count in counts.collect():
            if before + count >= wanted:
                break
            before += count
        lowest = lowest + number * width
        highest = min(highest, lowest + width - 1)
    return lowest
