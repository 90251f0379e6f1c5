"""Topic source: the three event topics as one stream of keyed records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.schemas import BOOK_TICKERS_TOPIC, KLINES_TOPIC, TOPIC_RECORD, TRADES_TOPIC

ALL_TOPICS = (TRADES_TOPIC, BOOK_TICKERS_TOPIC, KLINES_TOPIC)


def stream_topics(
    spark: SparkSession,
    brokers: str,
    topics: tuple[str, ...] = ALL_TOPICS,
    max_offsets_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Live topics from the earliest offset; each query keeps its own position.

    Needs the Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("includeHeaders", "true")
        .options(**options)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def stream_topic_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same columns from landed Parquet files."""
    reader = spark.readStream.schema(TOPIC_RECORD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def read_topic_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC_RECORD).parquet(path)
