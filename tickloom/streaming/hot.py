"""Hot path: topic records to live tables and their changes."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.market import composite_key
from tickloom.operators.decode import decode_envelopes, for_sinks
from tickloom.operators.encode import dead_letters
from tickloom.operators.latest import CHANGE, apply_changes, changes_between, upsert_arrivals
from tickloom.schemas import (
    AGG_TRADE, BATCH_COLUMN, BOOK_TICKER, KLINE, LIVE_BOOK_TICKER, LIVE_KLINE, LIVE_KLINE_SECOND, LIVE_TRADE, WINDOW_KEEP, WINDOW_SLACK,
)
from tickloom.sources.layout import children
from tickloom.streaming.cold import DeadLetterSink
from tickloom.streaming.live_window import window_changes, with_keyed_state
from tickloom.streaming.metrics import record_metrics
from tickloom.streaming.sinks import query_id, write_records
from tickloom.streaming.snapshots import Snapshot


def _arrivals(decoded: DataFrame, kind: str) -> DataFrame:
    return decoded.filter(F.col("kind") == kind).select(
        F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), f"{kind}.*"
    )


def trade_arrivals(decoded: DataFrame) -> DataFrame:
    """The last trade to arrive per symbol counts; trade times are not compared."""
    return _arrivals(decoded, AGG_TRADE)


def book_ticker_arrivals(decoded: DataFrame) -> DataFrame:
    return _arrivals(decoded, BOOK_TICKER)


def candle_arrivals(decoded: DataFrame) -> DataFrame:
    """The last candle to arrive per series counts, even if an older candle is re-sent."""
    candles = _arrivals(decoded, KLINE).withColumnRenamed("interval", "bar_interval")
    return candles.withColumn("id", composite_key(F.col("symbol"), F.col("bar_interval")))


class LiveTables:
    """The four live tables under one root. A new checkpoint goes on from the newest state.

    With a ``feed`` folder every batch also leaves the rows it changed, per table and
    batch (see ``read_feed``): inserts and updates whole, deletes by key.
    """

    def __init__(
        self, spark: SparkSession, root: str, keep: int = WINDOW_KEEP, slack: int = WINDOW_SLACK, feed: str | None = None
    ):
        self.trade = Snapshot(spark, root, "live_trade", LIVE_TRADE)
        self.book_ticker = Snapshot(spark, root, "live_book_ticker", LIVE_BOOK_TICKER)
        self.kline = Snapshot(spark, root, "live_kline", LIVE_KLINE)
        self.kline_second = Snapshot(spark, root, "live_kline_second", LIVE_KLINE_SECOND)
        self.keep, self.slack, self._feed, self._spark = keep, slack, feed, spark

    def apply(self, decoded: DataFrame, batch_id: int, writer: str = "direct") -> None:
        """Move the tables of latest rows one version on, at the same time."""
        moves = (
            (self.trade, trade_arrivals(decoded), ["symbol"]),
            (self.book_ticker, book_ticker_arrivals(decoded), ["symbol"]),
            (self.kline, candle_arrivals(decoded), ["symbol", "bar_interval"]),
        )
        with ThreadPoolExecutor(len(moves)) as pool:
            # Threads keep the properties of this one, the streaming query's id among them.
            move = inheritable_thread_target(self._spark)(self._upsert)
            for done in [pool.submit(move, *m, batch_id, writer) for m in moves]:
                done.result()

    def _upsert(self, snapshot: Snapshot, arrivals: DataFrame, keys: list[str], batch_id: int, writer: str) -> None:
        before = snapshot.before(batch_id, writer)
        after = snapshot.write(upsert_arrivals(before, arrivals, keys), batch_id, writer)
        self._tell(snapshot, changes_between(before, after, keys), batch_id, writer)

    def apply_window(self, changes: DataFrame, batch_id: int, writer: str = "direct") -> None:
        """Move the rolling window one version on by the changes its keyed state gave."""
        changes.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        changes = changes.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = self.kline_second.before(batch_id, writer)
            self.kline_second.write(apply_changes(before, changes, ["symbol", "open_time"]), batch_id, writer)
            self._tell(self.kline_second, changes, batch_id, writer)
        finally:
            changes.unpersist()

    def _tell(self, snapshot: Snapshot, changes: DataFrame, batch_id: int, writer: str) -> None:
        if self._feed:
            write_records(changes, f"{self._feed}/{snapshot.name}", batch_id, writer)

    def read_feed(self, snapshot: Snapshot) -> DataFrame:
        """All changes of a table with the ``batch`` of its writer that made them."""
        schema = T.StructType([
            *[T.StructField(f.name, f.dataType) for f in snapshot.schema.fields],
            T.StructField(CHANGE, T.StringType()), T.StructField(BATCH_COLUMN, T.StringType())])
        rows = self._spark.read.schema(schema).parquet(f"{self._feed}/{snapshot.name}")
        return rows.withColumn("batch", F.regexp_extract(BATCH_COLUMN, "([0-9]+)$", 1).cast("bigint"))

    def register_views(self, spark: SparkSession) -> None:
        """Temp views over the newest versions, for ad-hoc SQL."""
        self.trade.read().createOrReplaceTempView("live_trade")
        self.book_ticker.read().createOrReplaceTempView("live_book_ticker")
        self.kline.read().createOrReplaceTempView("live_kline")
        self.kline_second.read().createOrReplaceTempView("live_kline_second")


def hot_batch(
    records: DataFrame,
    batch_id: int,
    tables: LiveTables,
    dead_letter_sink: DeadLetterSink,
    strict_version: bool = False,
    writer: str = "direct",
    metrics: str | None = None,
) -> None:
    records.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
    decoded = for_sinks(decode_envelopes(records, strict_version)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        dead_letter_sink(dead_letters(decoded, "hot"), batch_id, writer)
        tables.apply(decoded, batch_id, writer)
        record_metrics(metrics, "hot", records, decoded, batch_id, writer)
    finally:
        decoded.unpersist()


def _trigger(available_now: bool, trigger_seconds: int) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": f"{trigger_seconds} seconds"}


def start_hot_path(
    records: DataFrame,
    tables: LiveTables,
    checkpoint: str,
    dead_letter_sink: DeadLetterSink,
    *,
    available_now: bool = False,
    trigger_seconds: int = 1,
    strict_version: bool = False,
    metrics: str | None = None,
) -> StreamingQuery:
    """The tables of latest rows. The rolling window has a query of its own (``start_window_path``)."""
    observed = records.observe(
        "hot_path", F.count("*").alias("records"), F.count_if(F.col("value").isNull()).alias("empty_payloads")
    )
    return (
        observed.writeStream.queryName("hot_path")
        .foreachBatch(
            lambda batch, batch_id: hot_batch(
                batch, batch_id, tables, dead_letter_sink, strict_version, query_id(batch), metrics))
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(available_now, trigger_seconds))
        .start()
    )


def _known_writer(spark: SparkSession, checkpoint: str) -> str | None:
    """Id of the query a checkpoint belongs to, if it has run before."""
    if "metadata" not in children(spark, checkpoint):
        return None
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()["value"])["id"]


def start_window_path(
    records: DataFrame,
    tables: LiveTables,
    checkpoint: str,
    *,
    available_now: bool = False,
    trigger_seconds: int = 1,
    strict_version: bool = False,
) -> StreamingQuery:
    """The rolling window from keyed state. A new checkpoint starts from what the table holds.

    Undecodable records are parked by the hot path, which reads the same topics.
    """
    spark = records.sparkSession
    writer = _known_writer(spark, checkpoint)
    held = tables.kline_second.read() if writer is None else tables.kline_second.before(0, writer)
    changes = window_changes(records, held, tables.keep, tables.slack, strict_version)
    with with_keyed_state(spark):
        return (
            changes.writeStream.queryName("window_path").outputMode("update")
            .foreachBatch(lambda batch, batch_id: tables.apply_window(batch, batch_id, query_id(batch)))
            .option("checkpointLocation", checkpoint)
            .trigger(**_trigger(available_now, trigger_seconds))
            .start()
        )


def latest_stream(records: DataFrame, kind: str, keys: list[str]) -> DataFrame:
    """Latest state of one kind as a streaming aggregate, for update-mode subscribers.

    State is one row per key; there is no watermark, late rows are never dropped.
    """
    arrivals = _arrivals(decode_envelopes(records), kind)
    values = [c for c in arrivals.columns if c not in keys]
    return (
        arrivals.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), F.struct("kafka_partition", "kafka_offset")).alias("_row"))
        .select(*keys, "_row.*")
    )
