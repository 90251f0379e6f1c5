"""Cold path: topic records to the lake, undecodable ones to the dead letters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.decode import decode_envelopes, for_sinks, lake_rows
from tickloom.operators.encode import dead_letters
from tickloom.operators.stats import flush_manifest, object_name
from tickloom.schemas import FLUSH_SECONDS, LAKE_TABLES
from tickloom.streaming.metrics import record_metrics
from tickloom.streaming.sinks import query_id, write_records, write_tables

DeadLetterSink = Callable[[DataFrame, int, str], None]


def dead_letter_files(path: str) -> DeadLetterSink:
    return lambda records, batch_id, writer: write_records(records, path, batch_id, writer)


def cold_batch(
    records: DataFrame,
    batch_id: int,
    lake_root: str,
    dead_letter_sink: DeadLetterSink,
    strict_version: bool = False,
    writer: str = "direct",
    metrics: str | None = None,
) -> None:
    """One flush. Dead letters are parked before the batch can be committed.

    The batch is decoded once and kept for its writes; the lake tables are written
    together. Any failed write fails the batch, so the position does not move and the
    batch is run again.
    """
    records.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
    decoded = for_sinks(decode_envelopes(records, strict_version)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        dead_letter_sink(dead_letters(decoded, "cold"), batch_id, writer)
        write_tables({table: lake_rows(decoded, table) for table in LAKE_TABLES}, lake_root, batch_id, writer)
        record_metrics(metrics, "cold", records, decoded, batch_id, writer)
    finally:
        decoded.unpersist()


def start_cold_path(
    records: DataFrame,
    lake_root: str,
    checkpoint: str,
    dead_letter_sink: DeadLetterSink,
    *,
    available_now: bool = False,
    flush_seconds: int = FLUSH_SECONDS,
    strict_version: bool = False,
    metrics: str | None = None,
) -> StreamingQuery:
    """Flush every ``flush_seconds``; the source's rate limit bounds a flush by size.

    ``metrics`` is a folder for the counters of each batch (``streaming.metrics``).
    """
    observed = records.observe(
        "cold_path", F.count("*").alias("records"), F.count_if(F.col("value").isNull()).alias("empty_payloads")
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{flush_seconds} seconds"}
    return (
        observed.writeStream.queryName("cold_path")
        .foreachBatch(
            lambda batch, batch_id: cold_batch(
                batch, batch_id, lake_root, dead_letter_sink, strict_version, query_id(batch), metrics))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def batch_manifest(decoded: DataFrame) -> DataFrame:
    """What a flush of ``decoded`` writes, over all lake tables."""
    parts = []
    for table in LAKE_TABLES:
        manifest = object_name(flush_manifest(lake_rows(decoded, table), table)).withColumn("topic", F.lit(table.topic))
        if "interval" not in manifest.columns:
            manifest = manifest.withColumn("interval", F.lit(None).cast("string"))
        parts.append(manifest)
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
