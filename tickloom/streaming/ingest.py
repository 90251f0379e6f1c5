"""Ingest path: raw frames to topic records; a bad frame is counted and dropped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.decode import decode_frames
from tickloom.operators.encode import to_topic_rows
from tickloom.operators.stats import decode_counters


def start_ingest(
    frames: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    available_now: bool = False,
    trigger_seconds: int = 1,
) -> StreamingQuery:
    """Decode, count and publish. Counters are in the query progress as ``ingest``."""
    decoded = decode_frames(frames).observe("ingest", *decode_counters())
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{trigger_seconds} seconds"}
    return (
        decoded.writeStream.queryName("ingest")
        .foreachBatch(lambda batch, batch_id: sink(to_topic_rows(batch), batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_recorder(
    frames: DataFrame, path: str, checkpoint: str, *, available_now: bool = False, trigger_seconds: int = 1
) -> StreamingQuery:
    """Record raw frames one per line while they come, each once across restarts.

    A run records to a folder of its own; its sink's log says which files count.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{trigger_seconds} seconds"}
    return (
        frames.select("value").writeStream.queryName("recorder").format("text")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
