"""Counters of the running paths as a table: one row per path, topic and batch.

They are counted from what the batch decoded and are written under the batch's name, so a
batch that runs again leaves one count, and counters outlive the query and its restarts.
Rows per second are in the query's own progress.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from tickloom.operators.stats import path_metrics
from tickloom.schemas import BATCH_COLUMN
from tickloom.streaming.sinks import write_records

_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in ("records", "empty_payloads", "applied", "dead_lettered")],
    T.StructField("path", T.StringType()), T.StructField(BATCH_COLUMN, T.StringType())])


def record_metrics(metrics: str | None, path: str, records: DataFrame, decoded: DataFrame, batch_id: int, writer: str) -> None:
    if metrics:
        write_records(path_metrics(records, decoded).coalesce(1), f"{metrics}/path={path}", batch_id, writer)


def read_metrics(spark: SparkSession, metrics: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(metrics)
