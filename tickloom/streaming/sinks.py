"""Sinks that may be repeated: writing one micro-batch twice leaves one copy."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from tickloom.schemas import BATCH_COLUMN, LakeTable
from tickloom.sources.lake import table_path
from tickloom.sources.layout import with_grain


# Offsets of a directory that one task writes to one file.
CHUNK_OFFSETS = 1_000_000


def query_id(batch: DataFrame) -> str:
    """The streaming query a micro-batch belongs to; its id is kept in the checkpoint."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("not inside a micro-batch of a streaming query")
    return found


def flush_name(batch_id: int, writer: str) -> str:
    return f"{writer}-{batch_id}"


def write_lake(rows: DataFrame, root: str, table: LakeTable, batch_id: int, writer: str = "direct") -> None:
    """Write one micro-batch of a lake table.

    Below the path columns lies a directory per day, or per id range of the flush where
    the table has no time (see ``sources.layout``). The innermost directory names the
    writer and its batch, and only directories of that flush are replaced: a batch run
    again leaves one copy, while a query with a new checkpoint, a backfill or a rewrite
    never meets another one's batch ids. The rows of a directory are dealt together, in
    chunks of ``CHUNK_OFFSETS`` offsets: a small flush has one file per directory, a
    directory that holds a large share of the batch is split over tasks, and many
    directories are written side by side however few their rows. Rows are sorted within
    a file, so its statistics can skip row groups.
    """
    directories = [*table.path_columns, table.grain_column]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        with_grain(rows.select(table.schema.names), table)
        .withColumn(BATCH_COLUMN, F.lit(flush_name(batch_id, writer)))
        .repartition(tasks, *directories, F.expr(f"kafka_offset DIV {CHUNK_OFFSETS}"))
        .sortWithinPartitions(*directories, BATCH_COLUMN, table.order_column, "kafka_offset")
        .select(*table.schema.names, table.grain_column, BATCH_COLUMN)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        # Tasks move their own files within the staging folder, of which nothing shows before the job is committed.
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .partitionBy(*directories, BATCH_COLUMN)
        .parquet(table_path(root, table))
    )


def write_tables(rows: Mapping[LakeTable, DataFrame], root: str, batch_id: int, writer: str = "direct") -> None:
    """One flush of several lake tables, written at the same time. All writes end before a failure is raised."""
    spark = next(iter(rows.values())).sparkSession
    with ThreadPoolExecutor(len(rows)) as pool:
        # Threads keep the properties of this one, the streaming query's id among them.
        write = inheritable_thread_target(spark)(write_lake)
        started = [pool.submit(write, df, root, table, batch_id, writer) for table, df in rows.items()]
    for done in started:
        done.result()


def write_records(records: DataFrame, path: str, batch_id: int, writer: str = "direct") -> None:
    """Topic-shaped records as files, one directory per writer and batch."""
    (
        records.withColumn(BATCH_COLUMN, F.lit(flush_name(batch_id, writer)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH_COLUMN)
        .parquet(path)
    )


def write_topic(records: DataFrame, brokers: str, **options: str) -> None:
    """Produce keyed records; the key keeps one symbol in one partition.

    Needs the Kafka connector on the class path.
    """
    columns = [c for c in ("key", "value", "topic", "headers") if c in records.columns]
    (
        records.select(*columns).write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("includeHeaders", "true")
        .options(**options)
        .save()
    )


def record_frames(frames: DataFrame, path: str) -> None:
    """Record raw frames one per line, starting over."""
    frames.select("value").write.mode("overwrite").text(path)


def discard(df: DataFrame) -> None:
    """Run the plan and keep nothing: decode-only replay."""
    df.write.format("noop").mode("overwrite").save()
