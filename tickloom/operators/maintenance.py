"""Lake upkeep: compaction, retention, date layout, to a new root or in place.

In place, what a running stream writes is never touched: it adds directories of its own
flushes, and only directories that were there when an upkeep began are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.schemas import BATCH_COLUMN, DAY_COLUMN, LakeTable
from tickloom.session import new_work_dir
from tickloom.sources.lake import read_table, read_with_directories, table_path
from tickloom.sources.layout import DAY_MS, children, day_of, days_in
from tickloom.streaming.sinks import write_lake


_REWRITE = "rewrite"


def rewrite_name() -> str:
    """A writer name of its own, so a rewrite never replaces a flush of a stream."""
    return f"{_REWRITE}{uuid.uuid4().hex}"


def compact(spark: SparkSession, root: str, new_root: str, table: LakeTable, batch_id: int = 0) -> None:
    """Rewrite a table's many small files as few large ones; the rows stay the same.

    Directories are packed to the advisory partition size and large ones split.
    """
    write_lake(read_table(spark, root, table), new_root, table, batch_id, rewrite_name())


def retain_since(rows: DataFrame, table: LakeTable, cutoff_ms: int) -> DataFrame:
    """Rows at or after the cutoff; tables without a time keep everything."""
    if table.time_column is None:
        return rows
    return rows.filter(F.col(table.time_column) >= F.lit(cutoff_ms))


def apply_retention(
    spark: SparkSession, root: str, new_root: str, table: LakeTable, cutoff_ms: int, batch_id: int = 0
) -> None:
    kept = retain_since(read_table(spark, root, table), table, cutoff_ms)
    write_lake(kept, new_root, table, batch_id, rewrite_name())


def with_event_date(rows: DataFrame, table: LakeTable) -> DataFrame:
    """Add ``event_date``, the UTC day of the table's time column."""
    if table.time_column is None:
        raise ValueError(f"{table.topic} has no event time")
    return rows.withColumn("event_date", F.to_date(F.timestamp_millis(F.col(table.time_column))))


def write_by_date(rows: DataFrame, root: str, table: LakeTable) -> None:
    """A copy of the table with a day directory below its path columns."""
    (
        with_event_date(rows, table).hint("rebalance", *table.path_columns, "event_date")
        .write.mode("overwrite").partitionBy(*table.path_columns, "event_date").parquet(table_path(root, table))
    )


def read_by_date(spark: SparkSession, root: str, table: LakeTable, first: str, last: str) -> DataFrame:
    """Days ``first`` to ``last`` inclusive; other directories are not read."""
    schema = T.StructType([*table.schema.fields, T.StructField("event_date", T.DateType())])
    return (
        spark.read.schema(schema).parquet(table_path(root, table))
        .filter(F.col("event_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    )


# --- In place -----------------------------------------------------------------

_PENDING = "_compactions"


def _hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _delete(spark: SparkSession, path: str) -> None:
    filesystem, folder = _hadoop(spark, path)
    filesystem.delete(folder, True)


def _below(spark: SparkSession, path: str, prefix: str) -> list[str]:
    return [f"{path}/{name}" for name in children(spark, path) if name.startswith(prefix)]


def series_directories(spark: SparkSession, root: str, table: LakeTable) -> list[str]:
    """The directory of every series that has data."""
    found = [table_path(root, table)]
    for column in table.path_columns:
        found = [child for path in found for child in _below(spark, path, f"{column}=")]
    return found


def flush_directories(spark: SparkSession, series: str, table: LakeTable, settled: date | None) -> dict[str, list[str]]:
    """Flush directories of a series by what they may be merged to: a day below ``settled``, or the series."""
    if table.time_column is None:
        spans = _below(spark, series, f"{table.grain_column}=")
        return {series: [flush for span in spans for flush in _below(spark, span, f"{BATCH_COLUMN}=")]}
    days = [f"{series}/{DAY_COLUMN}={d}" for d in days_in(children(spark, series)) if settled is None or d < settled]
    return {day: _below(spark, day, f"{BATCH_COLUMN}=") for day in days}


def _writer_and_batch(flush: str) -> tuple[str, int]:
    writer, batch_id = flush.rsplit("=", 1)[1].rsplit("-", 1)
    return writer, int(batch_id)


def _newest_of_each_writer(flushes: Iterable[str]) -> set[tuple[str, int]]:
    newest: dict[str, int] = {}
    for writer, batch_id in map(_writer_and_batch, flushes):
        if not writer.startswith(_REWRITE):
            newest[writer] = max(batch_id, newest.get(writer, batch_id))
    return set(newest.items())


def compact_in_place(
    spark: SparkSession, root: str, table: LakeTable, *, settled_ms: int | None = None, least_flushes: int = 2
) -> int:
    """Merge the flushes of each day, or of a series without a time; returns the flushes replaced.

    Only days before that of ``settled_ms`` are merged, if it is given, and only where
    there are ``least_flushes``. The newest batch of each stream stays as it is: it may
    not be committed yet, and would be written again. The merged files are written to a hidden folder first,
    then a plan of what replaces what; from then on a run that ends early is gone on with
    by the next one (``finish_compactions``), and one that ends before has changed nothing.
    A reader that lists a series while its flushes are replaced may see their rows twice
    or miss a file; one that lists before or after sees each row once.
    """
    finish_compactions(spark, root, table)
    settled = None if settled_ms is None else day_of(settled_ms)
    found = [
        flushes for series in series_directories(spark, root, table)
        for flushes in flush_directories(spark, series, table, settled).values()]
    open_ = _newest_of_each_writer(flush for flushes in found for flush in flushes)
    closed = [[f for f in flushes if _writer_and_batch(f) not in open_] for flushes in found]
    groups = [flushes for flushes in closed if len(flushes) >= least_flushes]
    replaced = [flush for flushes in groups for flush in flushes]
    if not replaced:
        return 0
    name, pending = rewrite_name(), f"{table_path(root, table)}/{_PENDING}"
    staged = f"{pending}/{name}-staged"
    rows = read_with_directories(spark, root, table, replaced).select(table.schema.names)
    write_lake(rows, staged, table, 0, name)
    # The plan counts once it is whole, which its _SUCCESS tells.
    plan = spark.createDataFrame([(path,) for path in replaced], "replaced string")
    plan.coalesce(1).write.parquet(f"{pending}/{name}")
    _finish(spark, root, table, name)
    return len(replaced)


def finish_compactions(spark: SparkSession, root: str, table: LakeTable) -> None:
    """End compactions that were cut off: those with a whole plan are done, others undone."""
    pending = f"{table_path(root, table)}/{_PENDING}"
    names = children(spark, pending)
    for name in names:
        if not name.endswith("-staged") and "_SUCCESS" in children(spark, f"{pending}/{name}"):
            _finish(spark, root, table, name)
    for name in children(spark, pending):
        _delete(spark, f"{pending}/{name}")


def _finish(spark: SparkSession, root: str, table: LakeTable, name: str) -> None:
    """Move the merged flushes into place and drop those they replace. Every step may be repeated."""
    target, pending = table_path(root, table), f"{table_path(root, table)}/{_PENDING}"
    replaced = [r["replaced"] for r in spark.read.parquet(f"{pending}/{name}").collect()]
    staged = table_path(f"{pending}/{name}-staged", table)
    for series in series_directories(spark, f"{pending}/{name}-staged", table):
        for grain in _below(spark, series, f"{table.grain_column}="):
            for flush in _below(spark, grain, f"{BATCH_COLUMN}="):
                filesystem, source = _hadoop(spark, flush)
                _, destination = _hadoop(spark, f"{target}{flush[len(staged):]}")
                filesystem.mkdirs(destination.getParent())
                if not filesystem.exists(destination) and not filesystem.rename(source, destination):
                    raise OSError(f"could not move {source} to {destination}")
    _drop(spark, replaced, table)
    _delete(spark, f"{pending}/{name}")
    _delete(spark, f"{pending}/{name}-staged")


def _drop(spark: SparkSession, flushes: Iterable[str], table: LakeTable) -> None:
    """Delete flush directories, and id ranges that are then empty."""
    for flush in flushes:
        _delete(spark, flush)
        filesystem, folder = _hadoop(spark, flush)
        parent = folder.getParent()
        if table.time_column is None and filesystem.exists(parent) and not filesystem.listStatus(parent):
            filesystem.delete(parent, False)


def drop_before(spark: SparkSession, root: str, table: LakeTable, cutoff_ms: int) -> None:
    """Remove rows before the cutoff in place: whole days as directories, of the cutoff's day the rows.

    The flushes of that one day are written anew, each in its own directory; all newer
    days stay as they are. A table without a time keeps everything.
    """
    if table.time_column is None:
        return
    border_day, border, inside = day_of(cutoff_ms), [], cutoff_ms % DAY_MS != 0
    for series in series_directories(spark, root, table):
        for day in days_in(children(spark, series)):
            if day < border_day:
                _delete(spark, f"{series}/{DAY_COLUMN}={day}")
            elif day == border_day and inside:
                border.append(f"{series}/{DAY_COLUMN}={day}")
    if not border:
        return
    before = {flush: set(children(spark, flush)) for day in border for flush in _below(spark, day, f"{BATCH_COLUMN}=")}
    kept_path = new_work_dir(spark, "retention")
    rows = read_with_directories(spark, root, table, list(before))
    retain_since(rows, table, cutoff_ms).write.parquet(kept_path)
    directories = [*table.path_columns, DAY_COLUMN, BATCH_COLUMN]
    (
        spark.read.schema(rows.schema).parquet(kept_path).hint("rebalance", *directories)
        .sortWithinPartitions(*directories, table.order_column, "kafka_offset")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*directories).parquet(table_path(root, table))
    )
    # A flush that still has its old files kept no row.
    for flush, names in before.items():
        if {n for n in names if n.endswith(".parquet")} & set(children(spark, flush)):
            _delete(spark, flush)
