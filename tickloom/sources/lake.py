"""Hive-partitioned Parquet lake: explicit schemas, narrow listings, days, freshness."""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.schemas import BATCH_COLUMN, DAY_COLUMN, LISTING_TTL_MS, LakeTable
from tickloom.sources.layout import children, day_of, days_in

# Values whose directory name is the value itself, unescaped.
_PLAIN = re.compile(r"[A-Za-z0-9_-]+")


def table_path(root: str, table: LakeTable) -> str:
    return f"{root.rstrip('/')}/{table.topic}"


def _listed_path(root: str, table: LakeTable, wanted: dict[str, str | None]) -> str:
    """Deepest directory that holds every wanted row."""
    path = table_path(root, table)
    for column in table.path_columns:
        value = wanted.get(column)
        if value is None or not _PLAIN.fullmatch(value):
            break
        path = f"{path}/{column}={value}"
    return path


def empty_table(spark: SparkSession, table: LakeTable) -> DataFrame:
    return spark.createDataFrame([], table.schema)


def _table_schema(table: LakeTable) -> T.StructType:
    """Columns of the rows and of all directories. Path values are never inferred."""
    grain = T.DateType() if table.time_column else T.StringType()
    return T.StructType([
        *table.schema.fields, T.StructField(table.grain_column, grain), T.StructField(BATCH_COLUMN, T.StringType())])


def read_with_directories(spark: SparkSession, root: str, table: LakeTable, paths: Sequence[str] | None = None) -> DataFrame:
    """A table, or these directories of it, with the columns its directories are named by."""
    paths = [table_path(root, table)] if paths is None else paths
    try:
        return spark.read.schema(_table_schema(table)).option("basePath", table_path(root, table)).parquet(*paths)
    except AnalysisException as error:
        # One of several directories that went away since they were listed is not "no data".
        if error.getCondition() != "PATH_NOT_FOUND" or len(paths) > 1:
            raise
        return spark.createDataFrame([], _table_schema(table))


def series_path(root: str, table: LakeTable, symbol: str | None, interval: str | None = None) -> str | None:
    """The directory of one series, whose children are days or id ranges; None if more than one is meant."""
    wanted = {"symbol": symbol, "interval": interval}
    if all(wanted[c] is not None and _PLAIN.fullmatch(wanted[c]) for c in table.path_columns):
        return _listed_path(root, table, wanted)
    return None


def read_table(
    spark: SparkSession,
    root: str,
    table: LakeTable,
    symbol: str | None = None,
    interval: str | None = None,
    *,
    time_range: tuple[int, int] | None = None,
) -> DataFrame:
    """One lake table, optionally one symbol or series of it, optionally one window of time.

    With a symbol only that directory is listed, so the listing does not grow with the
    rest of the lake. ``time_range`` (inclusive, in milliseconds) reads only the days it
    touches, and of a series lists only those. A table without data yet is empty.
    """
    wanted = {"symbol": symbol, "interval": interval}
    if time_range is not None and table.time_column is None:
        raise ValueError(f"{table.topic} has no event time")
    series, paths = series_path(root, table, symbol, interval), [_listed_path(root, table, wanted)]
    conditions = [F.col(c) == F.lit(wanted[c]) for c in table.path_columns if wanted[c] is not None]
    if time_range is not None:
        first, last = map(day_of, time_range)
        if series is not None:
            days = [d for d in days_in(children(spark, series)) if first <= d <= last]
            paths = [f"{series}/{DAY_COLUMN}={d}" for d in days]
        conditions += [
            F.col(DAY_COLUMN).between(*[F.lit(d.isoformat()).cast("date") for d in (first, last)]),
            F.col(table.time_column).between(F.lit(time_range[0]), F.lit(time_range[1]))]
    if not paths:
        return empty_table(spark, table)
    df = read_with_directories(spark, root, table, paths)
    if conditions:
        df = df.filter(reduce(lambda left, right: left & right, conditions))
    return df.select(table.schema.names)


def read_grains(spark: SparkSession, root: str, table: LakeTable, symbol: str, interval: str | None, grains: Sequence[object]) -> DataFrame:
    """These days or id ranges of one series."""
    series = series_path(root, table, symbol, interval)
    if not grains:
        return empty_table(spark, table)
    return read_with_directories(
        spark, root, table, [f"{series}/{table.grain_column}={getattr(g, 'name', g)}" for g in grains]).select(table.schema.names)


def is_stale(last_ms: int | None, ttl_ms: int, now_ms: int) -> bool:
    """Never listed is always stale; a TTL of 0 means every query."""
    return last_ms is None or now_ms - last_ms >= ttl_ms


class LakeReader:
    """Reuses a listing until it is ``ttl_ms`` old, then lists again.

    A failed refresh keeps serving the previous listing.
    """

    def __init__(self, spark: SparkSession, root: str, ttl_ms: int = LISTING_TTL_MS):
        self._spark = spark
        self._root = root
        self._ttl_ms = ttl_ms
        self._listed: dict[tuple, tuple[int, DataFrame]] = {}

    def table(self, table: LakeTable, symbol: str | None = None, interval: str | None = None) -> DataFrame:
        key = (table.topic, symbol, interval)
        now = int(time.time() * 1000)
        last, df = self._listed.get(key, (None, None))
        if is_stale(last, self._ttl_ms, now):
            try:
                df = read_table(self._spark, self._root, table, symbol, interval)
            except Exception:
                if df is None:
                    raise
            else:
                self._listed[key] = (now, df)
        return df
