"""Directories of the lake below a series: days, or id ranges of flushes.

A table with a time has one directory per UTC day, so a read of a time window or of the
newest rows names the days it needs. A table without one has a directory per flush whose
name holds the flush's smallest and largest id and its number of rows: the names alone
tell which flushes can hold the newest rows. Both are read from one listing of a series.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.schemas import DAY_COLUMN, SPAN_COLUMN, LakeTable

DAY_MS = 86_400_000
_EPOCH = date(1970, 1, 1)
# Times beyond the calendar lie in its first and last day: they sort as they did before.
_FIRST_DAY, _LAST_DAY = (date.min - _EPOCH).days, (date.max - _EPOCH).days


def event_day(ms: Column) -> Column:
    """UTC day of an epoch time in milliseconds, defined for every long."""
    number = F.floor(ms / F.lit(DAY_MS))
    return F.date_from_unix_date(F.greatest(F.lit(_FIRST_DAY), F.least(F.lit(_LAST_DAY), number)).cast("int"))


def day_of(ms: int) -> date:
    return _EPOCH + timedelta(days=max(_FIRST_DAY, min(_LAST_DAY, ms // DAY_MS)))


class Span(NamedTuple):
    first: int
    last: int
    rows: int

    @property
    def name(self) -> str:
        return f"{self.first}_{self.last}_{self.rows}"


def parse_span(name: str) -> Span:
    return Span(*map(int, name.split("_")))


def with_grain(rows: DataFrame, table: LakeTable) -> DataFrame:
    """Rows with the value of their directory below the path columns."""
    if table.time_column is not None:
        return rows.withColumn(DAY_COLUMN, event_day(F.col(table.time_column)))
    order = F.col(table.order_column)
    ranges = rows.groupBy(*table.path_columns).agg(
        F.concat_ws("_", F.min(order).cast("string"), F.max(order).cast("string"), F.count("*").cast("string")).alias(SPAN_COLUMN))
    return rows.join(ranges, list(table.path_columns))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory, from one listing that does not descend; none if it is absent."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    filesystem = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not filesystem.exists(folder):
        return []
    # All paths as one text: a call per entry would take longer than the listing.
    parent = filesystem.makeQualified(folder).toString().rstrip("/") + "/"
    paths = hadoop.FileUtil.stat2Paths(filesystem.listStatus(folder))
    listed = spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(paths)[1:-1]
    return [name for name in f",{listed}".split(f",{parent}") if name]


def days_in(names: Iterable[str]) -> list[date]:
    """Days of a series directory, newest first."""
    prefix = f"{DAY_COLUMN}="
    return sorted((date.fromisoformat(n[len(prefix):]) for n in names if n.startswith(prefix)), reverse=True)


def spans_in(names: Iterable[str]) -> list[Span]:
    """Id ranges of a series directory, that of the largest id first."""
    prefix = f"{SPAN_COLUMN}="
    return sorted((parse_span(n[len(prefix):]) for n in names if n.startswith(prefix)), key=lambda s: (s.last, s.first), reverse=True)


def newest_spans(spans: list[Span], count: int, at_most: int | None = None) -> list[Span]:
    """The flushes that hold the ``count`` largest ids, or all that may; at or below ``at_most`` if given.

    Flushes are taken by their largest id until enough rows are known to lie above every
    id of the rest. Only a flush wholly above that bound and below ``at_most`` counts.
    """
    open_ = [s for s in spans if at_most is None or s.first <= at_most]
    for taken in range(1, len(open_)):
        bound = open_[taken].last
        sure = sum(s.rows for s in open_[:taken] if s.first > bound and (at_most is None or s.last < at_most))
        if sure >= count:
            return open_[:taken]
    return open_
