"""Newest-first pages that read only the newest directories of a series.

The rows of a day are all newer than those of the days before it, so a page needs the
newest days alone, as many as it takes to fill it: the newest one is looked into first, and
then as many as its rows make likely to do, until the rows asked for are there. A table without a time is cut to
the flushes whose id ranges can hold the page; their names tell. Pages have the rows and
the order of ``plans.queries``; a call that leaves the series open reads the whole table.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tickloom.functions.market import page_size
from tickloom.plans import queries
from tickloom.plans.queries import Cursor
from tickloom.schemas import BOOK_TICKERS, CANDLE_LIMIT, KLINES, TRADE_SEED_LIMIT, TRADES, WINDOW_INTERVAL, LakeTable
from tickloom.sources.lake import read_grains, read_table, series_path
from tickloom.sources.layout import children, day_of, days_in, newest_spans, spans_in


def _days(spark: SparkSession, root: str, table: LakeTable, symbol: str, interval: str | None, last_ms: int | None) -> list[date]:
    days = days_in(children(spark, series_path(root, table, symbol, interval)))
    return days if last_ms is None else [d for d in days if d <= day_of(last_ms)]


def newest_days(
    spark: SparkSession, root: str, table: LakeTable, symbol: str, interval: str | None, count: int,
    wanted: Callable[[DataFrame], DataFrame], last_ms: int | None = None,
) -> DataFrame:
    """Rows of the newest days that hold ``count`` wanted rows at or before ``last_ms``, or of all days."""
    days, taken = _days(spark, root, table, symbol, interval, last_ms), 1
    while True:
        rows = read_grains(spark, root, table, symbol, interval, days[:taken])
        if taken >= len(days):
            return rows
        found = wanted(rows).limit(count).count()
        if found >= count:
            return rows
        taken = max(2 * taken, -(-taken * count * 5 // (4 * found)) if found else 8 * taken)


class LakePages:
    """The named reads over a lake on disk."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root

    def _narrow(self, table: LakeTable, symbol: str | None, interval: str | None = None) -> bool:
        return series_path(self._root, table, symbol, interval) is not None

    def trades(
        self, symbol: str | None = None, limit: int | None = None, *, after: Cursor | None = None, most: int | None = None
    ) -> DataFrame:
        if not self._narrow(TRADES, symbol):
            return queries.trades(read_table(self._spark, self._root, TRADES, symbol), symbol, limit, after=after, most=most)
        rows = newest_days(
            self._spark, self._root, TRADES, symbol, None, page_size(limit, most), lambda r: _below(r, "trade_time", after),
            None if after is None else after[0])
        return queries.trades(rows, symbol, limit, after=after, most=most)

    def trade_seed(self, symbol: str, limit: int = TRADE_SEED_LIMIT) -> DataFrame:
        return self.trades(symbol, limit)

    def book_tickers(
        self, symbol: str | None = None, limit: int | None = None, *, after: Cursor | None = None, most: int | None = None
    ) -> DataFrame:
        if self._narrow(BOOK_TICKERS, symbol):
            spans = spans_in(children(self._spark, series_path(self._root, BOOK_TICKERS, symbol)))
            chosen = newest_spans(spans, page_size(limit, most), None if after is None else after[0])
            rows = read_grains(self._spark, self._root, BOOK_TICKERS, symbol, None, chosen)
        else:
            rows = read_table(self._spark, self._root, BOOK_TICKERS, symbol)
        return queries.book_tickers(rows, symbol, limit, after=after, most=most)

    def klines(
        self, symbol: str | None = None, interval: str | None = None, limit: int | None = None, *, strict: bool = False,
        after: Cursor | None = None, most: int | None = None, before: int | None = None,
        time_range: tuple[int, int] | None = None, latest_only: bool = False,
    ) -> DataFrame:
        how = dict(strict=strict, after=after, most=most, before=before, time_range=time_range, latest_only=latest_only)
        if time_range is not None or not self._narrow(KLINES, symbol, interval):
            table = read_table(self._spark, self._root, KLINES, symbol, interval, time_range=time_range)
            return queries.klines(table, symbol, interval, limit, **how)
        closed, forming = self._closed_and_forming(symbol, interval, page_size(limit, most), after, before, latest_only)
        return queries.klines(closed, symbol, interval, limit, forming=forming, **how)

    def kline_pages(
        self, symbol: str, interval: str, limit: int, pages: int, *, after: Cursor | None = None
    ) -> DataFrame:
        """The closed rows of the next ``pages`` pages of ``limit`` rows, each after the last row of the one before.

        They come from one read of the days that hold them, with their ``page`` from 0, so a
        walk through a long series does not read its days anew for every page.
        """
        rows = self.klines(symbol, interval, limit * pages, after=after).filter("is_closed")
        newest_first = Window.orderBy(F.desc_nulls_last("open_time"), F.desc("kafka_partition"), F.desc("kafka_offset"))
        return rows.withColumn("page", F.floor((F.row_number().over(newest_first) - 1) / limit))

    def candles(
        self, symbol: str, interval: str = "1m", limit: int = CANDLE_LIMIT, *, after: Cursor | None = None, latest_only: bool = False
    ) -> DataFrame:
        if not self._narrow(KLINES, symbol, interval):
            table = read_table(self._spark, self._root, KLINES, symbol, interval)
            return queries.candles(table, symbol, interval, limit, after=after, latest_only=latest_only)
        closed, forming = self._closed_and_forming(symbol, interval, page_size(limit), after, None, latest_only)
        return queries.candles(closed, symbol, interval, limit, after=after, latest_only=latest_only, forming=forming)

    def live_chart(
        self, live_window: DataFrame, symbol: str, limit: int = CANDLE_LIMIT, *, after: Cursor | None = None, latest_only: bool = False
    ) -> DataFrame:
        if not self._narrow(KLINES, symbol, WINDOW_INTERVAL):
            table = read_table(self._spark, self._root, KLINES, symbol, WINDOW_INTERVAL)
            return queries.live_chart(table, live_window, symbol, limit, after=after, latest_only=latest_only)
        closed, forming = self._closed_and_forming(symbol, WINDOW_INTERVAL, page_size(limit), after, None, latest_only)
        return queries.live_chart(closed, live_window, symbol, limit, after=after, latest_only=latest_only, forming=forming)

    def _closed_and_forming(
        self, symbol: str, interval: str, count: int, after: Cursor | None, before: int | None, latest_only: bool
    ) -> tuple[DataFrame, DataFrame]:
        """Where the closed rows of a page lie, and where the newest forming one does.

        All updates of a candle lie in its day, so one row per candle may be kept day by
        day. Whether a file has a forming row is told by its statistics.
        """
        series = queries.candle_series if latest_only else lambda rows: rows
        bounds = [b for b in (None if after is None else after[0], None if before is None else before - 1) if b is not None]

        def where(count: int, is_closed: bool, last_ms: int | None, cursor: Cursor | None) -> DataFrame:
            of_kind = lambda rows: series(_before(rows, before)).filter(F.col("is_closed") == F.lit(is_closed))
            wanted = lambda rows: _below(of_kind(rows), "open_time", cursor)
            return newest_days(self._spark, self._root, KLINES, symbol, interval, count, wanted, last_ms)

        return (
            where(count, True, min(bounds, default=None), after),
            where(1, False, None if before is None else before - 1, None))


def _before(rows: DataFrame, open_time: int | None) -> DataFrame:
    return rows if open_time is None else rows.filter(F.col("open_time") < F.lit(open_time))


def _below(rows: DataFrame, column: str, cursor: Cursor | None) -> DataFrame:
    condition = queries.after_cursor(column, cursor)
    return rows if condition is None else rows.filter(condition)
