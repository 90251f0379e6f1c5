"""The read surface: latest rows, candle pages, merged charts, live boards.

Functions take a table (a lake DataFrame or a live snapshot) and return a plan.
Sorted pages end in a total order, so a limit cuts the same rows every time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from tickloom.functions.decimals import decimals_to_text, to_lake_decimal
from tickloom.functions.market import aggressor_side, candle_direction, page_size, spread
from tickloom.operators.latest import latest_per_key, override
from tickloom.schemas import CANDLE_COLUMNS, CANDLE_LIMIT, TRADE_SEED_LIMIT, WINDOW_INTERVAL

_TIE = ("kafka_partition", "kafka_offset")
JSON_ROWS = 100_000


class AmbiguousSeries(ValueError):
    """A strict call left the symbol or interval open."""


def _where(table: DataFrame, *conditions: Column | None) -> DataFrame:
    """One filter over the conditions that were asked for."""
    wanted = [c for c in conditions if c is not None]
    return table.filter(reduce(lambda left, right: left & right, wanted)) if wanted else table


def _equals(column: str, value: str | None) -> Column | None:
    return None if value is None else F.col(column) == F.lit(value)


def _scoped(table: DataFrame, symbol: str | None, interval: str | None = None) -> DataFrame:
    return _where(table, _equals("symbol", symbol), _equals("interval", interval))


Cursor = tuple[int, int, int]


def after_cursor(column: str, cursor: Cursor | None) -> Column | None:
    """Rows below a cursor in the order of a page: (sort column, partition, offset), all descending.

    The bare comparison of the sort column can skip files and row groups.
    """
    if cursor is None:
        return None
    keys = (column, *_TIE)
    literal = F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, cursor)])
    typed = F.struct(*[F.col(k).cast("bigint").alias(k) for k in keys])
    return (F.col(column) <= F.lit(cursor[0])) & (typed < literal.cast(f"struct<{column}:bigint,kafka_partition:bigint,kafka_offset:bigint>"))


def next_cursor(page: Sequence[Row], column: str) -> Cursor | None:
    """Where the page after this one starts: its last row in page order; None at the end.

    Of a candle page only the closed rows count, the forming one is on every page.
    """
    rows = [r for r in page if r.asDict().get("is_closed", True)]
    return min(((r[column], r["kafka_partition"], r["kafka_offset"]) for r in rows), default=None)


def trades(
    table: DataFrame, symbol: str | None = None, limit: int | None = None, *, after: Cursor | None = None, most: int | None = None
) -> DataFrame:
    scoped = _where(_scoped(table, symbol), after_cursor("trade_time", after))
    newest = scoped.orderBy(F.desc_nulls_last("trade_time"), *map(F.desc, _TIE))
    return decimals_to_text(newest.limit(page_size(limit, most)))


def trade_seed(table: DataFrame, symbol: str, limit: int = TRADE_SEED_LIMIT) -> DataFrame:
    return trades(table, symbol, limit)


def book_tickers(
    table: DataFrame, symbol: str | None = None, limit: int | None = None, *, after: Cursor | None = None, most: int | None = None
) -> DataFrame:
    scoped = _where(_scoped(table, symbol), after_cursor("update_id", after))
    newest = scoped.orderBy(F.desc_nulls_last("update_id"), *map(F.desc, _TIE))
    return decimals_to_text(newest.limit(page_size(limit, most)))


def _klines_page(
    table: DataFrame, limit: int | None, after: Cursor | None = None, most: int | None = None, forming: DataFrame | None = None
) -> DataFrame:
    """``forming``: where the newest forming row is looked for, if not in ``table``."""
    closed = (
        _where(table.filter(F.col("is_closed") == F.lit(True)), after_cursor("open_time", after))
        .orderBy(F.desc_nulls_last("open_time"), *map(F.desc, _TIE)).limit(page_size(limit, most))
    )
    newest_forming = (
        (table if forming is None else forming).filter(F.col("is_closed") == F.lit(False))
        .orderBy(F.desc_nulls_last("open_time"), F.desc_nulls_last("kafka_offset"), F.desc("kafka_partition")).limit(1)
    )
    return closed.unionByName(newest_forming)


def klines(
    table: DataFrame,
    symbol: str | None = None,
    interval: str | None = None,
    limit: int | None = None,
    *,
    strict: bool = False,
    after: Cursor | None = None,
    most: int | None = None,
    before: int | None = None,
    time_range: tuple[int, int] | None = None,
    latest_only: bool = False,
    forming: DataFrame | None = None,
) -> DataFrame:
    """Newest closed candles, then the one newest update still forming.

    Without a symbol or interval several series are mixed; ``strict`` refuses that.
    ``after`` continues a page below its last row (see ``next_cursor``), ``before``
    starts one below an open time, ``time_range`` bounds it at both ends (inclusive).
    ``latest_only`` keeps one row per candle before the limit. ``most`` is the largest
    page a server gives; without it the caller's limit holds. ``forming`` has the rows
    among which the forming one is looked for, where ``table`` was cut to the newest days.
    """
    if strict and (symbol is None or interval is None):
        raise AmbiguousSeries("symbol and interval are both required")
    open_time = F.col("open_time")

    def scoped(rows: DataFrame) -> DataFrame:
        own = _where(
            rows, _equals("symbol", symbol), _equals("interval", interval),
            None if before is None else open_time < F.lit(before),
            None if time_range is None else open_time.between(F.lit(time_range[0]), F.lit(time_range[1])),
        )
        return candle_series(own) if latest_only else own

    return decimals_to_text(_klines_page(scoped(table), limit, after, most, None if forming is None else scoped(forming)))


def candle_series(rows: DataFrame) -> DataFrame:
    """One row per candle, the one with the highest offset."""
    return latest_per_key(rows, ["symbol", "interval", "open_time"])


def _series_page(
    table: DataFrame, symbol: str, interval: str, limit: int, after: Cursor | None, latest_only: bool, forming: DataFrame | None
) -> DataFrame:
    scoped = lambda rows: candle_series(_scoped(rows, symbol, interval)) if latest_only else _scoped(rows, symbol, interval)
    return _klines_page(scoped(table), limit, after, None, None if forming is None else scoped(forming))


def candles(
    table: DataFrame, symbol: str, interval: str = "1m", limit: int = CANDLE_LIMIT, *,
    after: Cursor | None = None, latest_only: bool = False, forming: DataFrame | None = None,
) -> DataFrame:
    """A page of one series without repeats, oldest first.

    The limit counts updates, as the feed does; with ``latest_only`` it counts candles.
    """
    page = _series_page(table, symbol, interval, limit, after, latest_only, forming)
    return decimals_to_text(candle_series(page).orderBy("open_time"))


def to_candles(live: DataFrame) -> DataFrame:
    """Live rows narrowed to the chart columns, with lake decimals.

    Live text keeps its source scale, so it is only comparable as a decimal.
    """
    whole = {"trade_count", "open_time"}
    return live.select(
        "symbol", *[F.col(c) if c in whole else to_lake_decimal(c).alias(c) for c in CANDLE_COLUMNS]
    )


def merge_candles(history: DataFrame, live: DataFrame) -> DataFrame:
    """Both views by series and open time; the live row wins. Without an interval on
    both sides the rows must be of one interval."""
    series = ["symbol", *(c for c in ("interval",) if c in history.columns and c in live.columns)]
    columns = [*series, *CANDLE_COLUMNS]
    return override(history.select(*columns), live.select(*columns), [*series, "open_time"])


def live_chart(
    klines_table: DataFrame, live_window: DataFrame, symbol: str, limit: int = CANDLE_LIMIT, *,
    after: Cursor | None = None, latest_only: bool = False, forming: DataFrame | None = None,
) -> DataFrame:
    """One-second chart: a page of lake history under the live window, oldest first."""
    page = _series_page(klines_table, symbol, WINDOW_INTERVAL, limit, after, latest_only, forming)
    live = to_candles(live_window.filter(F.col("symbol") == F.lit(symbol)))
    merged = merge_candles(candle_series(page), live)
    return decimals_to_text(
        merged.withColumn("direction", candle_direction(F.col("open"), F.col("close"))).orderBy("open_time")
    )


def live_tickers(live_book_ticker: DataFrame) -> DataFrame:
    bid, ask = to_lake_decimal("best_bid_price"), to_lake_decimal("best_ask_price")
    return live_book_ticker.withColumn("spread", spread(bid, ask).cast("string")).orderBy("symbol")


def live_trades(live_trade: DataFrame) -> DataFrame:
    return live_trade.withColumn("side", aggressor_side(F.col("is_buyer_maker"))).orderBy("symbol")


def newest_candle(table: DataFrame, symbol: str | None = None, interval: str | None = None) -> DataFrame:
    return _scoped(table, symbol, interval).groupBy("symbol", "interval").agg(
        F.max("open_time").alias("newest_open_time")
    )


def rows_as_json(rows: DataFrame) -> DataFrame:
    """One JSON object per row, decimals as exact strings."""
    return decimals_to_text(rows).select(F.to_json(F.struct("*")).alias("json"))


def json_array(rows: DataFrame, most: int = JSON_ROWS) -> str:
    """A page as one JSON array text; ``[]`` when empty. More than ``most`` rows are refused."""
    page = rows_as_json(rows).limit(most + 1).collect()
    if len(page) > most:
        raise ValueError(f"a page of JSON holds at most {most} rows")
    return "[" + ",".join(row["json"] for row in page) + "]"


def live_sql(spark: SparkSession, statement: str) -> DataFrame:
    """Ad-hoc SQL over registered live views."""
    return spark.sql(statement)
