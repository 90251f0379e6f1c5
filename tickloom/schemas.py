"""Fixed schemas: wire payloads, lake tables, live tables, topic records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: names, limits and formats that define the contract ---------

SCHEMA_VERSION = 1

TRADES_TOPIC = "market.trades"
BOOK_TICKERS_TOPIC = "market.book-tickers"
KLINES_TOPIC = "market.klines"
DLQ_SUFFIX = ".dlq"

AGG_TRADE = "agg_trade"
BOOK_TICKER = "book_ticker"
KLINE = "kline"
CONTROL = "control"

SHUTDOWN_STREAM = "!serverShutdown"
AGG_TRADE_SUFFIX = "aggTrade"
BOOK_TICKER_SUFFIX = "bookTicker"
KLINE_SUFFIX_PREFIX = "kline_"

VALID_INTERVALS = (
    "1s", "1m", "3m", "5m", "15m", "30m", "1h", "2h", "4h", "6h", "8h", "12h",
    "1d", "3d", "1w", "1M",
)
INTERVAL_MS = {
    "1s": 1_000,
    "1m": 60_000,
    "3m": 180_000,
    "5m": 300_000,
    "15m": 900_000,
    "30m": 1_800_000,
    "1h": 3_600_000,
    "2h": 7_200_000,
    "4h": 14_400_000,
    "6h": 21_600_000,
    "8h": 28_800_000,
    "12h": 43_200_000,
    "1d": 86_400_000,
    "3d": 259_200_000,
    "1w": 604_800_000,
    "1M": 2_592_000_000,
}
WINDOW_INTERVAL = "1s"

DEFAULT_LIMIT = 100
MAX_LIMIT = 1000
CANDLE_LIMIT = 1000
TRADE_SEED_LIMIT = 20
MAX_STREAMS = 1024

WINDOW_KEEP = 600
WINDOW_SLACK = 120

DEFAULT_VISIBLE = 120
MIN_VISIBLE = 5

FLUSH_SECONDS = 10
LISTING_TTL_MS = 3000
SNIPPET_LENGTH = 256

# The exact decimal type in flight has a 96-bit coefficient.
DECIMAL_PATTERN = r"^-?[0-9]+(\.[0-9]+)?$"
MAX_DECIMAL = "79228162514264337593543950335"

# The field and table schemas below are fixed values too: names, order and types.

LAKE_DECIMAL = T.DecimalType(38, 8)


@dataclass(frozen=True)
class Field:
    """One required payload field: wire key, column name, JSON kind, candle part."""

    wire: str
    name: str
    kind: str  # text | decimal | long | boolean
    in_candle: bool = False


TRADE_FIELDS = (
    Field("e", "event_type", "text"),
    Field("E", "event_time", "long"),
    Field("s", "symbol", "text"),
    Field("a", "agg_trade_id", "long"),
    Field("p", "price", "decimal"),
    Field("q", "quantity", "decimal"),
    Field("f", "first_trade_id", "long"),
    Field("l", "last_trade_id", "long"),
    Field("T", "trade_time", "long"),
    Field("m", "is_buyer_maker", "boolean"),
)

TICKER_FIELDS = (
    Field("u", "update_id", "long"),
    Field("s", "symbol", "text"),
    Field("b", "best_bid_price", "decimal"),
    Field("B", "best_bid_qty", "decimal"),
    Field("a", "best_ask_price", "decimal"),
    Field("A", "best_ask_qty", "decimal"),
)

KLINE_EVENT_FIELDS = (
    Field("e", "event_type", "text"),
    Field("E", "event_time", "long"),
    Field("s", "event_symbol", "text"),
)

KLINE_FIELDS = (
    Field("t", "open_time", "long", True),
    Field("T", "close_time", "long", True),
    Field("s", "symbol", "text", True),
    Field("i", "interval", "text", True),
    Field("f", "first_trade_id", "long", True),
    Field("L", "last_trade_id", "long", True),
    Field("o", "open", "decimal", True),
    Field("c", "close", "decimal", True),
    Field("h", "high", "decimal", True),
    Field("l", "low", "decimal", True),
    Field("v", "volume", "decimal", True),
    Field("n", "trade_count", "long", True),
    Field("x", "is_closed", "boolean", True),
    Field("q", "quote_volume", "decimal", True),
    Field("V", "taker_buy_base_volume", "decimal", True),
    Field("Q", "taker_buy_quote_volume", "decimal", True),
)


def _schema(*columns: tuple[str, T.DataType], nullable: bool = False) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t in columns])


_D, _L, _I, _S, _B = LAKE_DECIMAL, T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()

TRADES_LAKE = _schema(
    ("price", _D), ("quantity", _D), ("trade_time", _L), ("agg_trade_id", _L),
    ("is_buyer_maker", _B), ("kafka_partition", _I), ("kafka_offset", _L), ("symbol", _S),
)
BOOK_TICKERS_LAKE = _schema(
    ("best_bid_price", _D), ("best_bid_qty", _D), ("best_ask_price", _D), ("best_ask_qty", _D),
    ("update_id", _L), ("kafka_partition", _I), ("kafka_offset", _L), ("symbol", _S),
)
KLINES_LAKE = _schema(
    ("open", _D), ("high", _D), ("low", _D), ("close", _D), ("volume", _D), ("quote_volume", _D),
    ("trade_count", _L), ("open_time", _L), ("close_time", _L), ("is_closed", _B),
    ("kafka_partition", _I), ("kafka_offset", _L), ("symbol", _S), ("interval", _S),
)


@dataclass(frozen=True)
class LakeTable:
    """One lake table: its topic, event kind, schema, path columns, and what its rows are ordered by."""

    topic: str
    kind: str
    schema: T.StructType
    path_columns: tuple[str, ...]
    time_column: str | None
    order_column: str

    @property
    def grain_column(self) -> str:
        """The directory below the path columns: a day, or the id range of one flush where there is no time."""
        return DAY_COLUMN if self.time_column else SPAN_COLUMN


DAY_COLUMN, SPAN_COLUMN = "event_date", "id_span"
TRADES = LakeTable(TRADES_TOPIC, AGG_TRADE, TRADES_LAKE, ("symbol",), "trade_time", "trade_time")
BOOK_TICKERS = LakeTable(BOOK_TICKERS_TOPIC, BOOK_TICKER, BOOK_TICKERS_LAKE, ("symbol",), None, "update_id")
KLINES = LakeTable(KLINES_TOPIC, KLINE, KLINES_LAKE, ("symbol", "interval"), "open_time", "open_time")
LAKE_TABLES = (TRADES, BOOK_TICKERS, KLINES)

# Micro-batch column written as the innermost lake directory.
BATCH_COLUMN = "batch_id"

LIVE_TRADE = _schema(
    ("symbol", _S), ("price", _S), ("quantity", _S), ("trade_time", _L),
    ("agg_trade_id", _L), ("is_buyer_maker", _B),
)
LIVE_BOOK_TICKER = _schema(
    ("symbol", _S), ("best_bid_price", _S), ("best_bid_qty", _S), ("best_ask_price", _S),
    ("best_ask_qty", _S), ("update_id", _L),
)
_LIVE_CANDLE = (
    ("open", _S), ("high", _S), ("low", _S), ("close", _S), ("volume", _S), ("quote_volume", _S),
    ("trade_count", _L), ("open_time", _L), ("close_time", _L), ("is_closed", _B),
)
LIVE_KLINE = _schema(("id", _S), ("symbol", _S), ("bar_interval", _S), *_LIVE_CANDLE)
LIVE_KLINE_SECOND = _schema(("id", _S), ("symbol", _S), *_LIVE_CANDLE)

CANDLE_COLUMNS = ("open", "high", "low", "close", "volume", "trade_count", "open_time")

HEADERS = T.ArrayType(T.StructType([T.StructField("key", _S), T.StructField("value", T.BinaryType())]))

# Columns of a topic source; a file source of the same columns stands in for it.
TOPIC_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", _S),
    T.StructField("partition", _I),
    T.StructField("offset", _L),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("headers", HEADERS),
])
