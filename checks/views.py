"""Market-shaped views over the given tables, in Spark and, identically, in SQL.

Every view is a projection of one scan: no window, whole tables. They
stand in for a feed, so that each operator can run on the given data. Written inputs
deal the events first (``tasks``): a table of few files is not made into texts by few tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.session import prepare_session

# Interval of a candle update by user_id modulo 4, with its length.
INTERVALS = {0: ("1s", 1_000), 1: ("1m", 60_000), 2: ("1h", 3_600_000), 3: ("1d", 86_400_000)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def base_events(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """One market update per event; with ``tasks``, events are dealt over so many before anything is made of them."""
    events = table(spark, sf_dir, "events")
    slot = F.expr("pmod(user_id, 4)")
    interval = F.when(slot == 0, "1s").when(slot == 1, "1m").when(slot == 2, "1h").otherwise("1d")
    length = F.when(slot == 0, 1000).when(slot == 1, 60000).when(slot == 2, 3600000).otherwise(86400000)
    cents = lambda column: column.cast("decimal(18,2)") * F.lit("0.01").cast("decimal(4,2)")
    price = F.col("value").cast("decimal(18,2)")
    close = price + cents(F.col("k") % 21 - 10)
    return (
        (events if tasks is None else events.repartition(tasks))
        .select(
            "event_id", "user_id", F.upper("event_type").alias("symbol"), F.col("value"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        )
        .select(
            "event_id", "symbol", "ms", "k", interval.alias("interval"), length.cast("bigint").alias("length"),
            (F.ascii("symbol") % 6).cast("int").alias("kafka_partition"),
            F.col("event_id").alias("kafka_offset"),
            price.cast("decimal(38,8)").alias("price"),
            F.col("k").cast("decimal(38,8)").alias("quantity"),
            (price + cents(F.col("k") + 1)).cast("decimal(38,8)").alias("ask"),
            close.cast("decimal(38,8)").alias("close"),
            (F.greatest(price, close) + cents(F.col("k"))).cast("decimal(38,8)").alias("high"),
            (F.least(price, close) - cents(F.col("k") % 5)).cast("decimal(38,8)").alias("low"),
            (price * F.col("k").cast("decimal(18,2)")).cast("decimal(38,8)").alias("quote_volume"),
        )
        .withColumn("open_time", F.col("ms") - F.col("ms") % F.col("length"))
    )


SQL_BASE = """
base0 AS (
  SELECT event_id, upper(event_type) AS symbol, epoch_us(ts) // 1000 AS ms,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CASE user_id % 4 WHEN 0 THEN '1s' WHEN 1 THEN '1m' WHEN 2 THEN '1h' ELSE '1d' END AS "interval",
    CAST(CASE user_id % 4 WHEN 0 THEN 1000 WHEN 1 THEN 60000 WHEN 2 THEN 3600000 ELSE 86400000 END AS BIGINT) AS length,
    CAST(value AS DECIMAL(18,2)) AS p
  FROM events),
base AS (
  SELECT event_id, symbol, ms, k, "interval", length,
    CAST(ascii(symbol) % 6 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
    CAST(p AS DECIMAL(38,8)) AS price, CAST(k AS DECIMAL(38,8)) AS quantity,
    CAST(p + CAST(k + 1 AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(38,8)) AS ask,
    CAST(p + CAST(k % 21 - 10 AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(38,8)) AS close,
    CAST(greatest(p, p + CAST(k % 21 - 10 AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(4,2)))
      + CAST(k AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(38,8)) AS high,
    CAST(least(p, p + CAST(k % 21 - 10 AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(4,2)))
      - CAST(k % 5 AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(38,8)) AS low,
    CAST(p * CAST(k AS DECIMAL(18,2)) AS DECIMAL(38,8)) AS quote_volume,
    ms - ms % length AS open_time
  FROM base0)"""


def trades(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    return base_events(spark, sf_dir, tasks).select(
        "price", "quantity", F.col("ms").alias("trade_time"), F.col("event_id").alias("agg_trade_id"),
        (F.col("event_id") % 2 == 0).alias("is_buyer_maker"), "kafka_partition", "kafka_offset", "symbol",
    )


def book_tickers(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    return base_events(spark, sf_dir, tasks).select(
        F.col("price").alias("best_bid_price"), F.col("quantity").alias("best_bid_qty"),
        F.col("ask").alias("best_ask_price"), (F.col("k") + 1).cast("decimal(38,8)").alias("best_ask_qty"),
        F.col("event_id").alias("update_id"), "kafka_partition", "kafka_offset", "symbol",
    )


def klines(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """An append-only log of candle updates in four intervals."""
    return base_events(spark, sf_dir, tasks).select(
        F.col("price").alias("open"), "high", "low", "close", F.col("quantity").alias("volume"), "quote_volume",
        (F.col("k") + 1).alias("trade_count"), "open_time", (F.col("open_time") + F.col("length") - 1).alias("close_time"),
        (F.col("event_id") % 3 == 0).alias("is_closed"), "kafka_partition", "kafka_offset", "symbol", "interval",
    )


SQL_TRADES = SQL_BASE + """,
v_trades AS (
  SELECT price, quantity, ms AS trade_time, event_id AS agg_trade_id, event_id % 2 = 0 AS is_buyer_maker,
    kafka_partition, kafka_offset, symbol FROM base)"""

SQL_TICKERS = SQL_BASE + """,
v_tickers AS (
  SELECT price AS best_bid_price, quantity AS best_bid_qty, ask AS best_ask_price,
    CAST(k + 1 AS DECIMAL(38,8)) AS best_ask_qty, event_id AS update_id, kafka_partition, kafka_offset, symbol FROM base)"""

SQL_KLINES = SQL_BASE + """,
v_klines AS (
  SELECT price AS open, high, low, close, quantity AS volume, quote_volume, k + 1 AS trade_count, open_time,
    open_time + length - 1 AS close_time, event_id % 3 = 0 AS is_closed, kafka_partition, kafka_offset, symbol, "interval"
  FROM base)"""


# --- Raw frames and topic records ---------------------------------------------

def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _trade_payload() -> Column:
    c = F.col
    return _text(
        '{"e":"aggTrade","E":', c("ms"), ',"s":"', c("symbol"), '","a":', c("event_id"), ',"p":"', c("price"),
        '","q":"', c("quantity"), '","f":', c("event_id"), ',"l":', c("event_id") + c("k"), ',"T":', c("ms"),
        ',"m":', c("event_id") % 2 == 0, "}",
    )


def _ticker_payload() -> Column:
    c = F.col
    return _text(
        '{"u":', c("event_id"), ',"s":"', c("symbol"), '","b":"', c("price"), '","B":"', c("quantity"),
        '","a":"', c("ask"), '","A":"', (c("k") + 1).cast("decimal(38,8)"), '"}',
    )


def _kline_payload() -> Column:
    c = F.col
    return _text(
        '{"e":"kline","E":', c("ms"), ',"s":"', c("symbol"), '","k":{"t":', c("open_time"), ',"T":',
        c("open_time") + c("length") - 1, ',"s":"', c("symbol"), '","i":"', c("interval"), '","f":', c("event_id"),
        ',"L":', c("event_id") + c("k"), ',"o":"', c("price"), '","c":"', c("close"), '","h":"', c("high"),
        '","l":"', c("low"), '","v":"', c("quantity"), '","n":', c("k") + 1, ',"x":', c("event_id") % 3 == 0,
        ',"q":"', c("quote_volume"), '","V":"', c("quantity"), '","Q":"', c("quote_volume"), '"}}',
    )


_SQL_TRADE_PAYLOAD = """'{"e":"aggTrade","E":' || ms || ',"s":"' || symbol || '","a":' || event_id || ',"p":"' || price
    || '","q":"' || quantity || '","f":' || event_id || ',"l":' || (event_id + k) || ',"T":' || ms
    || ',"m":' || (event_id % 2 = 0) || '}'"""
_SQL_TICKER_PAYLOAD = """'{"u":' || event_id || ',"s":"' || symbol || '","b":"' || price || '","B":"' || quantity
    || '","a":"' || ask || '","A":"' || CAST(k + 1 AS DECIMAL(38,8)) || '"}'"""
_SQL_KLINE_PAYLOAD = """'{"e":"kline","E":' || ms || ',"s":"' || symbol || '","k":{"t":' || open_time || ',"T":'
    || (open_time + length - 1) || ',"s":"' || symbol || '","i":"' || "interval" || '","f":' || event_id
    || ',"L":' || (event_id + k) || ',"o":"' || price || '","c":"' || close || '","h":"' || high
    || '","l":"' || low || '","v":"' || quantity || '","n":' || (k + 1) || ',"x":' || (event_id % 3 = 0)
    || ',"q":"' || quote_volume || '","V":"' || quantity || '","Q":"' || quote_volume || '"}}'"""


def _payload(kind: Column) -> Column:
    return F.when(kind == 0, _trade_payload()).when(kind == 1, _ticker_payload()).otherwise(_kline_payload())


def frames(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """One raw frame per event: trades, tickers and candles, some of them damaged."""
    kind, fault = F.col("event_id") % 4, F.col("event_id") % 50
    suffix = F.when(kind == 0, "aggTrade").when(kind == 1, "bookTicker").otherwise(_text("kline_", F.col("interval")))
    stream = F.when(fault == 13, "depth").when(fault == 14, "x@aggTrade").otherwise(suffix)
    payload, text = F.col("payload"), F.col("text")
    damaged = (
        F.when(fault == 19, F.replace(payload, F.col("price").cast("string"), F.lit("abc")))
        .when(fault == 23, F.replace(payload, F.lit('"s":'), F.lit('"z":')))
        .when(fault == 29, F.replace(payload, _text('"', F.col("price"), '"'), F.col("price").cast("string")))
        .when(fault == 30, F.replace(payload, F.lit('"s":'), F.lit('"ignored":[{"x":1}],"s":')))
        .otherwise(payload)
    )
    value = (
        F.when(fault == 7, F.substr(text, F.lit(1), F.length(text) - 5))
        .when(fault == 31, _text('{"stream":"!serverShutdown","data":{"e":"serverShutdown","E":', F.col("ms"), "}}"))
        .when(fault == 37, _text(text, " trailing"))
        .when(fault == 38, _text(text, text))
        .when(fault == 39, _text(text, "] ", text))
        .when(fault == 43, " ")
        .otherwise(text)
    )
    return (
        base_events(spark, sf_dir, tasks)
        .select("event_id", "ms", "symbol", "interval", "price", _payload(kind).alias("payload"))
        .select("event_id", "ms", _text('{"stream":"', F.lower("symbol"), "@", stream, '","data":', damaged, "}").alias("text"))
        .select("event_id", value.alias("value"))
    )


SQL_FRAMES = SQL_BASE + f""",
payloads AS (
  SELECT *, CASE event_id % 4 WHEN 0 THEN {_SQL_TRADE_PAYLOAD} WHEN 1 THEN {_SQL_TICKER_PAYLOAD}
      ELSE {_SQL_KLINE_PAYLOAD} END AS payload,
    CASE event_id % 4 WHEN 0 THEN 'aggTrade' WHEN 1 THEN 'bookTicker' ELSE 'kline_' || "interval" END AS suffix
  FROM base),
texts AS (
  SELECT event_id, ms, '{{"stream":"' || lower(symbol) || '@'
    || CASE event_id % 50 WHEN 13 THEN 'depth' WHEN 14 THEN 'x@aggTrade' ELSE suffix END || '","data":'
    || CASE event_id % 50 WHEN 19 THEN replace(payload, CAST(price AS VARCHAR), 'abc')
        WHEN 23 THEN replace(payload, '"s":', '"z":')
        WHEN 29 THEN replace(payload, '"' || price || '"', CAST(price AS VARCHAR))
        WHEN 30 THEN replace(payload, '"s":', '"ignored":[{{"x":1}}],"s":') ELSE payload END || '}}' AS text
  FROM payloads),
v_frames AS (
  SELECT event_id, CASE event_id % 50 WHEN 7 THEN substr(text, 1, length(text) - 5)
    WHEN 31 THEN '{{"stream":"!serverShutdown","data":{{"e":"serverShutdown","E":' || ms || '}}}}'
    WHEN 37 THEN text || ' trailing' WHEN 38 THEN text || text WHEN 39 THEN text || '] ' || text
    WHEN 43 THEN ' ' ELSE text END AS value
  FROM texts)"""


def _topic(kind: Column) -> Column:
    return F.when(kind == 0, "market.trades").when(kind == 1, "market.book-tickers").otherwise("market.klines")


def topic_records(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """One topic record per event, some empty or damaged, in the topic source's columns."""
    kind, fault = F.col("event_id") % 4, F.col("event_id") % 40
    event_type = F.when(kind == 0, "agg_trade").when(kind == 1, "book_ticker").otherwise("kline")
    text = _text(
        '{"event_type":"', F.when(fault == 3, "candle").otherwise(event_type), '","schema_version":',
        F.when(fault == 5, 2).otherwise(1), ',"payload":', F.col("payload"), "}",
    )
    value = (
        F.when(fault == 9, F.substr(F.col("text"), F.lit(1), F.length("text") - 5))
        .when(fault == 11, F.replace(F.col("text"), F.lit('"s":'), F.lit('"z":')))
        .when(fault != 17, F.col("text"))
    )
    lineage = ["event_id", "ms", "symbol", "kafka_partition", "kafka_offset"]
    return (
        base_events(spark, sf_dir, tasks).select(*lineage, _payload(kind).alias("payload")).select(*lineage, text.alias("text"))
        .select(
            F.encode("symbol", "UTF-8").alias("key"), F.encode(value, "UTF-8").alias("value"),
            _topic(kind).alias("topic"), F.col("kafka_partition").alias("partition"),
            F.col("kafka_offset").alias("offset"), F.timestamp_millis("ms").alias("timestamp"),
            F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
        )
    )


SQL_TOPIC = SQL_BASE + f""",
payloads AS (
  SELECT *, CASE event_id % 4 WHEN 0 THEN {_SQL_TRADE_PAYLOAD} WHEN 1 THEN {_SQL_TICKER_PAYLOAD}
      ELSE {_SQL_KLINE_PAYLOAD} END AS payload,
    CASE event_id % 4 WHEN 0 THEN 'agg_trade' WHEN 1 THEN 'book_ticker' ELSE 'kline' END AS kind,
    CASE event_id % 4 WHEN 0 THEN 'market.trades' WHEN 1 THEN 'market.book-tickers' ELSE 'market.klines' END AS topic
  FROM base),
texts AS (
  SELECT *, '{{"event_type":"' || CASE event_id % 40 WHEN 3 THEN 'candle' ELSE kind END || '","schema_version":'
    || CASE event_id % 40 WHEN 5 THEN 2 ELSE 1 END || ',"payload":' || payload || '}}' AS text
  FROM payloads),
v_topic AS (
  SELECT * EXCLUDE (text, payload), CASE WHEN event_id % 40 = 9 THEN substr(text, 1, length(text) - 5)
    WHEN event_id % 40 = 11 THEN replace(text, '"s":', '"z":')
    WHEN event_id % 40 <> 17 THEN text END AS value
  FROM texts)"""


# --- Positional historical rows -----------------------------------------------

REST_NOW_MS = 946_684_800_000  # 2000-01-01, inside the order dates


def rest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One positional daily candle per order, some of them damaged."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("decimal(38,8)")
    day = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    fault, key = F.col("o_orderkey") % 40, F.col("o_orderkey")
    close_time = F.when(fault == 11, _text('"', day + 86399999, '"')).otherwise((day + 86399999).cast("string"))
    text = _text(
        "[", day, ',"', price, '","', price, '","', price, '",',
        F.when(fault == 13, price.cast("string")).otherwise(_text('"', price, '"')),
        ',"', F.col("o_custkey"), '.5",', close_time, ',"', F.when(fault == 17, "1e5").otherwise(F.lit("7.25")), '",', key % 97,
        ',"1.5","2.5","0"]',
    )
    row_text = F.when(fault == 19, F.substring_index(text, ",", 7)).otherwise(text)
    row_text = F.when(fault == 19, _text(row_text, "]")).otherwise(row_text)
    return table(spark, sf_dir, "orders").select(
        key.alias("row_id"), F.col("o_orderstatus").alias("symbol"), F.lit("1d").alias("interval"),
        row_text.alias("row_text"),
    )


SQL_REST = """
rest0 AS (
  SELECT o_orderkey AS row_id, o_orderstatus AS symbol, '1d' AS "interval", o_orderkey % 40 AS fault, o_custkey,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,8)) AS price, epoch_us(o_orderdate) // 1000 AS day
  FROM orders),
rest AS (
  SELECT *, fault IN (11, 13, 17, 19) AS bad FROM rest0)"""
