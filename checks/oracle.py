"""The same results in DuckDB SQL, computed from the given tables.

Decode oracles parse the view's JSON text with DuckDB's own JSON functions.
"""

from __future__ import annotations

from checks import views
from checks.registry import BATCHES, CUTOFF_MS, INSIDE_DAY_MS, INTERVAL, RANGE_MS, SHUFFLE, SYMBOL, WINDOW_KEEP, WINDOW_SLACK
from tickloom.schemas import (
    BOOK_TICKERS_LAKE, DECIMAL_PATTERN, Field, INTERVAL_MS, KLINE_EVENT_FIELDS, KLINE_FIELDS, KLINES_LAKE,
    TICKER_FIELDS, TRADE_FIELDS, TRADES_LAKE, VALID_INTERVALS,
)

Q = '"'


def _name(column: str) -> str:
    return f'"{column}"'


def _as_text(schema, alias: str = "") -> str:
    """Select list of a lake table with decimals as text."""
    dot = f"{alias}." if alias else ""
    return ", ".join(
        f"CAST({dot}{_name(f.name)} AS VARCHAR) AS {_name(f.name)}" if f.dataType.typeName() == "decimal"
        else f"{dot}{_name(f.name)}" for f in schema.fields
    )


TRADES_TEXT, TICKERS_TEXT, KLINES_TEXT = _as_text(TRADES_LAKE), _as_text(BOOK_TICKERS_LAKE), _as_text(KLINES_LAKE)


# --- Decoding with DuckDB's JSON functions ------------------------------------

def _path(prefix: str, field: Field) -> str:
    return f"'$.{prefix}.{field.wire}'"


def _bad(prefix: str, field: Field) -> str:
    path = _path(prefix, field)
    if field.kind == "long":
        return f"coalesce(json_type(doc, {path}) NOT IN ('BIGINT', 'UBIGINT'), true)"
    if field.kind == "boolean":
        return f"coalesce(json_type(doc, {path}) <> 'BOOLEAN', true)"
    text = f"coalesce(json_type(doc, {path}) <> 'VARCHAR', true)"
    if field.kind == "text":
        return text
    return f"({text} OR NOT regexp_matches(json_extract_string(doc, {path}), '{DECIMAL_PATTERN}'))"


def _first_bad(groups) -> str:
    cases = " ".join(f"WHEN {_bad(prefix, f)} THEN '{f.wire}'" for prefix, fields in groups for f in fields)
    return f"CASE {cases} END"


def _values(groups) -> str:
    casts = {"long": "BIGINT", "boolean": "BOOLEAN", "text": "VARCHAR", "decimal": "VARCHAR"}
    return ", ".join(
        f"CAST(json_extract_string(doc, {_path(prefix, f)}) AS {casts[f.kind]}) AS {_name(f.name)}"
        for prefix, fields in groups for f in fields
    )


def _groups(payload: str) -> dict:
    return {
        "agg_trade": [(payload, TRADE_FIELDS)],
        "book_ticker": [(payload, TICKER_FIELDS)],
        "kline": [(payload, KLINE_EVENT_FIELDS), (f"{payload}.k", KLINE_FIELDS)],
    }


_REASON = "'field `' || bad || '` is missing or has a wrong value'"

FRAMES = views.SQL_FRAMES + f""",
docs AS (
  SELECT event_id, value, CASE WHEN json_valid(value) THEN value END AS doc FROM v_frames WHERE trim(value) <> ''),
streams AS (
  SELECT *, CASE WHEN json_type(doc, '$.stream') = 'VARCHAR' AND json_exists(doc, '$.data')
    THEN json_extract_string(doc, '$.stream') END AS stream FROM docs),
routed AS (
  SELECT *, CASE WHEN stream = '!serverShutdown' THEN 'control' WHEN strpos(stream, '@') = 0 THEN NULL
    WHEN substr(stream, strpos(stream, '@') + 1) = 'aggTrade' THEN 'agg_trade'
    WHEN substr(stream, strpos(stream, '@') + 1) = 'bookTicker' THEN 'book_ticker'
    WHEN substr(stream, strpos(stream, '@') + 1) LIKE 'kline#_%' ESCAPE '#' THEN 'kline' END AS routed_kind
  FROM streams),
checked AS (
  SELECT *, CASE routed_kind {" ".join(f"WHEN '{kind}' THEN {_first_bad(groups)}" for kind, groups in _groups("data").items())}
    END AS bad FROM routed),
decoded AS (
  SELECT *, CASE WHEN stream IS NULL THEN 'malformed text'
      WHEN routed_kind IS NULL THEN 'no route for stream `' || stream || '`'
      WHEN bad IS NOT NULL THEN 'malformed text: ' || {_REASON} END AS error FROM checked),
kinds AS (SELECT *, CASE WHEN error IS NULL THEN routed_kind END AS kind FROM decoded)"""

TOPIC = views.SQL_TOPIC + f""",
docs AS (SELECT *, CASE WHEN json_valid(value) THEN value END AS doc FROM v_topic WHERE value IS NOT NULL),
typed AS (
  SELECT * EXCLUDE (kind), CASE WHEN json_type(doc, '$.event_type') = 'VARCHAR' AND json_exists(doc, '$.payload')
    THEN json_extract_string(doc, '$.event_type') END AS event_type,
    json_extract_string(doc, '$.schema_version') AS version FROM docs),
checked AS (
  SELECT *, CASE event_type {" ".join(f"WHEN '{kind}' THEN {_first_bad(groups)}" for kind, groups in _groups("payload").items())}
    END AS bad FROM typed),
decoded AS (
  SELECT *, CASE WHEN event_type IS NULL THEN 'not an envelope'
      WHEN event_type NOT IN ('agg_trade', 'book_ticker', 'kline') THEN 'no such event type: `' || event_type || '`'
      WHEN bad IS NOT NULL THEN CASE event_type WHEN 'agg_trade' THEN 'bad trade: ' WHEN 'book_ticker' THEN 'bad ticker: '
        ELSE 'bad candle: ' END || {_REASON} END AS error FROM checked),
kinds AS (SELECT *, CASE WHEN error IS NULL THEN event_type END AS kind FROM decoded)"""

_STATS = """SELECT count(*) FILTER (kind IN ('agg_trade', 'book_ticker', 'kline')) AS events,
  count(*) FILTER (kind = 'agg_trade') AS agg_trades, count(*) FILTER (kind = 'book_ticker') AS book_tickers,
  count(*) FILTER (kind = 'kline') AS klines, count(*) FILTER (error IS NOT NULL) AS decode_errors,
  count(*) FILTER (kind = 'control') AS server_shutdowns FROM kinds"""


def _decoded(kind: str) -> str:
    return f"WITH {FRAMES} SELECT event_id, {_values(_groups('data')[kind])} FROM kinds WHERE kind = '{kind}'"


def _wire(prefix: str, fields) -> str:
    """JSON text of fields read from ``doc``."""
    parts = []
    for f in fields:
        value = f"json_extract_string(doc, {_path(prefix, f)})"
        quote = Q if f.kind in ("text", "decimal") else ""
        parts.append(f"""'"{f.wire}":{quote}' || {value} || '{quote}'""")
    return " || ',' || ".join(parts)


_TRADE_ENVELOPE = f"""'{{"event_type":"agg_trade","schema_version":1,"payload":{{' || {_wire("data", TRADE_FIELDS)} || '}}}}'"""
_TICKER_ENVELOPE = f"""'{{"event_type":"book_ticker","schema_version":1,"payload":{{' || {_wire("data", TICKER_FIELDS)} || '}}}}'"""
_KLINE_ENVELOPE = (
    f"""'{{"event_type":"kline","schema_version":1,"payload":{{' || {_wire("data", KLINE_EVENT_FIELDS)} """
    f"""|| ',"k":{{' || {_wire("data.k", KLINE_FIELDS)} || '}}}}}}'"""
)
_TOPIC_NAME = "CASE kind WHEN 'agg_trade' THEN 'market.trades' WHEN 'book_ticker' THEN 'market.book-tickers' ELSE 'market.klines' END"
_TOPIC_ROWS = f"""SELECT event_id, kind AS event_type, json_extract_string(doc, '$.data.s') AS key,
  CASE kind WHEN 'agg_trade' THEN {_TRADE_ENVELOPE} WHEN 'book_ticker' THEN {_TICKER_ENVELOPE} ELSE {_KLINE_ENVELOPE} END AS value,
  {_TOPIC_NAME} AS topic FROM kinds WHERE kind IN ('agg_trade', 'book_ticker', 'kline')"""

_DEAD_LETTERS = """SELECT symbol AS key, value, topic || '.dlq' AS topic, '{consumer}' AS consumer, error,
  topic AS source_topic, CAST(kafka_partition AS VARCHAR) AS "partition", CAST(kafka_offset AS VARCHAR) AS "offset"
  FROM kinds WHERE error IS NOT NULL"""


# --- Topic rows that decode, as lake and live rows ----------------------------

GOOD = views.SQL_TOPIC + """,
good AS (SELECT *, open_time + length - 1 AS close_time, k + 1 AS trade_count, event_id % 3 = 0 AS is_closed,
  CAST(k + 1 AS DECIMAL(38,8)) AS ask_qty
  FROM v_topic WHERE event_id % 40 NOT IN (3, 9, 11, 17))"""

_LAKE_KLINE = """CAST(price AS VARCHAR) AS open, CAST(high AS VARCHAR) AS high, CAST(low AS VARCHAR) AS low,
  CAST(close AS VARCHAR) AS close, CAST(quantity AS VARCHAR) AS volume, CAST(quote_volume AS VARCHAR) AS quote_volume,
  trade_count, open_time, close_time, is_closed"""


def _newest(rows: str, keys: str, order: str) -> str:
    return f"SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


_ARRIVAL = "kafka_partition DESC, kafka_offset DESC"
_BY_OFFSET = "kafka_offset DESC, kafka_partition DESC"

# In-order arrivals: the number held has a closed form, always the newest.
_HELD = (
    f"CASE WHEN n <= {WINDOW_KEEP + WINDOW_SLACK} THEN n "
    f"ELSE {WINDOW_KEEP} + (n - {WINDOW_KEEP + WINDOW_SLACK + 1}) % {WINDOW_SLACK + 1} END"
)


def _window(rows: str) -> str:
    return f"""latest_second AS ({_newest(rows, "symbol, open_time", _BY_OFFSET)}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) AS rank,
  count(*) OVER (PARTITION BY symbol) AS n FROM latest_second),
held AS (SELECT * FROM ranked WHERE rank <= {_HELD})"""


LIVE_WINDOW = GOOD + """,
seconds AS (SELECT * FROM good WHERE kind = 'kline' AND "interval" = '1s'),
""" + _window("seconds")

SERIES = views.SQL_KLINES + f""",
series AS ({_newest("v_klines", 'symbol, "interval", open_time', _BY_OFFSET)})"""


# --- Pages --------------------------------------------------------------------

_TIE = "kafka_partition DESC, kafka_offset DESC"


def _page(rows: str, limit: int) -> str:
    return f"""closed AS (SELECT * FROM {rows} WHERE is_closed ORDER BY open_time DESC, {_TIE} LIMIT {limit}),
forming AS (SELECT * FROM {rows} WHERE NOT is_closed
  ORDER BY open_time DESC, kafka_offset DESC, kafka_partition DESC LIMIT 1),
page AS (SELECT * FROM closed UNION ALL SELECT * FROM forming)"""


def _klines(where: str, limit: int) -> str:
    return f"""WITH {views.SQL_KLINES}, scoped AS (SELECT * FROM v_klines WHERE {where}), {_page("scoped", limit)}
SELECT {KLINES_TEXT} FROM page"""


_ONE = f"symbol = '{SYMBOL}' AND \"interval\" = '{INTERVAL}'"
_CANDLE_TEXT = """CAST(open AS VARCHAR) AS open, CAST(high AS VARCHAR) AS high, CAST(low AS VARCHAR) AS low,
  CAST(close AS VARCHAR) AS close, CAST(volume AS VARCHAR) AS volume, trade_count, open_time"""

_VISIBLE = """visible AS (SELECT * FROM series
  QUALIFY row_number() OVER (PARTITION BY symbol, "interval" ORDER BY open_time DESC) <= 120)"""

_LENGTHS = " ".join(f"WHEN '{name}' THEN {ms}" for name, ms in INTERVAL_MS.items())
_VALID = ", ".join(f"'{name}'" for name in VALID_INTERVALS)


# --- Historical rows ----------------------------------------------------------

def _rest_select(keep: str) -> str:
    now = views.REST_NOW_MS
    price = "CAST(price AS VARCHAR)"
    values = {
        "event_type": "'kline'", "event_time": f"CAST({now} AS BIGINT)", "event_symbol": "symbol", "open_time": "day",
        "close_time": "day + 86399999", "symbol": "symbol", "interval": '"interval"',
        "first_trade_id": "CAST(-1 AS BIGINT)", "last_trade_id": "CAST(-1 AS BIGINT)", "open": price, "close": price,
        "high": price, "low": price, "volume": "o_custkey || '.5'", "trade_count": "row_id % 97",
        "is_closed": f"day + 86399999 < {now}", "quote_volume": "'7.25'", "taker_buy_base_volume": "'1.5'",
        "taker_buy_quote_volume": "'2.5'",
    }
    columns = [f"{values[f.name]} AS {_name(f.name)}" for f in (*KLINE_EVENT_FIELDS, *KLINE_FIELDS)]
    return f"WITH {views.SQL_REST} SELECT {keep}{', '.join(columns)} FROM rest WHERE NOT bad"


ORACLES: dict[str, str] = {
    "frame_decode_stats": f"WITH {FRAMES} {_STATS}",
    "frame_stats_line": f"""WITH {FRAMES}, counts AS ({_STATS})
SELECT events || ' events (agg_trade=' || agg_trades || ', book_ticker=' || book_tickers || ', kline=' || klines || '); '
  || decode_errors || ' decode errors; ' || server_shutdowns || ' server-shutdowns' AS line FROM counts""",
    "frame_error_budget": f"""WITH {FRAMES}, counts AS ({_STATS})
SELECT events, decode_errors, CAST(3 AS BIGINT) AS max_decode_errors, decode_errors <= 3 AS within_budget,
  events = 0 AS no_events FROM counts""",
    "decoded_trades": _decoded("agg_trade"),
    "decoded_tickers": _decoded("book_ticker"),
    "decoded_klines": _decoded("kline"),
    "bad_frames": f"WITH {FRAMES} SELECT event_id, error, substr(value, 1, 256) AS snippet, value FROM kinds WHERE error IS NOT NULL",
    "control_frames": f"WITH {FRAMES} SELECT event_id, value FROM kinds WHERE kind = 'control'",
    "topic_rows": f"WITH {FRAMES} {_TOPIC_ROWS}",
    "envelope_dispatch": f"WITH {TOPIC} SELECT topic, kind, count(*) AS records FROM kinds GROUP BY topic, kind",
    "schema_version_dispatch": f"""WITH {TOPIC}, strict AS (
  SELECT topic, CASE WHEN version = '1' THEN kind END AS kind FROM kinds)
SELECT topic, kind, count(*) AS records FROM strict GROUP BY topic, kind""",
    "empty_payloads": f"""WITH {views.SQL_TOPIC}
SELECT topic, count(*) FILTER (value IS NULL) AS skipped, count(*) AS records FROM v_topic GROUP BY topic""",
    "dead_letters": f"WITH {TOPIC} {_DEAD_LETTERS.format(consumer='hot')}",
    "path_counters": f"""WITH {TOPIC} SELECT topic, count(*) FILTER (error IS NULL) AS applied,
  count(*) FILTER (error IS NOT NULL) AS dead_lettered FROM kinds GROUP BY topic""",
    "symbol_mismatches": f"""WITH {TOPIC}, pairs AS (
  SELECT CASE WHEN kafka_offset % 7 = 0 THEN 'OTHER' ELSE json_extract_string(doc, '$.payload.s') END AS event_symbol,
    json_extract_string(doc, '$.payload.k.s') AS symbol
  FROM kinds WHERE kind = 'kline')
SELECT event_symbol, symbol, count(*) AS "rows" FROM pairs WHERE event_symbol <> symbol GROUP BY event_symbol, symbol""",
    "raw_frame_recorder": f"""WITH {views.SQL_FRAMES}
SELECT value, CAST(length(value) AS INTEGER) AS length FROM v_frames WHERE trim(value) <> ''""",
    "decode_only_replay": f"WITH {FRAMES} {_STATS}",
    "ingest_stream": f"WITH {FRAMES}, topic_rows AS ({_TOPIC_ROWS}) SELECT key, value, topic FROM topic_rows",
    "lake_roundtrip_trades": f"WITH {views.SQL_TRADES} SELECT {TRADES_TEXT} FROM v_trades",
    "lake_roundtrip_tickers": f"WITH {views.SQL_TICKERS} SELECT {TICKERS_TEXT} FROM v_tickers",
    "lake_roundtrip_klines": f"WITH {views.SQL_KLINES} SELECT {KLINES_TEXT} FROM v_klines",
    "lake_replay_idempotent": f"""WITH {views.SQL_TRADES}
SELECT symbol, count(*) AS "rows", CAST(sum(price) AS VARCHAR) AS sum_price FROM v_trades GROUP BY symbol""",
    "cold_stream_trades": f"""WITH {GOOD} SELECT CAST(price AS VARCHAR) AS price, CAST(quantity AS VARCHAR) AS quantity,
  ms AS trade_time, event_id AS agg_trade_id, event_id % 2 = 0 AS is_buyer_maker, kafka_partition, kafka_offset, symbol
  FROM good WHERE kind = 'agg_trade'""",
    "cold_stream_tickers": f"""WITH {GOOD} SELECT CAST(price AS VARCHAR) AS best_bid_price,
  CAST(quantity AS VARCHAR) AS best_bid_qty, CAST(ask AS VARCHAR) AS best_ask_price, CAST(ask_qty AS VARCHAR) AS best_ask_qty,
  event_id AS update_id, kafka_partition, kafka_offset, symbol FROM good WHERE kind = 'book_ticker'""",
    "cold_stream_klines": f"""WITH {GOOD} SELECT {_LAKE_KLINE}, kafka_partition, kafka_offset, symbol, "interval"
  FROM good WHERE kind = 'kline'""",
    "cold_stream_dead_letters": f"WITH {TOPIC} {_DEAD_LETTERS.format(consumer='cold')}",
    "flush_manifest": f"""WITH {GOOD}, groups AS (
  SELECT topic, kafka_partition, symbol, CASE WHEN kind = 'kline' THEN "interval" END AS "interval",
    min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset, count(*) AS "rows" FROM good GROUP BY ALL)
SELECT *, 'p' || kafka_partition || '-off-' || lpad(CAST(min_offset AS VARCHAR), 20, '0') || '-'
  || lpad(CAST(max_offset AS VARCHAR), 20, '0') || '.parquet' AS object_name FROM groups""",
    "rows_per_flush": f"""WITH {GOOD}, groups AS (
  SELECT topic, kafka_partition, symbol, CASE WHEN kind = 'kline' THEN "interval" END AS "interval", count(*) AS n
  FROM good GROUP BY ALL)
SELECT topic, CAST(sum(n) AS BIGINT) AS "rows", count(*) AS files FROM groups GROUP BY topic""",
    "commit_offsets": f"""WITH {views.SQL_TOPIC} SELECT topic, kafka_partition AS "partition",
  max(kafka_offset) + 1 AS next_offset FROM v_topic GROUP BY topic, kafka_partition""",
    "trades_latest": f"""WITH {views.SQL_TRADES} SELECT {TRADES_TEXT} FROM v_trades WHERE symbol = '{SYMBOL}'
ORDER BY trade_time DESC, {_TIE} LIMIT 50""",
    "trades_latest_all": f"WITH {views.SQL_TRADES} SELECT {TRADES_TEXT} FROM v_trades ORDER BY trade_time DESC, {_TIE} LIMIT 100",
    "trades_unknown_symbol": f"WITH {views.SQL_TRADES} SELECT {TRADES_TEXT} FROM v_trades WHERE symbol = 'NOSUCH'",
    "trade_seed": f"""WITH {views.SQL_TRADES} SELECT {TRADES_TEXT} FROM v_trades WHERE symbol = '{SYMBOL}'
ORDER BY trade_time DESC, {_TIE} LIMIT 20""",
    "tickers_latest": f"""WITH {views.SQL_TICKERS} SELECT {TICKERS_TEXT} FROM v_tickers WHERE symbol = '{SYMBOL}'
ORDER BY update_id DESC, {_TIE} LIMIT 1000""",
    "klines_page": _klines(_ONE, 100),
    "klines_page_all": _klines("true", 1000),
    "klines_range": _klines(f"{_ONE} AND open_time BETWEEN {RANGE_MS[0]} AND {RANGE_MS[1]}", 1000),
    "klines_before": _klines(f"{_ONE} AND open_time < {RANGE_MS[0]}", 20),
    "klines_latest_per_open": f"""WITH {SERIES}, scoped AS (SELECT * FROM series WHERE {_ONE}), {_page("scoped", 100)}
SELECT {KLINES_TEXT} FROM page""",
    "candles": f"""WITH {views.SQL_KLINES}, scoped AS (SELECT * FROM v_klines WHERE {_ONE}), {_page("scoped", 1000)},
series AS ({_newest("page", "open_time", _BY_OFFSET)}) SELECT {KLINES_TEXT} FROM series ORDER BY open_time""",
    "candle_series": f"WITH {SERIES} SELECT {KLINES_TEXT} FROM series",
    "candle_direction": f"""WITH {SERIES} SELECT symbol, "interval", open_time,
  CASE WHEN close >= open THEN 'up' ELSE 'down' END AS direction FROM series""",
    "rows_as_json": f"""WITH {views.SQL_TRADES} SELECT '{{"symbol":"' || symbol || '","price":"' || price || '","quantity":"'
  || quantity || '","trade_time":' || trade_time || ',"agg_trade_id":' || agg_trade_id || ',"is_buyer_maker":'
  || is_buyer_maker || '}}' AS json FROM v_trades""",
    "newest_candle": f"""WITH {views.SQL_KLINES} SELECT symbol, "interval", max(open_time) AS newest_open_time
  FROM v_klines GROUP BY symbol, "interval\"""",
    "visible_slice": f"WITH {SERIES}, {_VISIBLE} SELECT {KLINES_TEXT} FROM visible",
    "visible_slice_page": f"""WITH {SERIES},
ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol, "interval" ORDER BY open_time) AS rank,
  count(*) OVER (PARTITION BY symbol, "interval") AS total FROM series)
SELECT {KLINES_TEXT} FROM ranked WHERE rank BETWEEN greatest(0, least(25, greatest(0, total - 40))) + 1
  AND greatest(0, least(25, greatest(0, total - 40))) + 40""",
    "price_range": f"""WITH {SERIES}, {_VISIBLE}, bounds AS (
  SELECT symbol, "interval", CAST(min(low) AS DOUBLE) AS lo, CAST(max(high) AS DOUBLE) AS hi FROM visible GROUP BY symbol, "interval"),
padded AS (SELECT *, CASE WHEN hi <> lo THEN hi - lo WHEN abs(hi) * CAST(0.001 AS DOUBLE) <> 0 THEN abs(hi) * CAST(0.001 AS DOUBLE)
  ELSE CAST(1 AS DOUBLE) END * CAST(0.08 AS DOUBLE) AS pad FROM bounds)
SELECT symbol, "interval", lo - pad AS range_min, hi + pad AS range_max FROM padded""",
    "live_trade": f"""WITH {GOOD}, latest AS ({_newest("good WHERE kind = 'agg_trade'", "symbol", _ARRIVAL)})
SELECT symbol, CAST(price AS VARCHAR) AS price, CAST(quantity AS VARCHAR) AS quantity, ms AS trade_time,
  event_id AS agg_trade_id, event_id % 2 = 0 AS is_buyer_maker,
  CASE WHEN event_id % 2 = 0 THEN 'sell' ELSE 'buy' END AS side FROM latest ORDER BY symbol""",
    "live_book_ticker": f"""WITH {GOOD}, latest AS ({_newest("good WHERE kind = 'book_ticker'", "symbol", _ARRIVAL)})
SELECT symbol, CAST(price AS VARCHAR) AS best_bid_price, CAST(quantity AS VARCHAR) AS best_bid_qty,
  CAST(ask AS VARCHAR) AS best_ask_price, CAST(ask_qty AS VARCHAR) AS best_ask_qty, event_id AS update_id,
  CAST(CAST(ask - price AS DECIMAL(38,2)) AS VARCHAR) AS spread FROM latest ORDER BY symbol""",
    "live_kline": f"""WITH {GOOD}, latest AS ({_newest("good WHERE kind = 'kline'", 'symbol, "interval"', _ARRIVAL)})
SELECT symbol || ':' || "interval" AS id, symbol, "interval" AS bar_interval, {_LAKE_KLINE} FROM latest""",
    "live_window": f"WITH {LIVE_WINDOW} SELECT symbol || ':' || open_time AS id, symbol, {_LAKE_KLINE} FROM held",
    "live_window_symbol": f"""WITH {LIVE_WINDOW} SELECT symbol || ':' || open_time AS id, symbol, {_LAKE_KLINE}
  FROM held WHERE symbol = '{SYMBOL}'""",
    "live_window_count": f"WITH {LIVE_WINDOW} SELECT count(*) AS n FROM held",
    "live_fanout": f"""WITH {LIVE_WINDOW} SELECT 'live_kline' AS live_table, "interval", count(DISTINCT symbol) AS "rows"
  FROM good WHERE kind = 'kline' GROUP BY "interval"
UNION ALL SELECT 'live_kline_second', '1s', count(DISTINCT symbol) FROM held""",
    "live_sql": f"""WITH {GOOD} SELECT symbol, count(DISTINCT "interval") AS n FROM good WHERE kind = 'kline' GROUP BY symbol""",
    "live_subscription": f"""WITH {GOOD}, latest AS ({_newest("good WHERE kind = 'agg_trade'", "symbol", _ARRIVAL)})
SELECT symbol, CAST(price AS VARCHAR) AS price, CAST(quantity AS VARCHAR) AS quantity, ms AS trade_time,
  event_id AS agg_trade_id, event_id % 2 = 0 AS is_buyer_maker FROM latest""",
    "window_batch": f"""WITH {views.SQL_KLINES}, seconds AS (SELECT * FROM v_klines WHERE "interval" = '1s'), {_window("seconds")}
SELECT CAST(open AS VARCHAR) AS open, CAST(high AS VARCHAR) AS high, CAST(low AS VARCHAR) AS low,
  CAST(close AS VARCHAR) AS close, CAST(volume AS VARCHAR) AS volume, CAST(quote_volume AS VARCHAR) AS quote_volume,
  trade_count, open_time, close_time, is_closed, symbol FROM held""",
    "merged_chart": f"""WITH {LIVE_WINDOW}, chart AS (SELECT * FROM seconds WHERE symbol = '{SYMBOL}'), {_page("chart", 1000)},
history AS ({_newest("page", "open_time", _BY_OFFSET)}),
both_views AS (
  SELECT symbol, open_time, price, high, low, close, quantity, trade_count, 0 AS live FROM history
  UNION ALL SELECT symbol, open_time, price, high, low, close, quantity, trade_count, 1 FROM held WHERE symbol = '{SYMBOL}'),
merged AS ({_newest("both_views", "open_time", "live DESC")})
SELECT symbol, CAST(price AS VARCHAR) AS open, CAST(high AS VARCHAR) AS high, CAST(low AS VARCHAR) AS low,
  CAST(close AS VARCHAR) AS close, CAST(quantity AS VARCHAR) AS volume, trade_count, open_time,
  CASE WHEN close >= price THEN 'up' ELSE 'down' END AS direction FROM merged ORDER BY open_time""",
    "merge_all_series": f"""WITH {SERIES}, newer AS (SELECT * REPLACE (high AS close) FROM series WHERE open_time >= {CUTOFF_MS})
SELECT symbol, "interval", {_CANDLE_TEXT} FROM (
  SELECT * FROM newer UNION ALL SELECT * FROM series AS s WHERE NOT EXISTS (
    SELECT 1 FROM newer AS n WHERE n.symbol = s.symbol AND n."interval" = s."interval" AND n.open_time = s.open_time))""",
    "live_candles": f"""WITH {LIVE_WINDOW} SELECT symbol, CAST(price AS VARCHAR) AS open, CAST(high AS VARCHAR) AS high,
  CAST(low AS VARCHAR) AS low, CAST(close AS VARCHAR) AS close, CAST(quantity AS VARCHAR) AS volume, trade_count, open_time
  FROM held""",
    "rest_rows_to_klines": _rest_select("row_id, "),
    "rest_rows_rejected": f"""WITH {views.SQL_REST} SELECT row_id, 'field ' || CASE fault WHEN 11 THEN 6 WHEN 13 THEN 4
  WHEN 17 THEN 7 ELSE 7 END || ' is missing or has a wrong value' AS error FROM rest WHERE bad""",
    "landed_history": _rest_select(""),
    "landed_rejected": f"""WITH {views.SQL_REST}, errors AS (
  SELECT symbol, CASE fault WHEN 11 THEN '6' WHEN 13 THEN '4' ELSE '7' END AS field FROM rest WHERE bad
  UNION ALL SELECT symbol, '0' FROM (SELECT DISTINCT symbol, row_id // 1000 AS page FROM rest), (SELECT unnest([1, 2]))) 
SELECT symbol, 'field ' || field || ' is missing or has a wrong value' AS error, count(*) AS "rows" FROM errors GROUP BY ALL""",
    "backfill_union": f"""WITH {GOOD}, {views.SQL_REST}
SELECT 'market.klines' AS topic, symbol AS key, "interval", open_time, CAST(price AS VARCHAR) AS open, CAST(close AS VARCHAR) AS close,
  CAST(quantity AS VARCHAR) AS volume, event_id AS first_trade_id, event_id % 3 = 0 AS is_closed FROM good WHERE kind = 'kline'
UNION ALL SELECT 'market.klines', symbol, '1d', day, CAST(price AS VARCHAR), CAST(price AS VARCHAR), o_custkey || '.5', -1,
  day + 86399999 < {views.REST_NOW_MS} FROM rest WHERE NOT bad""",
    "lake_two_checkpoints": f"""WITH {GOOD} SELECT CAST(price AS VARCHAR) AS price, CAST(quantity AS VARCHAR) AS quantity,
  ms AS trade_time, event_id AS agg_trade_id, event_id % 2 = 0 AS is_buyer_maker, kafka_partition, kafka_offset, symbol
  FROM good WHERE kind = 'agg_trade'""",
    "pages_cover_all_rows": f"""WITH {views.SQL_KLINES} SELECT {KLINES_TEXT} FROM v_klines
  WHERE symbol = '{SYMBOL}' AND "interval" = '1d' AND is_closed""",
    "invalid_intervals": f"""WITH marked AS (SELECT CASE o_orderkey % 3 WHEN 0 THEN '1h' WHEN 1 THEN '10m' ELSE o_orderpriority END
  AS "interval" FROM orders)
SELECT "interval", count(*) AS "rows" FROM marked WHERE "interval" NOT IN ({_VALID}) GROUP BY "interval\"""",
    "interval_lists": f"""WITH {views.SQL_BASE} SELECT event_id, "interval" || ',24h,1w' AS items,
  CAST(2 AS BIGINT) AS valid FROM base""",
    "symbol_validation": """SELECT event_type AS symbol, upper(event_type) AS exchange_symbol, lower(event_type) AS stream_symbol,
  upper(event_type) IN ('CLICK', 'VIEW') AS is_allowed, count(*) AS "rows" FROM events GROUP BY event_type""",
    "feed_coverage": f"""WITH {FRAMES}, symbols AS (SELECT DISTINCT symbol FROM base),
feeds AS (SELECT unnest(['aggTrade', 'bookTicker', 'kline_1s', 'kline_1m', 'kline_1h', 'kline_1d', 'kline_1w']) AS feed),
expected AS (SELECT symbol, lower(symbol) || '@' || feed AS stream FROM symbols, feeds)
SELECT stream, symbol FROM expected WHERE stream NOT IN (
  SELECT stream FROM kinds WHERE kind IN ('agg_trade', 'book_ticker', 'kline'))""",
    "series_staleness": f"""WITH {views.SQL_KLINES}, newest AS (
  SELECT symbol, "interval", max(open_time) AS newest_open_time FROM v_klines GROUP BY symbol, "interval"),
aged AS (SELECT *, (SELECT max(newest_open_time) FROM newest) - newest_open_time AS age_ms FROM newest)
SELECT symbol, "interval", newest_open_time, age_ms, age_ms // CASE "interval" {_LENGTHS} END AS candles_behind FROM aged""",
    "compaction_preserves_rows": f"WITH {views.SQL_KLINES} SELECT {KLINES_TEXT} FROM v_klines",
    "retention_cut": f"WITH {views.SQL_TRADES} SELECT {TRADES_TEXT} FROM v_trades WHERE trade_time >= {CUTOFF_MS}",
    "date_partition_scan": f"""WITH {views.SQL_TRADES}
SELECT {TRADES_TEXT}, CAST(to_timestamp(trade_time / 1000) AT TIME ZONE 'UTC' AS DATE) AS event_date FROM v_trades
WHERE CAST(to_timestamp(trade_time / 1000) AT TIME ZONE 'UTC' AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'""",
}

# A second query with a new checkpoint ends in the same state as one that went on.
ORACLES["live_new_checkpoint"] = ORACLES["live_trade"]
# Pages that read only the newest directories have the rows of those over a whole series.
ORACLES["trades_newest_days"] = ORACLES["trades_latest"]
ORACLES["klines_newest_days"] = ORACLES["klines_page"]
ORACLES["candles_newest_days"] = ORACLES["candles"]
ORACLES["klines_window"] = ORACLES["klines_range"]
ORACLES["tickers_newest_flushes"] = f"""WITH {views.SQL_TICKERS} SELECT {TICKERS_TEXT} FROM v_tickers WHERE symbol = '{SYMBOL}'
ORDER BY update_id DESC, {_TIE} LIMIT 100"""
ORACLES["trades_window_all"] = f"""WITH {views.SQL_TRADES} SELECT {TRADES_TEXT} FROM v_trades
WHERE trade_time BETWEEN {RANGE_MS[0]} AND {RANGE_MS[1]}"""
ORACLES["compaction_in_place"] = ORACLES["cold_stream_klines"]
ORACLES["retention_drops_days"] = f"WITH {views.SQL_TRADES} SELECT {TRADES_TEXT} FROM v_trades WHERE trade_time >= {INSIDE_DAY_MS}"

# The state after several batches, or a new checkpoint, is that of one long batch.
for _name_of in ("live_changes_window", "live_window_batches", "live_window_new_checkpoint"):
    ORACLES[_name_of] = ORACLES["live_window"]


def _changes(live_table: str, rows: str, keys: str) -> str:
    """Per batch the keys seen first and the keys whose row is another than before."""
    return f"""SELECT '{live_table}' AS live_table, batch, CASE WHEN before IS NULL THEN 'insert' ELSE 'update' END AS change,
  count(*) AS "rows" FROM (
    SELECT batch, state, lag(state) OVER (PARTITION BY {keys} ORDER BY batch) AS before FROM (
      SELECT {keys}, batch, {rows} AS state FROM batched WHERE live_table = '{live_table}'
      QUALIFY row_number() OVER (PARTITION BY {keys}, batch ORDER BY {_ARRIVAL}) = 1))
  WHERE before IS NULL OR state <> before GROUP BY ALL"""


_BATCHED = GOOD + f""",
batched AS (SELECT * REPLACE (CASE WHEN kind = 'kline' THEN "interval" ELSE '' END AS "interval"),
  CASE kind WHEN 'agg_trade' THEN 'live_trade' WHEN 'book_ticker' THEN 'live_book_ticker' ELSE 'live_kline' END AS live_table,
  CAST(floor(kafka_offset * {BATCHES} / (SELECT max(kafka_offset) + 1 FROM v_topic)) AS BIGINT) AS batch FROM good)"""
ORACLES["live_changes"] = f"WITH {_BATCHED} " + " UNION ALL ".join((
    _changes("live_trade", "[CAST(event_id AS VARCHAR)]", "symbol"), _changes("live_book_ticker", "[CAST(event_id AS VARCHAR)]", "symbol"),
    _changes("live_kline", "[CAST(event_id AS VARCHAR)]", 'symbol, "interval"')))

ORACLES["path_metrics"] = f"""WITH {TOPIC}, done AS (
  SELECT topic, count(*) FILTER (error IS NULL) AS applied, count(*) FILTER (error IS NOT NULL) AS dead_lettered FROM kinds GROUP BY topic),
read_ AS (SELECT topic, count(*) AS records, count(*) FILTER (value IS NULL) AS empty_payloads FROM v_topic GROUP BY topic)
SELECT path, topic, records, empty_payloads, applied, dead_lettered FROM read_ JOIN done USING (topic),
  (VALUES ('cold'), ('hot')) AS paths(path)"""

# One arrival at a time.
ORACLES["live_window_out_of_order"] = f"""WITH RECURSIVE {GOOD},
seconds AS (SELECT *, kafka_offset * {SHUFFLE[0]} % {SHUFFLE[1]} AS arrival FROM good WHERE kind = 'kline' AND "interval" = '1s'),
steps AS (SELECT symbol, open_time, row_number() OVER (PARTITION BY symbol ORDER BY kafka_partition, arrival) AS step FROM seconds),
replay AS (
  SELECT DISTINCT symbol, CAST(0 AS BIGINT) AS step, CAST([] AS BIGINT[]) AS times FROM steps
  UNION ALL
  SELECT symbol, s.step, CASE WHEN list_contains(times, open_time) THEN times
    WHEN len(times) >= {WINDOW_KEEP + WINDOW_SLACK} THEN list_sort(list_append(times, open_time), 'DESC')[1:{WINDOW_KEEP}]
    ELSE list_append(times, open_time) END
  FROM replay JOIN steps AS s USING (symbol) WHERE s.step = replay.step + 1),
held AS (SELECT symbol, unnest(times) AS open_time FROM (
  SELECT * FROM replay QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY step DESC) = 1)),
newest AS (SELECT * FROM seconds
  QUALIFY row_number() OVER (PARTITION BY symbol, open_time ORDER BY kafka_partition DESC, arrival DESC) = 1)
SELECT symbol || ':' || open_time AS id, symbol, {_LAKE_KLINE} FROM newest SEMI JOIN held USING (symbol, open_time)"""
ORACLES["recorder_stream"] = ORACLES["raw_frame_recorder"]
