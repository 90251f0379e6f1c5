import json

import pytest
from pyspark.sql import functions as F

from tests.samples import CANDLE, KLINE, TICKER, TRADE, envelope, frame, records
from tickloom.operators import decode, encode, stats
from tickloom.sources.frames import not_blank, read_frames


def decode_texts(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string")
    return {r["id"]: r for r in decode.decode_frames(df).collect()}


def test_documented_payloads(spark):
    rows = decode_texts(spark, [
        frame("novausd@aggTrade", TRADE), frame("novausd@bookTicker", TICKER), frame("novausd@kline_1m", KLINE),
    ])
    assert [rows[i]["kind"] for i in range(3)] == ["agg_trade", "book_ticker", "kline"]
    assert all(rows[i]["error"] is None for i in range(3))
    trade = rows[0]["agg_trade"]
    assert (trade["price"], trade["quantity"], trade["agg_trade_id"], trade["is_buyer_maker"]) == ("1234.70", "2.25", 8807, True)
    assert rows[1]["book_ticker"]["best_bid_price"] == "7.25100000"
    assert rows[1]["book_ticker"]["best_ask_qty"] == "95.02"
    candle = rows[2]["kline"]
    assert (candle["open_time"], candle["close_time"], candle["first_trade_id"], candle["last_trade_id"]) == (
        1711111080000, 1711111139999, 8700, 8955)
    assert (candle["quote_volume"], candle["taker_buy_quote_volume"], candle["volume"]) == ("7923.5500", "3721.250", "640")
    assert rows[0]["kline"] is None and rows[2]["agg_trade"] is None


REJECTED = [
    ("not json", "malformed text"),
    ('{"stream":"novausd@aggTrade"', "malformed text"),
    ('{"stream":"novausd@aggTrade"}', "malformed text"),
    ('{"data":{}}', "malformed text"),
    ("[]", "malformed text"),
    ('{"stream":5,"data":{}}', "malformed text"),
    ('{"stream":{"a":"x@kline_1m"},"data":{}}', "malformed text"),
    ("{'stream':'novausd@aggTrade','data':{}}", "malformed text"),
    (frame("novausd@aggTrade", TRADE) + " x", "malformed text"),
    (frame("novausd@aggTrade", TRADE) + frame("novausd@aggTrade", TRADE), "malformed text"),
    (frame("novausd@aggTrade", TRADE) + "," + frame("novausd@aggTrade", TRADE), "malformed text"),
    (frame("novausd@aggTrade", TRADE) + "] [" + frame("novausd@aggTrade", TRADE), "malformed text"),
    (frame("novausd@aggTrade", TRADE) + "} ]", "malformed text"),
    (frame("novausd@depth", TRADE), "no route for stream `novausd@depth`"),
    (frame("novausd", TRADE), "no route for stream `novausd`"),
    (frame("a@b@aggTrade", TRADE), "no route for stream `a@b@aggTrade`"),
    (frame("novausd@aggTrade", "{}"), "field `e`"),
    (frame("novausd@aggTrade", {**TRADE, "p": 1234.5}), "field `p`"),
    (frame("novausd@aggTrade", {**TRADE, "p": "abc"}), "field `p`"),
    (frame("novausd@aggTrade", {**TRADE, "p": " 1.5 "}), "field `p`"),
    (frame("novausd@aggTrade", {**TRADE, "p": "1."}), "field `p`"),
    (frame("novausd@aggTrade", {**TRADE, "p": "79228162514264337593543950336"}), "field `p`"),
    (frame("novausd@aggTrade", {**TRADE, "E": "5"}), "field `E`"),
    (frame("novausd@aggTrade", {**TRADE, "E": 5.5}), "field `E`"),
    (frame("novausd@aggTrade", {**TRADE, "E": 2**63}), "field `E`"),
    (frame("novausd@aggTrade", {**TRADE, "a": "5"}), "field `a`"),
    (frame("novausd@aggTrade", {**TRADE, "a": 2**63}), "field `a`"),
    (frame("novausd@aggTrade", {**TRADE, "m": "true"}), "field `m`"),
    (frame("novausd@aggTrade", {**TRADE, "s": 7}), "field `s`"),
    (frame("novausd@aggTrade", {**TRADE, "s": ""}), "field `s`"),
    (frame("novausd@aggTrade", {**TRADE, "s": "", "x": 1}), "field `s`"),
    (frame("novausd@kline_1m", {**KLINE, "k": {**CANDLE, "s": ""}}), "field `s`"),
    (frame("novausd@bookTicker", TICKER)[:-2] + ',"A":"9"}}', "malformed text"),
    (frame("novausd@aggTrade", {**TRADE, "s": None}), "field `s`"),
    (frame("novausd@bookTicker", {**TICKER, "A": 1}), "field `A`"),
    (frame("novausd@kline_1m", {**KLINE, "k": {k: v for k, v in CANDLE.items() if k != "n"}}), "field `n`"),
    (frame("novausd@kline_1m", {**KLINE, "k": {**CANDLE, "Q": "1e3"}}), "field `Q`"),
    (frame("novausd@kline_1m", {k: v for k, v in KLINE.items() if k != "k"}), "field `t`"),
]


def test_rejected(spark):
    rows = decode_texts(spark, [text for text, _ in REJECTED])
    assert len(rows) == len(REJECTED)
    for i, (text, error) in enumerate(REJECTED):
        assert rows[i]["kind"] is None, text
        assert error in rows[i]["error"], (text, rows[i]["error"])


def test_accepted_variants(spark):
    rows = decode_texts(spark, [
        "  " + json.dumps({"data": TRADE, "stream": "novausd@aggTrade", "extra": [1, {"a": "]"}]}, indent=1) + " ",
        frame("novausd@aggTrade", {**TRADE, "M": [True], "u": "ignored", "k": 5}),
        frame("novausd@aggTrade", {**TRADE, "p": "-0007.10", "q": "79228162514264337593543950335"}),
        frame("novausd@aggTrade", {**TRADE, "s": 'q"]\\ü'}),
        frame("x@kline_anything", {**KLINE, "k": {**CANDLE, "i": "77x"}}),
        frame("novausd@aggTrade", {**TRADE, "a": 2**63 - 1}),
    ])
    assert all(r["error"] is None for r in rows.values())
    assert rows[2]["agg_trade"]["price"] == "-7.10"
    assert rows[2]["agg_trade"]["quantity"] == "79228162514264337593543950335"
    assert rows[3]["agg_trade"]["symbol"] == 'q"]\\ü'
    assert rows[4]["kline"]["interval"] == "77x"
    assert rows[5]["agg_trade"]["agg_trade_id"] == 2**63 - 1


def test_control_frame_comes_before_routing(spark):
    rows = decode_texts(spark, [
        frame("!serverShutdown", {"e": "serverShutdown", "E": 1}), frame("!serverShutdown", None),
        frame("!serverShutdown", 5), '{"stream":"!serverShutdown"}',
    ])
    assert [rows[i]["kind"] for i in range(4)] == ["control", "control", "control", None]


def malformed(spark):
    texts = [
        frame("novausd@aggTrade", TRADE), frame("novausd@depth", {}), '{"stream":"novausd@aggTrade","data":{"e"',
        frame("novausd@bookTicker", {**TICKER, "b": "not-a-number"}), frame("novausd@kline_1m", KLINE), "", " \t",
    ]
    return decode.decode_frames(not_blank(spark.createDataFrame([(t,) for t in texts], "value string")))


def test_stats_and_budget(spark):
    counted = stats.decode_stats(malformed(spark))
    assert counted.first().asDict() == {
        "events": 2, "agg_trades": 1, "book_tickers": 0, "klines": 1, "decode_errors": 3, "server_shutdowns": 0,
    }
    assert stats.stats_line(counted).first()["line"] == (
        "2 events (agg_trade=1, book_ticker=0, kline=1); 3 decode errors; 0 server-shutdowns"
    )
    stats.require_error_budget(counted, 3)
    with pytest.raises(ValueError, match="too many undecodable frames"):
        stats.require_error_budget(counted, 2)


def test_recorded_session_shape(spark, tmp_path):
    lines = []
    for i in range(150):
        symbol = "NOVAUSD" if i % 3 else "ZEDAEUR"
        if i < 23:
            lines.append(frame(f"{symbol.lower()}@aggTrade", {**TRADE, "s": symbol, "a": i}))
        elif i < 148:
            lines.append(frame(f"{symbol.lower()}@bookTicker", {**TICKER, "s": symbol, "u": i}))
        else:
            lines.append(frame(f"{symbol.lower()}@kline_1m", {**KLINE, "s": symbol}))
    (tmp_path / "stream.ndjson").write_text("\n".join(lines) + "\n\n")
    row = stats.decode_stats(decode.decode_frames(read_frames(spark, str(tmp_path)))).first()
    assert (row["events"], row["agg_trades"], row["book_tickers"], row["klines"], row["decode_errors"]) == (150, 23, 125, 2, 0)


def test_carriage_returns_stay_in_a_frame(spark, tmp_path):
    (tmp_path / "frames").write_bytes(frame("novausd@aggTrade", TRADE).replace(",", ",\r").encode() + b"\n\n")
    assert [r["kind"] for r in decode.decode_frames(read_frames(spark, str(tmp_path))).collect()] == ["agg_trade"]


def test_snippet_never_splits_a_character(spark):
    df = spark.createDataFrame([("é" * 300,)], "value string")
    row = decode.with_snippet(decode.bad_rows(decode.decode_frames(df))).first()
    assert row["snippet"] == "é" * 128


def test_envelope_round_trip(spark):
    texts = [frame("novausd@aggTrade", TRADE), frame("novausd@bookTicker", TICKER), frame("novausd@kline_1m", KLINE)]
    decoded = decode.decode_frames(spark.createDataFrame([(t,) for t in texts], "value string"))
    rows = {r["event_type"]: r for r in encode.to_topic_rows(decoded).collect()}
    assert {k: (r["topic"], r["key"]) for k, r in rows.items()} == {
        "agg_trade": ("market.trades", "NOVAUSD"), "book_ticker": ("market.book-tickers", "NOVAUSD"),
        "kline": ("market.klines", "NOVAUSD"),
    }
    without = lambda payload, key: {k: v for k, v in payload.items() if k != key}
    assert json.loads(rows["agg_trade"]["value"]) == {
        "event_type": "agg_trade", "schema_version": 1, "payload": without(TRADE, "M")}
    assert json.loads(rows["kline"]["value"])["payload"] == {**KLINE, "k": without(CANDLE, "B")}
    again = decode.decode_envelopes(records(spark, [
        (r["key"], r["value"], r["topic"], 0, i) for i, r in enumerate(rows.values())
    ]))
    assert again.filter("error IS NOT NULL").count() == 0
    assert again.filter("kind = 'kline'").select("kline.*").first() == decoded.filter("kind = 'kline'").select("kline.*").first()


def test_envelope_errors_and_dead_letters(spark):
    rows = records(spark, [
        ("A", envelope("agg_trade", TRADE), "market.trades", 1, 10),
        ("A", envelope("mystery", TRADE), "market.trades", 1, 11),
        ("A", "not json", "market.trades", 1, 12),
        ("A", None, "market.trades", 1, 13),
        (None, envelope("kline", TRADE), "market.klines", 2, 14),
        ("A", envelope("agg_trade", TRADE, version=9), "market.klines", 1, 15),
        ("A", '{"event_type":"agg_trade"}', "market.trades", 1, 16),
    ])
    decoded = decode.decode_envelopes(rows)
    errors = {r["offset"]: r["error"] for r in decoded.collect()}
    assert 13 not in errors and errors[10] is None and errors[15] is None
    assert errors[11] == "no such event type: `mystery`"
    assert errors[12] == errors[16] == "not an envelope"
    assert errors[14].startswith("bad candle: field `t`")
    parked = {json.loads(r["offset"]): r for r in encode.dead_letters(decoded, "cold").withColumn(
        "offset", F.expr("cast(map_from_entries(headers)['dlq.offset'] as string)")).collect()}
    assert sorted(parked) == [11, 12, 14, 16]
    assert parked[12]["value"] == bytearray(b"not json") and parked[12]["key"] == bytearray(b"A")
    assert parked[14]["topic"] == "market.klines.dlq" and parked[14]["key"] == bytearray(b"")
    assert {h["key"]: bytes(h["value"]).decode() for h in parked[12]["headers"]} == {
        "dlq.error": "not an envelope", "dlq.source_topic": "market.trades", "dlq.partition": "1", "dlq.offset": "12",
    }
    strict = {r["offset"]: r["error"] for r in decode.decode_envelopes(rows, strict_version=True).collect()}
    assert strict[15] == "other schema version: 9" and strict[10] is None


def test_text_is_parsed_once(spark, tmp_path):
    spark.createDataFrame([(frame("a@aggTrade", TRADE),)], "value string").write.mode("overwrite").parquet(str(tmp_path))
    frames = spark.read.parquet(str(tmp_path))
    plan = decode.events_of(decode.decode_frames(frames), "agg_trade")._jdf.queryExecution().executedPlan().toString()
    # Texts in the documented layout; all others; and of these those that hold a bracket.
    assert plan.count("from_json(") == 3


def test_layout_and_general_way_agree(spark):
    texts = {}
    for stream, payload in (("novausd@aggTrade", TRADE), ("novausd@bookTicker", TICKER), ("novausd@kline_1m", KLINE)):
        compact = frame(stream, payload)
        spaced = json.dumps({"stream": stream, "data": payload})
        back_to_front = json.dumps({"data": dict(reversed(payload.items())), "stream": stream})
        texts[stream] = [compact, spaced, back_to_front, compact + " ", compact + "\n"]
    rows = decode_texts(spark, [text for group in texts.values() for text in group])
    for at, group in enumerate(texts.values()):
        same = [rows[at * 5 + i] for i in range(5)]
        assert all(r["error"] is None for r in same)
        assert len({(r["kind"], str(r["agg_trade"]), str(r["book_ticker"]), str(r["kline"])) for r in same}) == 1


def test_bytes_that_are_no_text_are_dead(spark):
    value = envelope("agg_trade", {**TRADE, "s": "A"}).encode().replace(b'"A"', b'"\xff"')
    rows = records(spark, [("A", None, "market.trades", 0, 1)]).withColumn("value", F.lit(value))
    row = decode.decode_envelopes(rows).first()
    assert (row["kind"], row["error"]) == (None, "not an envelope")


def test_symbols_may_differ(spark):
    from tickloom.operators.quality import symbol_mismatches

    odd = {**KLINE, "s": "OTHER"}
    decoded = decode.decode_envelopes(records(spark, [("OTHER", envelope("kline", odd), "market.klines", 0, 1)]))
    assert symbol_mismatches(decoded).collect() == [("OTHER", "NOVAUSD", 1)]
    assert decode.lake_rows(decoded, decode.KLINES).first()["symbol"] == "NOVAUSD"
    assert encode.to_topic_rows(decoded.drop("key", "value", "topic")).first()["key"] == "OTHER"
