import json

from tickloom.operators import decode, encode
from tickloom.sources import history

ROW = [1262304000000, "88.10", "91.45", "86.02", "90.77", "15230.5", 1262908799999, "1356000.125", 512, "7600.25",
       "676511.9", "0"]


def rows_of(spark, values, now_ms=1270000000000):
    df = spark.createDataFrame([("NOVAUSD", "1w", json.dumps(v) if not isinstance(v, str) else v) for v in values],
                               "symbol string, interval string, row_text string")
    return history.decode_rows(history.parse_row_text(df), now_ms)


def test_row_mapping(spark):
    decoded = rows_of(spark, [ROW])
    row = decode.events_of(decoded, "kline").first()
    assert (row["open_time"], row["close_time"], row["open"], row["volume"], row["trade_count"]) == (
        1262304000000, 1262908799999, "88.10", "15230.5", 512)
    assert (row["first_trade_id"], row["last_trade_id"], row["symbol"], row["interval"]) == (-1, -1, "NOVAUSD", "1w")
    assert row["is_closed"] and row["event_time"] == 1270000000000 and row["event_type"] == "kline"


def test_closed_is_strictly_before_now(spark):
    for now, closed in ((1262908799999, False), (1262908800000, True)):
        assert decode.events_of(rows_of(spark, [ROW], now), "kline").first()["is_closed"] is closed


def test_bad_rows_are_kept_aside(spark):
    def with_value(at, value):
        return [*ROW[:at], value, *ROW[at + 1:]]

    bad = [ROW[:5], with_value(1, 0.5), with_value(0, "1262304000000"), with_value(6, 1.5), with_value(7, "1e3"), "[", "{}", [None] * 12]
    decoded = rows_of(spark, [*bad, ROW])
    assert decoded.filter("error IS NULL").count() == 1
    errors = [r["error"] for r in decoded.filter("error IS NOT NULL").collect()]
    assert len(errors) == len(bad) and errors[1].startswith("field 1 ") and errors[2].startswith("field 0 ")


def test_landed_responses(spark, tmp_path):
    folder = tmp_path / "symbol=NOVAUSD" / "interval=1d"
    folder.mkdir(parents=True)
    (folder / "page").write_text(json.dumps([ROW, ROW[:3]]) + "\n" + json.dumps([ROW]) + "\n")
    failed = tmp_path / "symbol=ZEDAEUR" / "interval=3d"
    failed.mkdir(parents=True)
    (failed / "page").write_text('{"code":-1121,"msg":"Invalid symbol."}\n')
    decoded = history.decode_rows(history.response_rows(history.read_responses(spark, str(tmp_path))), 0)
    assert decoded.filter("kind = 'kline'").count() == 2 and decoded.count() == 4
    assert {(r["interval"], r["error"]) for r in decoded.filter("kind IS NULL").collect()} == {
        ("1d", "field 3 is missing or has a wrong value"), ("3d", "field 0 is missing or has a wrong value")}


def test_no_response_goes_unseen(spark):
    texts = {"both": [ROW, 5], "object": [ROW, {}], "empty": [], "cut": None, "null": None}
    rows = [(k, json.dumps(v)) for k, v in texts.items() if v is not None] + [("cut", json.dumps([ROW, ROW])[:-4]), ("null", None)]
    df = spark.createDataFrame([(k, "1d", v) for k, v in rows], "symbol string, interval string, value string")
    decoded = history.decode_rows(history.response_rows(df), 0).collect()
    count = lambda k, good: sum(r["symbol"] == k and (r["kind"] == "kline") == good for r in decoded)
    assert [(count(k, True), count(k, False)) for k in texts] == [(1, 1), (1, 1), (0, 0), (0, 1), (0, 1)]


def test_backfill_joins_the_live_topic(spark):
    decoded = rows_of(spark, [ROW])
    live = decode.decode_frames(spark.createDataFrame([], "value string"))
    assert [decoded.schema[k].dataType for k in ("agg_trade", "book_ticker")] == [live.schema[k].dataType for k in ("agg_trade", "book_ticker")]
    row = encode.to_topic_rows(decoded).first()
    assert (row["topic"], row["key"]) == ("market.klines", "NOVAUSD")
    payload = json.loads(row["value"])["payload"]
    assert payload["k"]["f"] == -1 and payload["k"]["o"] == "88.10"
