"""Hand-made frames in the documented shapes."""

import json

TRADE = {
    "e": "aggTrade", "E": 1711111111250, "s": "NOVAUSD", "a": 8807, "p": "1234.70", "q": "2.25", "f": 8800, "l": 8812,
    "T": 1711111111240, "m": True, "M": True,
}
TICKER = {"u": 77, "s": "NOVAUSD", "b": "7.25100000", "B": "310.4", "a": "7.2519", "A": "95.02"}
CANDLE = {
    "t": 1711111080000, "T": 1711111139999, "s": "NOVAUSD", "i": "1m", "f": 8700, "L": 8955, "o": "12.40", "c": "12.85",
    "h": "13.05", "l": "12.15", "v": "640", "n": 256, "x": False, "q": "7923.5500", "V": "301", "Q": "3721.250", "B": "0",
}
KLINE = {"e": "kline", "E": 1711111111300, "s": "NOVAUSD", "k": CANDLE}


def frame(stream, data):
    return json.dumps({"stream": stream, "data": data}, separators=(",", ":"))


def envelope(event_type, payload, version=1):
    return json.dumps({"event_type": event_type, "schema_version": version, "payload": payload}, separators=(",", ":"))


def candle_payload(symbol, interval, open_time, close="1.5", closed=False):
    return {
        **KLINE, "s": symbol,
        "k": {**CANDLE, "s": symbol, "i": interval, "t": open_time, "T": open_time + 999, "c": close, "x": closed},
    }


def records(spark, rows):
    """Topic records from (key, value, topic, partition, offset)."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset bigint")
    return df.select(
        F.encode("key", "UTF-8").alias("key"), F.encode("value", "UTF-8").alias("value"), "topic", "partition", "offset",
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
    )
