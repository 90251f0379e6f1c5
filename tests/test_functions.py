from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickloom.functions import decimals, market
from tickloom.operators.quality import feed_coverage, require_stream_limit, series_staleness, stream_catalogue
from tickloom.schemas import INTERVAL_MS, VALID_INTERVALS


def test_lake_decimal(spark):
    cases = {
        "731.25": "731.25000000", "0.7": "0.70000000", "0.00000003": "0.00000003", "0.000000025": "0.00000003",
        "0": "0.00000000", "-2.75": "-2.75000000", " 1": None, "1e3": None, "abc": None, "1" * 31: None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string").select("t", decimals.to_lake_decimal("t").alias("d"))
    assert {r["t"]: None if r["d"] is None else f"{r['d']:.8f}" for r in df.collect()} == cases


def test_decimals_to_text(spark):
    df = spark.createDataFrame([(Decimal("731.25"), 3)], "a decimal(38,8), b int")
    assert decimals.decimals_to_text(df).first().asDict() == {"a": "731.25000000", "b": 3}
    big = spark.sql("SELECT CAST('81985529216486.95' AS DECIMAL(38,8)) AS a, CAST(0 AS DECIMAL(38,8)) AS z")
    assert decimals.decimals_to_text(big).first().asDict() == {"a": "81985529216486.95000000", "z": "0.00000000"}


def test_limits():
    assert [market.page_size(n) for n in (None, 7, 0, 20_000)] == [100, 7, 1, 20_000]
    assert [market.page_size(n, most=1000) for n in (None, 7, 20_000)] == [100, 7, 1000]


def test_intervals(spark):
    assert set(INTERVAL_MS) == set(VALID_INTERVALS)
    df = spark.createDataFrame([("1w",), ("1M",), ("77x",)], "i string")
    assert [r[0] for r in df.select(market.interval_ms(F.col("i"))).collect()] == [604800000, 2592000000, None]


def test_small_expressions(spark):
    row = spark.range(1).select(
        market.dlq_topic(F.lit("market.trades")).alias("dlq"),
        market.composite_key(F.lit("A"), F.lit(5)).alias("key"),
        market.aggressor_side(F.lit(True)).alias("side"),
        market.candle_direction(F.lit(1), F.lit(1)).alias("direction"),
        market.spread(F.lit(Decimal("1.10")).cast("decimal(38,8)"), F.lit(Decimal("1.234")).cast("decimal(38,8)")).alias("spread"),
    ).first()
    assert row.asDict() == {
        "dlq": "market.trades.dlq", "key": "A:5", "side": "sell", "direction": "up", "spread": Decimal("0.13"),
    }


def test_feed_catalogue(spark):
    symbols = spark.createDataFrame([("NOVAUSD",), ("ZEDAEUR",)], "symbol string")
    expected = stream_catalogue(symbols, ["1s", "1m"])
    assert sorted(r["stream"] for r in expected.collect())[:4] == [
        "novausd@aggTrade", "novausd@bookTicker", "novausd@kline_1m", "novausd@kline_1s"]
    observed = spark.createDataFrame([("novausd@aggTrade",)] * 3, "stream string")
    assert feed_coverage(expected, observed).count() == 7
    assert require_stream_limit(["A", "B"], ["1s"]) == 6
    with pytest.raises(ValueError):
        require_stream_limit(["S"] * 600, ["1s"])


def test_staleness(spark):
    rows = spark.createDataFrame([("A", "1m", 0), ("A", "1m", 60_000), ("B", "1m", 600_000)], "symbol string, interval string, open_time bigint")
    assert {r["symbol"]: (r["age_ms"], r["candles_behind"]) for r in series_staleness(rows).collect()} == {
        "A": (540_000, 9), "B": (0, 0)}
    assert {r["symbol"]: r["candles_behind"] for r in series_staleness(rows, 660_000).collect()} == {"A": 10, "B": 1}
