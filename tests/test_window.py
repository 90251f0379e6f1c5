import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import window
from tickloom.schemas import WINDOW_KEEP, WINDOW_SLACK

LIVE = "symbol string, open_time bigint, close string"
ARRIVALS = LIVE + ", kafka_partition int, kafka_offset bigint"


def cutoff(spark, times, keep, slack):
    df = spark.createDataFrame([(times,)], "times array<bigint>")
    return df.select(window.trim_cutoff(F.col("times"), keep, slack)).first()[0]


def test_trim_cutoff(spark):
    assert cutoff(spark, [7, 1, 4], 2, 1) is None
    assert cutoff(spark, [7, 1, 4, 9], 2, 1) == 7
    assert cutoff(spark, [3, 300, 33, 30, 333], 4, 0) == 30


class Reference:
    """The window one arrival at a time."""

    def __init__(self, keep, slack):
        self.keep, self.slack, self.rows = keep, slack, {}

    def arrive(self, symbol, open_time, close):
        held = self.rows.setdefault(symbol, {})
        new = open_time not in held
        held[open_time] = close
        if new and len(held) > self.keep + self.slack:
            for old in sorted(held)[: -self.keep]:
                del held[old]

    def table(self):
        return sorted((s, t, c) for s, held in self.rows.items() for t, c in held.items())


def run(spark, batches, keep, slack):
    reference, held, offset = Reference(keep, slack), spark.createDataFrame([], LIVE), 0
    for batch in batches:
        rows = []
        for symbol, open_time in batch:
            offset += 1
            reference.arrive(symbol, open_time, str(offset))
            rows.append((symbol, open_time, str(offset), ord(symbol[0]) % 3, offset))
        random.Random(offset).shuffle(rows)
        after = window.update_window(held, spark.createDataFrame(rows, ARRIVALS), keep, slack)
        got = sorted(tuple(r) for r in after.collect())
        assert got == reference.table()
        held = spark.createDataFrame(got, LIVE)
    return reference


@pytest.mark.parametrize("keep, slack", [(10, 2), (3, 0), (1, 1), (5, 20)])
def test_in_order_then_resent(spark, keep, slack):
    batches = [
        [("A", t) for t in range(20) for _ in range(2)],
        [("A", 19), ("A", 20), ("B", 5)],
        [("A", t) for t in range(21, 40)] + [("B", t) for t in range(6, 30)],
    ]
    run(spark, batches, keep, slack)


def test_production_sizes(spark):
    total = 2_000
    reference = run(spark, [[("A", t) for t in range(total)]], WINDOW_KEEP, WINDOW_SLACK)
    over = WINDOW_KEEP + WINDOW_SLACK + 1
    assert len(reference.rows["A"]) == WINDOW_KEEP + (total - over) % (WINDOW_SLACK + 1)


@pytest.mark.parametrize("seed", range(4))
def test_any_order(spark, seed):
    """Shuffled, repeated, late and returning candles over several batches."""
    rng = random.Random(seed)
    keep, slack = rng.choice([(4, 1), (6, 3), (2, 0)])
    batches = []
    for step in range(3):
        batch = []
        for symbol in "ABC":
            base = step * 8
            times = [base + rng.randint(-12, 12) for _ in range(rng.randint(0, 25))]
            if symbol == "B":
                times.sort()
            batch += [(symbol, t) for t in times]
        if symbol != "B":
            rng.shuffle(batch)
        batches.append(batch or [("A", 0)])
    run(spark, batches, keep, slack)


def test_trimmed_candle_comes_back(spark):
    run(spark, [[("A", t) for t in (1, 2, 3, 4, 5, 1, 6, 1, 2, 7)]], 3, 1)


def candles(spark, count):
    rows = [("A", "1m", t, float(t), float(t) + 2) for t in range(count)]
    df = spark.createDataFrame(rows, "symbol string, interval string, open_time bigint, low double, high double")
    return df.withColumns({c: F.col(c).cast("decimal(38,8)") for c in ("low", "high")})


@pytest.mark.parametrize("total, count, start, expected", [
    (200, None, None, (80, 200)), (50, None, None, (0, 50)), (200, 1, None, (195, 200)), (200, 20, 10, (10, 30)),
    (200, 20, 500, (180, 200)), (200, 20, -5, (0, 20)), (3, 20, 2, (0, 3)),
])
def test_visible_slice(spark, total, count, start, expected):
    got = sorted(r["open_time"] for r in window.visible_slice(candles(spark, total), count=count, start=start).collect())
    assert got == list(range(*expected))


def test_price_range(spark):
    row = window.price_range(candles(spark, 10)).first()
    assert (row["range_min"], row["range_max"]) == (0 - 11 * 0.08, 11 + 11 * 0.08)
    flat = candles(spark, 1).withColumn("high", F.col("low") + 50).withColumn("low", F.col("high"))
    row = window.price_range(flat).first()
    assert (row["range_min"], row["range_max"]) == (50 - 0.05 * 0.08, 50 + 0.05 * 0.08)
    zero = candles(spark, 1).withColumn("high", F.col("low"))
    row = window.price_range(zero).first()
    assert (row["range_min"], row["range_max"]) == (-0.08, 0.08)


def test_newest_rows_are_cut_before_the_shuffle(spark):
    plan = window.visible_slice(candles(spark, 10))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
