import glob
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickloom.operators import maintenance
from tickloom.plans import queries as reads
from tickloom.plans.lake_pages import LakePages
from tickloom.schemas import BOOK_TICKERS, KLINES, TRADES
from tickloom.sources import lake, layout
from tickloom.streaming.sinks import write_lake


def klines(spark, rows):
    """Rows from (symbol, interval, open_time, is_closed, offset)."""
    df = spark.createDataFrame(rows, "symbol string, interval string, open_time bigint, is_closed boolean, kafka_offset bigint")
    price = F.lit("731.25").cast("decimal(38,8)")
    return df.select(
        *[price.alias(c) for c in ("open", "high", "low", "close", "volume", "quote_volume")],
        F.lit(3).cast("bigint").alias("trade_count"), "open_time", (F.col("open_time") + 59).alias("close_time"), "is_closed",
        F.lit(0).alias("kafka_partition"), "kafka_offset", "symbol", "interval",
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_round_trip_and_pruning(spark, tmp_path):
    root = str(tmp_path)
    rows = [("NOVAUSD", "1m", t, True, t) for t in (1, 2, 3)] + [("ZEDAEUR", "1m", t, True, t) for t in (4, 5)]
    write_lake(klines(spark, rows), root, KLINES, 0)
    table = lake.read_table(spark, root, KLINES)
    assert table.schema.names == KLINES.schema.names
    got = table.filter("symbol = 'NOVAUSD'")
    assert sorted((r["symbol"], r["interval"], r["open_time"]) for r in got.collect()) == [("NOVAUSD", "1m", t) for t in (1, 2, 3)]
    assert "PartitionFilters: [isnotnull(symbol" in plan_of(got)
    narrow = lake.read_table(spark, root, KLINES, "NOVAUSD", "1m")
    assert narrow.count() == 3
    assert all("symbol=NOVAUSD" in name for name in narrow.inputFiles())
    body = spark.read.parquet(narrow.inputFiles()[0]).columns
    assert "symbol" not in body and "interval" not in body


def test_only_numeric_looking_intervals(spark, tmp_path):
    write_lake(klines(spark, [("7", "1d", 1, True, 1), ("7", "3d", 2, True, 2)]), str(tmp_path), KLINES, 0)
    assert sorted((r["symbol"], r["interval"]) for r in lake.read_table(spark, str(tmp_path), KLINES).collect()) == [
        ("7", "1d"), ("7", "3d")]
    assert lake.read_table(spark, str(tmp_path), KLINES, "7", "1d").count() == 1


def test_odd_path_values(spark, tmp_path):
    write_lake(klines(spark, [("A/B=c %", "1m", 1, True, 1), ("A", "1m", 2, True, 2)]), str(tmp_path), KLINES, 0)
    assert lake.read_table(spark, str(tmp_path), KLINES, "A/B=c %", "1m").first()["open_time"] == 1
    assert lake.read_table(spark, str(tmp_path), KLINES, "..").count() == 0


def test_missing_table_and_symbol_are_empty(spark, tmp_path):
    missing = lake.read_table(spark, str(tmp_path), BOOK_TICKERS)
    assert missing.schema.names == BOOK_TICKERS.schema.names and missing.count() == 0
    write_lake(klines(spark, [("A", "1m", 1, True, 1)]), str(tmp_path), KLINES, 0)
    assert lake.read_table(spark, str(tmp_path), KLINES, "B").count() == 0
    assert reads.json_array(reads.klines(lake.read_table(spark, str(tmp_path), KLINES, "B"))) == "[]"


def test_writing_a_batch_twice_leaves_one_copy(spark, tmp_path):
    root = str(tmp_path)
    write_lake(klines(spark, [("A", "1m", 1, True, 1)]), root, KLINES, 0)
    for _ in range(2):
        write_lake(klines(spark, [("A", "1m", 2, True, 2), ("B", "1m", 3, True, 3)]), root, KLINES, 1)
    assert sorted(r["open_time"] for r in lake.read_table(spark, root, KLINES).collect()) == [1, 2, 3]


def test_listing_freshness(spark, tmp_path, monkeypatch):
    assert lake.is_stale(None, 3000, 0) and lake.is_stale(5, 0, 5) and lake.is_stale(0, 3000, 5000)
    assert not lake.is_stale(4000, 3000, 5000)
    root = str(tmp_path)
    write_lake(klines(spark, [("A", "1m", 1, True, 1)]), root, KLINES, 0)
    cached, fresh = lake.LakeReader(spark, root, ttl_ms=60_000), lake.LakeReader(spark, root, ttl_ms=0)
    assert cached.table(KLINES).count() == fresh.table(KLINES).count() == 1
    write_lake(klines(spark, [("A", "1m", 2, True, 2)]), root, KLINES, 1)
    assert (cached.table(KLINES).count(), fresh.table(KLINES).count()) == (1, 2)

    def broken(*_):
        raise OSError("listing failed")

    monkeypatch.setattr(lake, "read_table", broken)
    assert fresh.table(KLINES).count() == 2
    with pytest.raises(OSError):
        lake.LakeReader(spark, root, ttl_ms=0).table(KLINES)


def test_klines_page(spark):
    rows = [("A", "1m", t, True, t) for t in range(10)] + [("A", "1m", 10, False, o) for o in (20, 22, 21)]
    rows += [("A", "1m", 3, False, 30), ("B", "1m", 99, False, 40), ("A", "5m", 99, True, 50)]
    table = klines(spark, rows)
    page = reads.klines(table, "A", "1m", 4).collect()
    assert [(r["open_time"], r["is_closed"], r["kafka_offset"]) for r in page] == [
        (9, True, 9), (8, True, 8), (7, True, 7), (6, True, 6), (10, False, 22)]
    assert page[0]["open"] == "731.25000000"
    assert len(reads.klines(table, "A", "1m", 0).collect()) == 2
    assert [r["open_time"] for r in reads.klines(table, "A", "1m", 2, before=5).collect()] == [4, 3, 3]
    assert [r["open_time"] for r in reads.klines(table, "A", "1m", 9, time_range=(2, 4)).collect()] == [4, 3, 2, 3]
    with pytest.raises(reads.AmbiguousSeries):
        reads.klines(table, "A", strict=True)
    assert "TakeOrderedAndProject" in plan_of(reads.klines(table, "A", "1m"))


def test_ties_have_one_answer(spark):
    table = klines(spark, [("A", "1m", 1, True, o) for o in range(50)])
    expected = [49, 48, 47]
    for parts in (1, 7):
        got = [r["kafka_offset"] for r in reads.klines(table.repartition(parts), "A", "1m", 3).collect()]
        assert got == expected


def test_candles_drop_repeats_and_run_oldest_first(spark):
    table = klines(spark, [("A", "1m", 1, True, 5), ("A", "1m", 1, True, 9), ("A", "1m", 2, False, 10), ("A", "1m", 0, True, 1)])
    got = [(r["open_time"], r["kafka_offset"]) for r in reads.candles(table, "A").collect()]
    assert got == [(0, 1), (1, 9), (2, 10)]
    kept = reads.klines(table, "A", "1m", 10, latest_only=True).collect()
    assert [(r["open_time"], r["kafka_offset"]) for r in kept] == [(1, 9), (0, 1), (2, 10)]


def test_pages_lose_no_row(spark):
    """Many updates of one open time; a page may end among them."""
    table = klines(spark, [("A", "1m", t, True, 10 * t + k) for t in range(5) for k in range(4)] + [("A", "1m", 9, False, 99)])
    seen, after = [], None
    while True:
        page = reads.klines(table, "A", "1m", 3, after=after).collect()
        after = reads.next_cursor(page, "open_time")
        if after is None:
            break
        seen += [r["kafka_offset"] for r in page if r["is_closed"]]
    assert seen == sorted((10 * t + k for t in range(5) for k in range(4)), key=lambda o: (-(o // 10), -o))
    latest = reads.klines(table, "A", "1m", 2, latest_only=True)
    again = reads.klines(table, "A", "1m", 2, latest_only=True, after=reads.next_cursor(latest.collect(), "open_time"))
    assert [r["open_time"] for r in again.collect() if r["is_closed"]] == [2, 1]
    assert reads.candles(table, "A", "1m", 3, latest_only=True).count() == 4


def test_merge_keeps_intervals_apart(spark):
    schema = "symbol string, interval string, open string, high string, low string, close string, volume string, trade_count bigint, open_time bigint"
    row = lambda i, close: ("A", i, "1", "2", "0.5", close, "7", 3, 0)
    typed = lambda rows: spark.createDataFrame(rows, schema).select(
        "symbol", "interval", *[c for c in ("open", "high", "low", "close", "volume", "trade_count", "open_time")])
    merged = reads.merge_candles(typed([row("1m", "1"), row("1h", "2")]), typed([row("1h", "3")]))
    assert {r["interval"]: r["close"] for r in merged.collect()} == {"1m": "1", "1h": "3"}


def test_live_rows_override_history(spark):
    schema = "symbol string, open string, high string, low string, close string, volume string, trade_count bigint, open_time bigint"
    row = lambda t, close: ("A", "1", "2", "0.5", close, "7", 3, t)
    history = reads.to_candles(spark.createDataFrame([row(1, "1.1"), row(2, "1.2")], schema))
    live = reads.to_candles(spark.createDataFrame([row(2, "9.90"), row(3, "9.3")], schema))
    merged = {r["open_time"]: r["close"] for r in reads.merge_candles(history, live).collect()}
    assert merged == {1: Decimal("1.1"), 2: Decimal("9.9"), 3: Decimal("9.3")}


def test_json_rows_keep_decimals_exact(spark):
    df = spark.sql("SELECT CAST('81985529216486.95' AS DECIMAL(38,8)) AS price, 'A' AS symbol, 5L AS n")
    assert reads.json_array(df) == '[{"price":"81985529216486.95000000","symbol":"A","n":5}]'


def files_of(root):
    return [name for _, _, names in os.walk(root) for name in names if name.endswith(".parquet")]


def test_compaction_retention_and_days(spark, tmp_path):
    root = str(tmp_path / "lake")
    day = 86_400_000
    for batch in range(6):
        write_lake(klines(spark, [("A", "1m", batch // 2 * day + batch, True, batch)]), root, KLINES, batch)
    compacted = str(tmp_path / "compacted")
    maintenance.compact(spark, root, compacted, KLINES)
    rows = lambda r: sorted(map(tuple, lake.read_table(spark, r, KLINES).collect()))
    assert rows(root) == rows(compacted)
    assert len(files_of(compacted)) == 3 < len(files_of(root))  # a file per day
    kept = str(tmp_path / "kept")
    maintenance.apply_retention(spark, root, kept, KLINES, day + 3)
    assert [r[7] for r in rows(kept)] == [day + 3, 2 * day + 4, 2 * day + 5]
    by_date = str(tmp_path / "dates")
    maintenance.write_by_date(lake.read_table(spark, root, KLINES), by_date, KLINES)
    days = maintenance.read_by_date(spark, by_date, KLINES, "1970-01-02", "1970-01-02")
    assert sorted(r["open_time"] for r in days.collect()) == [day + 2, day + 3]
    assert "event_date" in plan_of(days).split("PartitionFilters")[1]
    with pytest.raises(ValueError):
        maintenance.with_event_date(lake.empty_table(spark, BOOK_TICKERS), BOOK_TICKERS)
    assert maintenance.retain_since(lake.empty_table(spark, BOOK_TICKERS), BOOK_TICKERS, 5).count() == 0
    assert TRADES.time_column == "trade_time"


# --- Days and id ranges ---------------------------------------------------------

DAY = 86_400_000


def tickers(spark, rows):
    """Rows from (symbol, update_id, offset)."""
    df = spark.createDataFrame(rows, "symbol string, update_id bigint, kafka_offset bigint")
    price = F.lit("1.25").cast("decimal(38,8)")
    return df.select(
        *[price.alias(c) for c in ("best_bid_price", "best_bid_qty", "best_ask_price", "best_ask_qty")], "update_id",
        F.lit(0).alias("kafka_partition"), "kafka_offset", "symbol")


def test_a_window_reads_its_days_alone(spark, tmp_path):
    root, read = str(tmp_path), []
    for flush in range(20):
        rows = [("A", "1m", flush * DAY + t, True, 10 * flush + t) for t in (0, 5)] + [("B", "1m", 3 * DAY, True, flush)]
        write_lake(klines(spark, rows), root, KLINES, flush)
        if flush in (9, 19):
            found = lake.read_table(spark, root, KLINES, "A", "1m", time_range=(3 * DAY + 1, 5 * DAY))
            assert sorted(r["open_time"] for r in found.collect()) == [3 * DAY + 5, 4 * DAY, 4 * DAY + 5, 5 * DAY]
            read.append(len(found.inputFiles()))
    assert read == [3, 3]
    everywhere = lake.read_table(spark, root, KLINES, time_range=(3 * DAY, 3 * DAY))
    assert everywhere.count() == 21 and "event_date" in plan_of(everywhere).split("PartitionFilters")[1]
    assert lake.read_table(spark, root, KLINES, "A", "1m", time_range=(99 * DAY, 99 * DAY)).count() == 0
    with pytest.raises(ValueError):
        lake.read_table(spark, root, BOOK_TICKERS, "A", time_range=(0, 1))


def test_times_beyond_the_calendar(spark, tmp_path):
    times = [-(2**63), -(10**15), -1, 0, DAY - 1, DAY, 10**15, 2**63 - 60]
    write_lake(klines(spark, [("A", "1m", t, True, k) for k, t in enumerate(times)]), str(tmp_path), KLINES, 0)
    pages = LakePages(spark, str(tmp_path))
    assert [r["open_time"] for r in pages.klines("A", "1m", 3).collect()] == times[:-4:-1]
    assert [r["open_time"] for r in pages.klines("A", "1m", 9, before=0).collect()] == times[2::-1]
    for first, last in ((times[0], -1), (0, DAY - 1), (DAY, times[-1])):
        found = lake.read_table(spark, str(tmp_path), KLINES, "A", "1m", time_range=(first, last)).collect()
        assert sorted(r["open_time"] for r in found) == [t for t in times if first <= t <= last]


def test_newest_pages_read_few_files(spark, tmp_path):
    root = str(tmp_path)
    for flush in range(20):
        rows = [("A", "1m", flush * DAY + t, t != 3, 10 * flush + t) for t in range(4)]
        write_lake(klines(spark, rows), root, KLINES, flush)
        write_lake(tickers(spark, [("A", 100 * flush + t, flush) for t in range(-3, 4)]), root, BOOK_TICKERS, flush)
    pages, table = LakePages(spark, root), lake.read_table(spark, root, KLINES, "A", "1m")
    page = pages.klines("A", "1m", 3)
    assert page.collect() == reads.klines(table, "A", "1m", 3).collect()
    assert len(page.inputFiles()) == 1 and len(table.inputFiles()) == 20
    assert len(pages.klines("A", "1m", 10).inputFiles()) <= 5
    quotes = lake.read_table(spark, root, BOOK_TICKERS, "A")
    for limit, files in ((5, 1), (7, 1), (8, 2), (30, 5)):
        page = pages.book_tickers("A", limit)
        assert page.collect() == reads.book_tickers(quotes, "A", limit).collect()
        assert len(page.inputFiles()) == files
    assert len(pages.candles("A", "1m", 6).inputFiles()) <= 3


def test_newest_pages_equal_whole_reads(spark, tmp_path):
    """Late rows, repeats, flushes that overlap, days without closed or forming rows, every cursor."""
    rng, root, offset = random.Random(1), str(tmp_path), 0
    for flush in range(6):
        rows, quotes = [], []
        for _ in range(rng.randint(1, 12)):
            offset += 1
            t = rng.randint(0, 5) * DAY + rng.randint(0, 3)
            rows.append(("A", "1s", t, t // DAY != 4 and rng.random() < 0.6, offset))
            quotes.append(("A", rng.randint(0, 20 + 5 * flush), offset))
        write_lake(klines(spark, rows), root, KLINES, flush)
        write_lake(tickers(spark, quotes), root, BOOK_TICKERS, flush)
    pages = LakePages(spark, root)
    table, quotes = lake.read_table(spark, root, KLINES), lake.read_table(spark, root, BOOK_TICKERS)
    for how in ({}, {"latest_only": True}, {"before": 3 * DAY}, {"time_range": (DAY, 3 * DAY)}):
        after = None
        for _ in range(4):
            page = pages.klines("A", "1s", 4, after=after, **how).collect()
            assert page == reads.klines(table, "A", "1s", 4, after=after, **how).collect()
            after = reads.next_cursor(page, "open_time")
    after = None
    while True:
        page = pages.book_tickers("A", 5, after=after).collect()
        assert page == reads.book_tickers(quotes, "A", 5, after=after).collect()
        after = reads.next_cursor(page, "update_id")
        if after is None:
            break
    assert pages.candles("A", "1s", 6).collect() == reads.candles(table, "A", "1s", 6).collect()
    assert pages.klines("A", "1s", 1000).collect() == reads.klines(table, "A", "1s", 1000).collect()
    assert pages.klines("A").collect() == reads.klines(table, "A").collect()
    assert pages.klines("none", "1s").count() == pages.book_tickers("none").count() == pages.trades("none").count() == 0


def test_newest_spans():
    spans = [layout.Span(90, 99, 10), layout.Span(50, 95, 5), layout.Span(10, 40, 10), layout.Span(-5, 9, 3)]
    assert layout.newest_spans(spans, 1) == spans[:2]
    assert layout.newest_spans(spans, 15) == spans[:2] and layout.newest_spans(spans, 16) == spans[:3]
    assert layout.newest_spans(spans, 1, at_most=45) == spans[2:3]
    assert layout.newest_spans(spans, 1, at_most=40) == spans[2:] and layout.newest_spans([], 5) == []
    assert all(layout.parse_span(s.name) == s for s in spans)


# --- Upkeep in place -------------------------------------------------------------

def many_flushes(spark, root):
    for flush in range(5):
        rows = [("A", "1m", d * DAY + flush, True, 10 * flush + d) for d in range(3)] + [("B/x, y", "1m", flush, True, 100 + flush)]
        write_lake(klines(spark, rows), root, KLINES, flush, "stream")
        write_lake(tickers(spark, [("A", 10 * flush + t, flush) for t in range(3)]), root, BOOK_TICKERS, flush, "stream")


def table_rows(spark, root, table):
    return sorted(map(tuple, lake.read_table(spark, root, table).collect()))


def test_compaction_in_place(spark, tmp_path):
    root = str(tmp_path)
    many_flushes(spark, root)
    before = {t.topic: table_rows(spark, root, t) for t in (KLINES, BOOK_TICKERS)}
    newest = {f for f in glob.glob(f"{root}/**/*.parquet", recursive=True) if "batch_id=stream-4" in f or "event_date=1970-01-03" in f}
    assert maintenance.compact_in_place(spark, root, KLINES, settled_ms=2 * DAY) == 12
    assert maintenance.compact_in_place(spark, root, BOOK_TICKERS) == 4
    assert {t.topic: table_rows(spark, root, t) for t in (KLINES, BOOK_TICKERS)} == before
    after = set(glob.glob(f"{root}/**/*.parquet", recursive=True))
    assert newest <= after and len(after) == len(newest) + 4
    assert len(LakePages(spark, root).book_tickers("A", 3).inputFiles()) == 1
    # The stream goes on beside it, and writes its newest batch again.
    many_flushes_again = [("A", "1m", d * DAY + 4, True, 40 + d) for d in range(3)] + [("B/x, y", "1m", 4, True, 104)]
    write_lake(klines(spark, many_flushes_again), root, KLINES, 4, "stream")
    assert table_rows(spark, root, KLINES) == before[KLINES.topic]
    assert maintenance.compact_in_place(spark, root, KLINES, settled_ms=2 * DAY) == 0


@pytest.mark.parametrize("fails", ["_finish", "_drop", "write_lake"])
def test_compaction_that_was_cut_off(spark, tmp_path, fails):
    root = str(tmp_path)
    many_flushes(spark, root)
    before = table_rows(spark, root, KLINES)

    def lost(*_):
        raise OSError("driver lost")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(maintenance, fails, lost)
        with pytest.raises(OSError):
            maintenance.compact_in_place(spark, root, KLINES)
    maintenance.finish_compactions(spark, root, KLINES)
    assert table_rows(spark, root, KLINES) == before
    files = len(glob.glob(f"{root}/market.klines/**/*.parquet", recursive=True))
    assert files == (20 if fails == "write_lake" else 8)
    maintenance.compact_in_place(spark, root, KLINES)
    assert table_rows(spark, root, KLINES) == before


def test_retention_in_place(spark, tmp_path):
    root = str(tmp_path)
    many_flushes(spark, root)
    everything = lake.read_table(spark, root, KLINES).collect()
    untouched = set(glob.glob(f"{root}/**/event_date=1970-01-03/**/*.parquet", recursive=True))
    for cutoff in (DAY + 2, DAY + 2, 2 * DAY, 9 * DAY):
        maintenance.drop_before(spark, root, KLINES, cutoff)
        assert table_rows(spark, root, KLINES) == sorted(tuple(r) for r in everything if r["open_time"] >= cutoff)
        if cutoff <= 2 * DAY:
            assert untouched <= set(glob.glob(f"{root}/**/*.parquet", recursive=True))
    maintenance.drop_before(spark, root, BOOK_TICKERS, 5)
    assert lake.read_table(spark, root, BOOK_TICKERS).count() == 15
