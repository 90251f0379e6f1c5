"""Time the headline operators over the given tables; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Each
query is run once to warm up and then timed; the value is the median in seconds (pages
five runs, tables one).
Pages are collected, as a caller would; whole-table operators go to the null sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from checks import registry, views
from tickloom.operators import decode, stats
from tickloom.plans import queries as reads
from tickloom.plans.lake_pages import LakePages
from tickloom.schemas import BOOK_TICKERS, KLINES, LAKE_TABLES, TRADES
from tickloom.session import build_session, new_work_dir
from tickloom.sources.lake import LakeReader
from tickloom.sources.topics import stream_topic_files
from tickloom.streaming import cold, hot, sinks

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
PAGE_RUNS, TABLE_RUNS, SMALL_BATCHES = 5, 1, 10


def timed(action, runs: int) -> float:
    action()
    samples = []
    for _ in range(runs):
        started = time.perf_counter()
        action()
        samples.append(time.perf_counter() - started)
    return round(statistics.median(samples), 4)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": CPUS,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries: dict[str, float] = {}

    frames = registry.frame_table(spark, SF_DIR)
    records = registry.topic_path(spark, SF_DIR)
    n_frames = frames.count()
    root = registry.lake_root(spark, SF_DIR)
    reader, fresh = LakeReader(spark, root, ttl_ms=10**9), LakeReader(spark, root, ttl_ms=0)
    symbol, interval = registry.SYMBOL, registry.INTERVAL

    # Pages over the partitioned lake, warm listing, then with a new listing each time.
    queries["klines_page"] = timed(
        lambda: reads.klines(reader.table(KLINES, symbol, interval), symbol, interval, 200).collect(), PAGE_RUNS)
    queries["klines_page_relist"] = timed(
        lambda: reads.klines(fresh.table(KLINES, symbol, interval), symbol, interval, 200).collect(), PAGE_RUNS)
    queries["trades_latest"] = timed(lambda: reads.trades(reader.table(TRADES, symbol), symbol).collect(), PAGE_RUNS)
    queries["tickers_latest"] = timed(
        lambda: reads.book_tickers(reader.table(BOOK_TICKERS, symbol), symbol).collect(), PAGE_RUNS)
    queries["candles"] = timed(
        lambda: reads.candles(reader.table(KLINES, symbol, interval), symbol, interval).collect(), PAGE_RUNS)

    # The same pages over a lake of many flushes: the newest days or flushes alone.
    pages = LakePages(spark, registry.flushed_lake(spark, SF_DIR))
    queries["klines_newest_days"] = timed(lambda: pages.klines(symbol, interval, 200).collect(), PAGE_RUNS)
    queries["trades_newest_days"] = timed(lambda: pages.trades(symbol).collect(), PAGE_RUNS)
    queries["tickers_newest_flushes"] = timed(lambda: pages.book_tickers(symbol).collect(), PAGE_RUNS)
    queries["klines_window"] = timed(
        lambda: pages.klines(symbol, interval, 200, time_range=registry.RANGE_MS).collect(), PAGE_RUNS)

    # Whole tables.
    for name in ("candle_series", "visible_slice", "rows_as_json", "newest_candle", "merge_all_series", "rest_rows_to_klines"):
        queries[name] = timed(lambda: sinks.discard(registry.QUERIES[name](spark, SF_DIR)), TABLE_RUNS)
    queries["decode_frames"] = timed(lambda: stats.decode_stats(decode.decode_frames(frames)).collect(), TABLE_RUNS)
    queries["topic_rows"] = timed(lambda: sinks.discard(registry.topic_rows(spark, SF_DIR)), TABLE_RUNS)

    def write_lake() -> None:
        target = new_work_dir(spark, "bench-lake")
        sinks.write_tables({table: registry.SOURCE_OF[table.topic](spark, SF_DIR) for table in LAKE_TABLES}, target, 0)

    def cold_batch() -> None:
        target = new_work_dir(spark, "bench-cold")
        cold.cold_batch(
            registry.read_topic_files(spark, records), 0, f"{target}/lake", cold.dead_letter_files(f"{target}/dlq"))

    def hot_paths(topic: str, files: int | None = None) -> list:
        """Both hot paths over a topic, at the same time; batches of so many files."""
        target = new_work_dir(spark, "bench-hot")
        tables, stream = hot.LiveTables(spark, f"{target}/live"), stream_topic_files(spark, topic, files)
        paths = [
            hot.start_hot_path(
                stream, tables, f"{target}/checkpoint", cold.dead_letter_files(f"{target}/dlq"), available_now=True),
            hot.start_window_path(stream, tables, f"{target}/window-checkpoint", available_now=True)]
        for path in paths:
            path.awaitTermination()
        return paths

    def small_hot_batch() -> float:
        """Median seconds of a batch of 500 records, of the slower path, both running."""
        topic = new_work_dir(spark, "bench-small-topic")
        rows = registry.read_topic_files(spark, records)
        for part in range(SMALL_BATCHES):
            rows.orderBy("offset").offset(part * 500).limit(500).coalesce(1).write.mode("append").parquet(topic)
        medians = []
        for path in hot_paths(topic, 1):
            seconds = [p.durationMs["triggerExecution"] / 1000 for p in path.recentProgress if p.numInputRows]
            medians.append(statistics.median(seconds[2:]))
        return round(max(medians), 4)

    queries["lake_write"] = timed(write_lake, TABLE_RUNS)
    queries["cold_batch"] = timed(cold_batch, TABLE_RUNS)
    queries["hot_batch"] = timed(lambda: hot_paths(records), TABLE_RUNS)
    queries["hot_batch_500"] = small_hot_batch()

    page = reader.table(KLINES, symbol, interval)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(queries.values()), 4), "unit": "sec", "queries": queries,
        "sf": os.path.basename(SF_DIR.rstrip("/")), "cpus": int(CPUS), "spark": spark.version,
        "rows_per_sec": {
            "decode_frames": round(n_frames / queries["decode_frames"]),
            "cold_batch": round(n_frames / queries["cold_batch"]),
            "lake_write": round(3 * n_frames / queries["lake_write"]),
        },
        "klines_files_read": len(page.inputFiles()),
        "klines_files_total": len(reader.table(KLINES).inputFiles()),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
