"""One callable per operator, over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks import views
from tickloom.functions.decimals import decimals_to_text
from tickloom.functions.market import candle_direction, interval_list
from tickloom.operators import decode, encode, latest, maintenance, quality, stats, window
from tickloom.plans import queries as reads
from tickloom.plans.lake_pages import LakePages
from tickloom.schemas import (
    AGG_TRADE, BOOK_TICKER, BOOK_TICKERS, CANDLE_COLUMNS, KLINE, KLINES, LAKE_TABLES, TRADES, VALID_INTERVALS, LakeTable,
)
from tickloom.session import new_work_dir, prepare_session
from tickloom.sources import history
from tickloom.sources.frames import not_blank, read_frames, stream_frames
from tickloom.sources.lake import read_table
from tickloom.sources.topics import read_topic_files, stream_topic_files
from tickloom.streaming import cold, hot, ingest, metrics, sinks

Query = Callable[[SparkSession, str], DataFrame]

SYMBOL, INTERVAL = "CLICK", "1h"
WINDOW_KEEP, WINDOW_SLACK = 60, 12
RANGE_MS = (1_704_672_000_000, 1_705_276_799_999)  # 2024-01-08 to 2024-01-14
CUTOFF_MS = 1_705_276_800_000  # 2024-01-15
# A factor and a prime that put offsets in another order.
SHUFFLE = (48_271, 2_147_483_647)
INSIDE_DAY_MS = CUTOFF_MS + 13 * 3_600_000  # in the afternoon of that day
SOURCE_OF = {TRADES.topic: views.trades, BOOK_TICKERS.topic: views.book_tickers, KLINES.topic: views.klines}

# Written tables shared by the queries of one application.
_written: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = build(new_work_dir(prepare_session(spark), name))
    return _written[key]


def lake_root(spark: SparkSession, sf_dir: str) -> str:
    """A lake holding the three views, written through the lake sink."""

    def build(root: str) -> str:
        for table in LAKE_TABLES:
            sinks.write_lake(SOURCE_OF[table.topic](spark, sf_dir), root, table, batch_id=0)
        return root

    return _once(spark, sf_dir, "lake", build)


# Files of the written inputs: a feed lands many, the given table of events is one.
INPUT_FILES = 8
# A larger table has one for so many rows: small ones are dealt evenly to however many cores read them.
FILE_ROWS = 25_000


def input_files(spark: SparkSession, sf_dir: str) -> int:
    return max(INPUT_FILES, -(-views.table(spark, sf_dir, "events").count() // FILE_ROWS))


def topic_path(spark: SparkSession, sf_dir: str) -> str:
    def build(root: str) -> str:
        views.topic_records(spark, sf_dir, input_files(spark, sf_dir)).write.parquet(root)
        return root

    return _once(spark, sf_dir, "topic", build)


def frame_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw frames with the event they came from, as a written table."""

    def build(root: str) -> str:
        views.frames(spark, sf_dir, input_files(spark, sf_dir)).write.parquet(root)
        return root

    return spark.read.parquet(_once(spark, sf_dir, "frame-table", build))


def frames_path(spark: SparkSession, sf_dir: str) -> str:
    def build(root: str) -> str:
        sinks.record_frames(frame_table(spark, sf_dir), root)
        return root

    return _once(spark, sf_dir, "frames", build)


def cold_roots(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Lake and dead letters after the cold path has drained the topics."""

    def build(root: str) -> tuple[str, str]:
        lake, parked = f"{root}/lake", f"{root}/dead-letters"
        cold.start_cold_path(
            stream_topic_files(spark, topic_path(spark, sf_dir)), lake, f"{root}/checkpoint",
            cold.dead_letter_files(parked), available_now=True,
        ).awaitTermination()
        return lake, parked

    return _once(spark, sf_dir, "cold", build)


def live_tables(spark: SparkSession, sf_dir: str) -> hot.LiveTables:
    """Live tables after the hot path has drained the topics."""

    def build(root: str) -> hot.LiveTables:
        tables = hot.LiveTables(spark, f"{root}/live", WINDOW_KEEP, WINDOW_SLACK)
        hot.start_hot_path(
            stream_topic_files(spark, topic_path(spark, sf_dir)), tables, f"{root}/checkpoint",
            cold.dead_letter_files(f"{root}/dead-letters"), available_now=True,
        ).awaitTermination()
        hot.start_window_path(
            stream_topic_files(spark, topic_path(spark, sf_dir)), tables, f"{root}/window-checkpoint", available_now=True,
        ).awaitTermination()
        return tables

    return _once(spark, sf_dir, "hot", build)


BATCHES = 3


def paths_in_batches(spark: SparkSession, sf_dir: str) -> tuple[hot.LiveTables, str]:
    """Live tables with their change feed, and the counters, after all paths took the topic in three batches by offset."""

    def build(root: str) -> tuple[hot.LiveTables, str]:
        tables = hot.LiveTables(spark, f"{root}/live", WINDOW_KEEP, WINDOW_SLACK, feed=f"{root}/feed")
        records = read_topic_files(spark, topic_path(spark, sf_dir))
        most = records.agg(F.max("offset")).first()[0]
        part = F.floor(F.col("offset") * BATCHES / (most + 1))
        for batch_id in range(BATCHES):
            records.filter(part == batch_id).write.mode("append").parquet(f"{root}/topic")
            stream = stream_topic_files(spark, f"{root}/topic")
            paths = [
                cold.start_cold_path(
                    stream, f"{root}/lake", f"{root}/cold-checkpoint", cold.dead_letter_files(f"{root}/cold-dead-letters"),
                    available_now=True, metrics=f"{root}/metrics"),
                hot.start_hot_path(
                    stream, tables, f"{root}/checkpoint", cold.dead_letter_files(f"{root}/dead-letters"), available_now=True,
                    metrics=f"{root}/metrics"),
                hot.start_window_path(stream, tables, f"{root}/window-checkpoint", available_now=True)]
            for path in paths:
                path.awaitTermination()
        return tables, f"{root}/metrics"

    return _once(spark, sf_dir, "hot-batches", build)


def decoded_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_frames(not_blank(frame_table(spark, sf_dir)))


def decoded_topic(spark: SparkSession, sf_dir: str, strict_version: bool = False) -> DataFrame:
    return decode.decode_envelopes(read_topic_files(spark, topic_path(spark, sf_dir)), strict_version)


def _text(column: str):
    return F.col(column).cast("string").alias(column)


# --- Decode and route ---------------------------------------------------------

def frame_decode_stats(spark, sf_dir):
    return stats.decode_stats(decoded_frames(spark, sf_dir))


def frame_stats_line(spark, sf_dir):
    return stats.stats_line(stats.decode_stats(decoded_frames(spark, sf_dir)))


def frame_error_budget(spark, sf_dir):
    return stats.error_budget(stats.decode_stats(decoded_frames(spark, sf_dir)), max_decode_errors=3)


def decoded_trades(spark, sf_dir):
    return decode.events_of(decoded_frames(spark, sf_dir), AGG_TRADE, "event_id")


def decoded_tickers(spark, sf_dir):
    return decode.events_of(decoded_frames(spark, sf_dir), BOOK_TICKER, "event_id")


def decoded_klines(spark, sf_dir):
    return decode.events_of(decoded_frames(spark, sf_dir), KLINE, "event_id")


def bad_frames(spark, sf_dir):
    bad = decode.with_snippet(decode.bad_rows(decoded_frames(spark, sf_dir)))
    return bad.select("event_id", "error", "snippet", "value")


def control_frames(spark, sf_dir):
    return decoded_frames(spark, sf_dir).filter(F.col("kind") == "control").select("event_id", "value")


def topic_rows(spark, sf_dir):
    return encode.to_topic_rows(decoded_frames(spark, sf_dir), "event_id")


def envelope_dispatch(spark, sf_dir):
    decoded = decoded_topic(spark, sf_dir)
    return decoded.groupBy("topic", "kind").agg(F.count("*").alias("records"))


def schema_version_dispatch(spark, sf_dir):
    decoded = decoded_topic(spark, sf_dir, strict_version=True)
    return decoded.groupBy("topic", "kind").agg(F.count("*").alias("records"))


def empty_payloads(spark, sf_dir):
    records = read_topic_files(spark, topic_path(spark, sf_dir))
    return records.groupBy("topic").agg(F.count_if(F.col("value").isNull()).alias("skipped"), F.count("*").alias("records"))


def _flat_dead_letters(rows: DataFrame) -> DataFrame:
    headers = F.map_from_entries("headers")
    return rows.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic", "consumer",
        *[F.try_element_at(headers, F.lit(f"dlq.{name}")).cast("string").alias(name)
          for name in ("error", "source_topic", "partition", "offset")],
    )


def dead_letters(spark, sf_dir):
    return _flat_dead_letters(encode.dead_letters(decoded_topic(spark, sf_dir), "hot"))


def path_counters(spark, sf_dir):
    return stats.path_counters(decoded_topic(spark, sf_dir), ["topic"])


def symbol_mismatches(spark, sf_dir):
    """Every seventh record names another symbol outside its candle than inside."""
    outer = F.regexp_replace(F.col("value").cast("string"), '("e":"kline","E":[0-9]+,"s":")[A-Z]+"', '$1OTHER"')
    records = read_topic_files(spark, topic_path(spark, sf_dir))
    changed = records.withColumn("value", F.when(F.col("offset") % 7 == 0, F.encode(outer, "UTF-8")).otherwise(F.col("value")))
    return quality.symbol_mismatches(decode.decode_envelopes(changed))


def raw_frame_recorder(spark, sf_dir):
    """Recorded frames read back through the frame source."""
    frames = read_frames(spark, frames_path(spark, sf_dir))
    return frames.select("value", F.length("value").alias("length"))


def recorder_stream(spark, sf_dir):
    """Frames recorded while they stream, over a restart, read back through the frame source."""

    def build(root: str) -> str:
        frames = read_frames(spark, frames_path(spark, sf_dir))
        odd = F.length("value") % 2
        for part in (0, 1):
            frames.filter(odd == part).select("value").write.mode("append").text(f"{root}/landed")
            ingest.start_recorder(
                stream_frames(spark, f"{root}/landed"), f"{root}/recorded", f"{root}/checkpoint", available_now=True).awaitTermination()
        return f"{root}/recorded"

    frames = read_frames(spark, _once(spark, sf_dir, "recorder", build))
    return frames.select("value", F.length("value").alias("length"))


def decode_only_replay(spark, sf_dir):
    """Decode into the null sink, then the counts of the same decode."""
    decoded = decode.decode_frames(read_frames(spark, frames_path(spark, sf_dir)))
    sinks.discard(decoded)
    return stats.decode_stats(decoded)


def ingest_stream(spark, sf_dir):
    """Recorded frames streamed into topic records, kept as files."""

    def build(root: str) -> str:
        out = f"{root}/records"
        ingest.start_ingest(
            stream_frames(spark, frames_path(spark, sf_dir)),
            lambda records, batch_id: sinks.write_records(records, out, batch_id),
            f"{root}/checkpoint", available_now=True,
        ).awaitTermination()
        return out

    return spark.read.parquet(_once(spark, sf_dir, "ingest", build)).select("key", "value", "topic")


# --- Lake ---------------------------------------------------------------------

def _roundtrip(table) -> Query:
    return lambda spark, sf_dir: decimals_to_text(read_table(spark, lake_root(spark, sf_dir), table))


def lake_replay_idempotent(spark, sf_dir):
    """The same batch written twice."""

    def build(root: str) -> str:
        for _ in range(2):
            sinks.write_lake(views.trades(spark, sf_dir), root, TRADES, batch_id=7)
        return root

    table = read_table(spark, _once(spark, sf_dir, "replay", build), TRADES)
    return table.groupBy("symbol").agg(F.count("*").alias("rows"), F.sum("price").cast("string").alias("sum_price"))


def _cold_table(table) -> Query:
    return lambda spark, sf_dir: decimals_to_text(read_table(spark, cold_roots(spark, sf_dir)[0], table))


def cold_stream_dead_letters(spark, sf_dir):
    return _flat_dead_letters(spark.read.parquet(cold_roots(spark, sf_dir)[1]))


def flush_manifest(spark, sf_dir):
    return cold.batch_manifest(decoded_topic(spark, sf_dir))


def rows_per_flush(spark, sf_dir):
    manifest = cold.batch_manifest(decoded_topic(spark, sf_dir))
    return manifest.groupBy("topic").agg(F.sum("rows").alias("rows"), F.count("*").alias("files"))


def commit_offsets(spark, sf_dir):
    return stats.commit_offsets(read_topic_files(spark, topic_path(spark, sf_dir)))


# --- Named reads --------------------------------------------------------------

def trades_latest(spark, sf_dir):
    return reads.trades(read_table(spark, lake_root(spark, sf_dir), TRADES, SYMBOL), limit=50)


def trades_latest_all(spark, sf_dir):
    return reads.trades(views.trades(spark, sf_dir))


def trades_unknown_symbol(spark, sf_dir):
    """The whole table is there to be searched; no row is of that symbol."""
    return reads.trades(views.trades(spark, sf_dir), "NOSUCH")


def trade_seed(spark, sf_dir):
    return reads.trade_seed(views.trades(spark, sf_dir), SYMBOL)


def tickers_latest(spark, sf_dir):
    return reads.book_tickers(read_table(spark, lake_root(spark, sf_dir), BOOK_TICKERS, SYMBOL), limit=5000, most=1000)


def klines_page(spark, sf_dir):
    return reads.klines(read_table(spark, lake_root(spark, sf_dir), KLINES, SYMBOL, INTERVAL))


def klines_page_all(spark, sf_dir):
    return reads.klines(views.klines(spark, sf_dir), limit=1000)


def klines_range(spark, sf_dir):
    return reads.klines(views.klines(spark, sf_dir), SYMBOL, INTERVAL, 1000, time_range=RANGE_MS)


def klines_before(spark, sf_dir):
    return reads.klines(views.klines(spark, sf_dir), SYMBOL, INTERVAL, 20, before=RANGE_MS[0])


def klines_latest_per_open(spark, sf_dir):
    return reads.klines(views.klines(spark, sf_dir), SYMBOL, INTERVAL, 100, latest_only=True)


def candles(spark, sf_dir):
    return reads.candles(read_table(spark, lake_root(spark, sf_dir), KLINES, SYMBOL, INTERVAL), SYMBOL, INTERVAL)


def candle_series(spark, sf_dir):
    """Latest row per candle over every series."""
    return decimals_to_text(reads.candle_series(views.klines(spark, sf_dir)))


def candle_direction_series(spark, sf_dir):
    series = reads.candle_series(views.klines(spark, sf_dir))
    return series.select(
        "symbol", "interval", "open_time", candle_direction(F.col("open"), F.col("close")).alias("direction")
    )


def rows_as_json(spark, sf_dir):
    return reads.rows_as_json(views.trades(spark, sf_dir).select(
        "symbol", "price", "quantity", "trade_time", "agg_trade_id", "is_buyer_maker"
    ))


def newest_candle(spark, sf_dir):
    return reads.newest_candle(views.klines(spark, sf_dir))


def visible_slice(spark, sf_dir):
    return decimals_to_text(window.visible_slice(reads.candle_series(views.klines(spark, sf_dir))))


def visible_slice_page(spark, sf_dir):
    """A slice from a given position of every whole series."""
    return decimals_to_text(window.visible_slice(reads.candle_series(views.klines(spark, sf_dir)), count=40, start=25))


def price_range(spark, sf_dir):
    return window.price_range(window.visible_slice(reads.candle_series(views.klines(spark, sf_dir))))


# --- Live state ---------------------------------------------------------------

def live_trade(spark, sf_dir):
    return reads.live_trades(live_tables(spark, sf_dir).trade.read())


def live_book_ticker(spark, sf_dir):
    return reads.live_tickers(live_tables(spark, sf_dir).book_ticker.read())


def live_kline(spark, sf_dir):
    return live_tables(spark, sf_dir).kline.read()


def live_window(spark, sf_dir):
    return live_tables(spark, sf_dir).kline_second.read()


def live_window_symbol(spark, sf_dir):
    return live_tables(spark, sf_dir).kline_second.read().filter(F.col("symbol") == SYMBOL)


def live_window_count(spark, sf_dir):
    return stats.row_count(live_tables(spark, sf_dir).kline_second.read())


def live_fanout(spark, sf_dir):
    """A one-second candle is in both live tables, any other only in one."""
    tables = live_tables(spark, sf_dir)
    current = tables.kline.read().groupBy(F.col("bar_interval").alias("interval")).agg(F.count("*").alias("rows"))
    second = tables.kline_second.read().agg(F.count_distinct("symbol").alias("rows"))
    return current.select(F.lit("live_kline").alias("live_table"), "interval", "rows").unionByName(
        second.select(F.lit("live_kline_second").alias("live_table"), F.lit("1s").alias("interval"), "rows")
    )


def live_sql(spark, sf_dir):
    live_tables(spark, sf_dir).register_views(spark)
    return reads.live_sql(spark, "SELECT symbol, count(*) AS n FROM live_kline GROUP BY symbol")


def live_subscription(spark, sf_dir):
    """The update stream of latest trades, drained to its final state."""

    def build(root: str) -> str:
        updates = hot.latest_stream(stream_topic_files(spark, topic_path(spark, sf_dir)), AGG_TRADE, ["symbol"])
        out = f"{root}/state"

        def keep(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(out)

        updates.writeStream.outputMode("complete").foreachBatch(keep).option(
            "checkpointLocation", f"{root}/checkpoint"
        ).trigger(availableNow=True).start().awaitTermination()
        return out

    state = spark.read.parquet(_once(spark, sf_dir, "subscription", build))
    return state.select("symbol", "price", "quantity", "trade_time", "agg_trade_id", "is_buyer_maker")


def path_metrics(spark, sf_dir):
    """Counters of the cold and the hot path, as their batches left them."""
    return stats.total_metrics(metrics.read_metrics(spark, paths_in_batches(spark, sf_dir)[1]))


def live_changes(spark, sf_dir):
    """Rows inserted and updated per batch in the tables of latest rows, from their change feed."""
    tables = paths_in_batches(spark, sf_dir)[0]
    counted = [
        tables.read_feed(s).groupBy("batch", "change").agg(F.count("*").alias("rows")).withColumn("live_table", F.lit(s.name))
        for s in (tables.trade, tables.book_ticker, tables.kline)]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def live_changes_window(spark, sf_dir):
    """The rolling window put together from its change feed alone: the last change of each candle, if not its end."""
    tables = paths_in_batches(spark, sf_dir)[0]
    feed = tables.read_feed(tables.kline_second)
    columns = [c for c in feed.columns if c not in ("symbol", "open_time", "batch_id", "batch")]
    last = feed.groupBy("symbol", "open_time").agg(F.max_by(F.struct(*columns), "batch").alias("_last"))
    return last.filter("_last.change <> 'delete'").select("symbol", "open_time", "_last.*").select(tables.kline_second.schema.names)


def live_window_batches(spark, sf_dir):
    """The rolling window after several batches."""
    return paths_in_batches(spark, sf_dir)[0].kline_second.read()


def live_window_out_of_order(spark, sf_dir):
    """The rolling window after candles arrived far from their order, late and again, in several batches."""

    def build(root: str) -> hot.LiveTables:
        tables = hot.LiveTables(spark, f"{root}/live", WINDOW_KEEP, WINDOW_SLACK)
        shuffled = (F.col("offset") * SHUFFLE[0]) % SHUFFLE[1]
        records = read_topic_files(spark, topic_path(spark, sf_dir)).withColumn("offset", shuffled)
        part = F.floor(F.col("offset") * BATCHES / SHUFFLE[1])
        for batch_id in range(BATCHES):
            records.filter(part == batch_id).write.mode("append").parquet(f"{root}/topic")
            hot.start_window_path(
                stream_topic_files(spark, f"{root}/topic"), tables, f"{root}/checkpoint", available_now=True).awaitTermination()
        return tables

    return _once(spark, sf_dir, "window-out-of-order", build).kline_second.read()


def window_batch(spark, sf_dir):
    """The rolling window over the whole candle log in one step."""
    arrivals = decimals_to_text(views.klines(spark, sf_dir).filter(F.col("interval") == "1s")).drop("interval")
    held = spark.createDataFrame([], arrivals.drop("kafka_partition", "kafka_offset").schema)
    return window.update_window(held, arrivals, WINDOW_KEEP, WINDOW_SLACK)


def merged_chart(spark, sf_dir):
    lake = read_table(spark, cold_roots(spark, sf_dir)[0], KLINES, SYMBOL, "1s")
    return reads.live_chart(lake, live_tables(spark, sf_dir).kline_second.read(), SYMBOL)


def merge_all_series(spark, sf_dir):
    """History and the newest half of it as live rows, over every series of every interval."""
    series = reads.candle_series(views.klines(spark, sf_dir))
    newer = series.filter(F.col("open_time") >= CUTOFF_MS).withColumn("close", F.col("high"))
    return decimals_to_text(reads.merge_candles(series, newer))


def live_candles(spark, sf_dir):
    """Live window rows narrowed to the chart columns."""
    return decimals_to_text(reads.to_candles(live_tables(spark, sf_dir).kline_second.read()))


# --- Historical rows ----------------------------------------------------------

def _backfill(spark, sf_dir):
    return history.decode_rows(history.parse_row_text(views.rest_rows(spark, sf_dir)), views.REST_NOW_MS)


def rest_rows_to_klines(spark, sf_dir):
    return decode.events_of(_backfill(spark, sf_dir), KLINE, "row_id")


def rest_rows_rejected(spark, sf_dir):
    return decode.bad_rows(_backfill(spark, sf_dir)).select("row_id", "error")


def _landed(spark, sf_dir):
    """Responses landed as lines, one array of rows each, read and decoded.

    A response is one page of at most 1000 rows of a series.
    """

    def build(root: str) -> str:
        rows = views.rest_rows(spark, sf_dir)
        pages = rows.groupBy("symbol", "interval", F.floor(F.col("row_id") / 1000).alias("page")).agg(
            F.concat(F.lit("["), F.array_join(F.collect_list("row_text"), ","), F.lit("]")).alias("value")
        )
        # A refusal, and a page cut off on its way, next to every page.
        refused = pages.withColumn("value", F.lit('{"code":-1,"msg":"no"}'))
        cut = pages.withColumn("value", F.expr("substr(value, 1, length(value) - 3)"))
        landed = pages.unionByName(refused).unionByName(cut)
        landed.select("value", "symbol", "interval").write.partitionBy("symbol", "interval").text(root)
        return root

    responses = history.read_responses(spark, _once(spark, sf_dir, "responses", build))
    return history.decode_rows(history.response_rows(responses), views.REST_NOW_MS)


def landed_history(spark, sf_dir):
    return decode.events_of(_landed(spark, sf_dir), KLINE)


def landed_rejected(spark, sf_dir):
    """Every bad row of a good response, and every response that cannot be read."""
    return decode.bad_rows(_landed(spark, sf_dir)).groupBy("symbol", "error").agg(F.count("*").alias("rows"))


def backfill_union(spark, sf_dir):
    """Backfilled and live candle events in one keyed topic."""
    live = encode.to_topic_rows(decoded_topic(spark, sf_dir).filter(F.col("kind") == KLINE).drop("key", "value", "topic"))
    both = live.unionByName(encode.to_topic_rows(_backfill(spark, sf_dir)))
    # One parse of a value for all of its fields.
    parsed = F.from_json("value", "payload struct<k:struct<i:string,t:string,o:string,c:string,v:string,f:string,x:string>>")
    field = lambda name: F.col(f"parsed.payload.k.{name}")
    return both.withColumn("parsed", parsed).select(
        "topic", "key", field("i").alias("interval"), field("t").cast("bigint").alias("open_time"), field("o").alias("open"),
        field("c").alias("close"), field("v").alias("volume"), field("f").cast("bigint").alias("first_trade_id"),
        (field("x") == "true").alias("is_closed"))


# --- Quality ------------------------------------------------------------------

def invalid_intervals(spark, sf_dir):
    """Priorities stand in for intervals in orders; order statuses are symbols."""
    rows = views.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, "1h").when(F.col("o_orderkey") % 3 == 1, "10m")
        .otherwise(F.col("o_orderpriority")).alias("interval")
    )
    return quality.invalid_intervals(rows)


def interval_lists(spark, sf_dir):
    """Comma lists of intervals, trimmed, blanks dropped, with their valid members."""
    lists = views.base_events(spark, sf_dir).select(
        "event_id", interval_list(F.concat(F.lit(" , "), "interval", F.lit(" ,24h,, 1w"))).alias("items")
    )
    valid = F.filter("items", lambda item: item.isin(*VALID_INTERVALS))
    return lists.select("event_id", F.array_join("items", ",").alias("items"), F.size(valid).cast("bigint").alias("valid"))


def symbol_validation(spark, sf_dir):
    return quality.symbol_validation(
        views.table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol")), ["CLICK", "View"]
    )


def feed_coverage(spark, sf_dir):
    observed = decoded_frames_streams(spark, sf_dir)
    symbols = views.trades(spark, sf_dir).select("symbol").distinct()
    return quality.feed_coverage(quality.stream_catalogue(symbols, ["1s", "1m", "1h", "1d", "1w"]), observed)


def decoded_frames_streams(spark, sf_dir):
    decoded = decoded_frames(spark, sf_dir).filter(F.col("kind").isin(AGG_TRADE, BOOK_TICKER, KLINE))
    return decoded.select(F.get_json_object("value", "$.stream").alias("stream"))


def series_staleness(spark, sf_dir):
    return quality.series_staleness(views.klines(spark, sf_dir))


# --- Maintenance --------------------------------------------------------------

def compaction_preserves_rows(spark, sf_dir):
    """Many small batches compacted into one."""

    def build(root: str) -> str:
        source = views.klines(spark, sf_dir)
        for batch_id in range(3):
            sinks.write_lake(source.filter(F.col("kafka_offset") % 3 == batch_id), f"{root}/small", KLINES, batch_id)
        maintenance.compact(spark, f"{root}/small", f"{root}/large", KLINES)
        return f"{root}/large"

    return decimals_to_text(read_table(spark, _once(spark, sf_dir, "compaction", build), KLINES))


def retention_cut(spark, sf_dir):
    def build(root: str) -> str:
        maintenance.apply_retention(spark, lake_root(spark, sf_dir), root, TRADES, CUTOFF_MS)
        return root

    return decimals_to_text(read_table(spark, _once(spark, sf_dir, "retention", build), TRADES))


def date_partition_scan(spark, sf_dir):
    def build(root: str) -> str:
        maintenance.write_by_date(views.trades(spark, sf_dir), root, TRADES)
        return root

    root = _once(spark, sf_dir, "by-date", build)
    return decimals_to_text(maintenance.read_by_date(spark, root, TRADES, "2024-01-08", "2024-01-14"))


def lake_two_checkpoints(spark, sf_dir):
    """Two cold paths with a checkpoint each, both starting at batch 0, and a rewrite in between."""

    def build(root: str) -> str:
        records = read_topic_files(spark, topic_path(spark, sf_dir))
        for part in (0, 1):
            records.filter(F.col("offset") % 2 == part).write.parquet(f"{root}/topic{part}")
        for part, lake in ((0, "small"), (1, "lake")):
            if part:
                for table in LAKE_TABLES:
                    maintenance.compact(spark, f"{root}/small", f"{root}/lake", table)
            cold.start_cold_path(
                stream_topic_files(spark, f"{root}/topic{part}"), f"{root}/{lake}", f"{root}/checkpoint{part}",
                cold.dead_letter_files(f"{root}/dead-letters"), available_now=True).awaitTermination()
        return root

    return decimals_to_text(read_table(spark, _once(spark, sf_dir, "two-checkpoints", build) + "/lake", TRADES))


def _live_after_two_checkpoints(spark, sf_dir) -> hot.LiveTables:
    """Live tables after a second query with a checkpoint of its own."""

    def build(root: str) -> hot.LiveTables:
        tables = hot.LiveTables(spark, f"{root}/live", WINDOW_KEEP, WINDOW_SLACK)
        records = read_topic_files(spark, topic_path(spark, sf_dir))
        middle = stats.middle_value(records, "offset")
        for part, rows in enumerate((records.filter(F.col("offset") <= middle), records.filter(F.col("offset") > middle))):
            rows.write.parquet(f"{root}/topic{part}")
            hot.start_hot_path(
                stream_topic_files(spark, f"{root}/topic{part}"), tables, f"{root}/checkpoint{part}",
                cold.dead_letter_files(f"{root}/dead-letters"), available_now=True).awaitTermination()
            hot.start_window_path(
                stream_topic_files(spark, f"{root}/topic{part}"), tables, f"{root}/window-checkpoint{part}",
                available_now=True).awaitTermination()
        return tables

    return _once(spark, sf_dir, "live-new-checkpoint", build)


def live_new_checkpoint(spark, sf_dir):
    return reads.live_trades(_live_after_two_checkpoints(spark, sf_dir).trade.read())


def live_window_new_checkpoint(spark, sf_dir):
    return _live_after_two_checkpoints(spark, sf_dir).kline_second.read()


PAGE_ROWS = 200
# Pages that one read of the lake brings.
PAGES_A_READ = 32


def pages_cover_all_rows(spark, sf_dir):
    """Candle pages of one series, each after the last row of the one before, put together."""

    def build(root: str) -> list[str]:
        pages, landed, after = LakePages(spark, flushed_lake(spark, sf_dir)), [], None
        while True:
            # Each stretch of pages is read once and landed; only its last row's key comes back.
            path = f"{root}/stretch={len(landed)}"
            pages.kline_pages(SYMBOL, "1d", PAGE_ROWS, PAGES_A_READ, after=after).drop("page").write.parquet(path)
            landed.append(path)
            last = spark.read.parquet(path).agg(F.min(F.struct("open_time", "kafka_partition", "kafka_offset"))).first()[0]
            if last is None:
                return landed
            after = tuple(last)

    return spark.read.parquet(*_once(spark, sf_dir, "pages", build))


# --- A lake of many flushes ----------------------------------------------------

FLUSHES = 12


def read_flush(spark: SparkSession, staged: str, table: LakeTable, batch_id: int) -> DataFrame:
    """Rows staged for one flush; none if no offset fell into it."""
    schema = T.StructType([*table.schema.fields, T.StructField("flush", T.LongType())])
    return spark.read.schema(schema).parquet(staged).filter(F.col("flush") == batch_id).drop("flush")


def flushed_lake(spark, sf_dir):
    """A lake of the three views in twelve flushes by offset, as a cold path leaves it."""

    def build(root: str) -> str:
        staged, tasks = f"{root}-staged", input_files(spark, sf_dir)
        for table in LAKE_TABLES:
            rows = SOURCE_OF[table.topic](spark, sf_dir, tasks)
            first, last = SOURCE_OF[table.topic](spark, sf_dir).agg(F.min("kafka_offset"), F.max("kafka_offset")).first()
            part = F.floor((F.col("kafka_offset") - first) * FLUSHES / (last - first + 1))
            # Every row is made once and laid with its flush; a flush reads its own rows alone.
            rows.withColumn("flush", part).write.partitionBy("flush").parquet(f"{staged}/{table.topic}")
        for batch_id in range(FLUSHES):
            flush = {t: read_flush(spark, f"{staged}/{t.topic}", t, batch_id) for t in LAKE_TABLES}
            sinks.write_tables(flush, root, batch_id)
        return root

    return _once(spark, sf_dir, "flushed", build)


def trades_newest_days(spark, sf_dir):
    return LakePages(spark, flushed_lake(spark, sf_dir)).trades(SYMBOL, 50)


def tickers_newest_flushes(spark, sf_dir):
    return LakePages(spark, flushed_lake(spark, sf_dir)).book_tickers(SYMBOL, 100)


def klines_newest_days(spark, sf_dir):
    return LakePages(spark, flushed_lake(spark, sf_dir)).klines(SYMBOL, INTERVAL)


def klines_window(spark, sf_dir):
    """A named window of time of one series; other days are neither listed nor read."""
    return LakePages(spark, flushed_lake(spark, sf_dir)).klines(SYMBOL, INTERVAL, 1000, time_range=RANGE_MS)


def candles_newest_days(spark, sf_dir):
    return LakePages(spark, flushed_lake(spark, sf_dir)).candles(SYMBOL, INTERVAL)


def trades_window_all(spark, sf_dir):
    """A window of time over all symbols."""
    return decimals_to_text(read_table(spark, flushed_lake(spark, sf_dir), TRADES, time_range=RANGE_MS))


def compaction_in_place(spark, sf_dir):
    """The cold path over half of the topic, compaction of its lake, then the other half from its checkpoint."""

    def build(root: str) -> str:
        records = read_topic_files(spark, topic_path(spark, sf_dir))
        for part in range(4):
            records.filter(F.col("offset") % 4 == part).write.parquet(f"{root}/landed{part}")
        for part in range(4):
            spark.read.parquet(f"{root}/landed{part}").write.mode("append").parquet(f"{root}/topic")
            cold.start_cold_path(
                stream_topic_files(spark, f"{root}/topic"), f"{root}/lake", f"{root}/checkpoint",
                cold.dead_letter_files(f"{root}/dead-letters"), available_now=True).awaitTermination()
            if part == 2:
                for table in LAKE_TABLES:
                    maintenance.compact_in_place(spark, f"{root}/lake", table)
        return f"{root}/lake"

    return decimals_to_text(read_table(spark, _once(spark, sf_dir, "in-place", build), KLINES))


def retention_drops_days(spark, sf_dir):
    """Rows before a moment inside a day leave a lake of many flushes in place."""

    def build(root: str) -> str:
        for batch_id in range(3):
            rows = views.trades(spark, sf_dir)
            sinks.write_lake(rows.filter(F.col("kafka_offset") % 3 == batch_id), root, TRADES, batch_id)
        maintenance.drop_before(spark, root, TRADES, INSIDE_DAY_MS)
        return root

    return decimals_to_text(read_table(spark, _once(spark, sf_dir, "retention-in-place", build), TRADES))


QUERIES: dict[str, Query] = {
    "frame_decode_stats": frame_decode_stats,
    "frame_stats_line": frame_stats_line,
    "frame_error_budget": frame_error_budget,
    "decoded_trades": decoded_trades,
    "decoded_tickers": decoded_tickers,
    "decoded_klines": decoded_klines,
    "bad_frames": bad_frames,
    "control_frames": control_frames,
    "topic_rows": topic_rows,
    "envelope_dispatch": envelope_dispatch,
    "schema_version_dispatch": schema_version_dispatch,
    "empty_payloads": empty_payloads,
    "dead_letters": dead_letters,
    "path_counters": path_counters,
    "symbol_mismatches": symbol_mismatches,
    "raw_frame_recorder": raw_frame_recorder,
    "recorder_stream": recorder_stream,
    "decode_only_replay": decode_only_replay,
    "ingest_stream": ingest_stream,
    "lake_roundtrip_trades": _roundtrip(TRADES),
    "lake_roundtrip_tickers": _roundtrip(BOOK_TICKERS),
    "lake_roundtrip_klines": _roundtrip(KLINES),
    "lake_replay_idempotent": lake_replay_idempotent,
    "cold_stream_trades": _cold_table(TRADES),
    "cold_stream_tickers": _cold_table(BOOK_TICKERS),
    "cold_stream_klines": _cold_table(KLINES),
    "cold_stream_dead_letters": cold_stream_dead_letters,
    "flush_manifest": flush_manifest,
    "rows_per_flush": rows_per_flush,
    "commit_offsets": commit_offsets,
    "trades_latest": trades_latest,
    "trades_latest_all": trades_latest_all,
    "trades_unknown_symbol": trades_unknown_symbol,
    "trade_seed": trade_seed,
    "tickers_latest": tickers_latest,
    "klines_page": klines_page,
    "klines_page_all": klines_page_all,
    "klines_range": klines_range,
    "klines_before": klines_before,
    "klines_latest_per_open": klines_latest_per_open,
    "candles": candles,
    "candle_series": candle_series,
    "candle_direction": candle_direction_series,
    "rows_as_json": rows_as_json,
    "newest_candle": newest_candle,
    "visible_slice": visible_slice,
    "visible_slice_page": visible_slice_page,
    "price_range": price_range,
    "live_trade": live_trade,
    "live_book_ticker": live_book_ticker,
    "live_kline": live_kline,
    "live_window": live_window,
    "live_window_symbol": live_window_symbol,
    "live_window_count": live_window_count,
    "live_fanout": live_fanout,
    "live_sql": live_sql,
    "live_subscription": live_subscription,
    "window_batch": window_batch,
    "merged_chart": merged_chart,
    "merge_all_series": merge_all_series,
    "live_candles": live_candles,
    "rest_rows_to_klines": rest_rows_to_klines,
    "rest_rows_rejected": rest_rows_rejected,
    "landed_history": landed_history,
    "landed_rejected": landed_rejected,
    "lake_two_checkpoints": lake_two_checkpoints,
    "live_new_checkpoint": live_new_checkpoint,
    "pages_cover_all_rows": pages_cover_all_rows,
    "backfill_union": backfill_union,
    "invalid_intervals": invalid_intervals,
    "interval_lists": interval_lists,
    "symbol_validation": symbol_validation,
    "feed_coverage": feed_coverage,
    "series_staleness": series_staleness,
    "compaction_preserves_rows": compaction_preserves_rows,
    "retention_cut": retention_cut,
    "date_partition_scan": date_partition_scan,
    "trades_newest_days": trades_newest_days,
    "tickers_newest_flushes": tickers_newest_flushes,
    "klines_newest_days": klines_newest_days,
    "klines_window": klines_window,
    "candles_newest_days": candles_newest_days,
    "trades_window_all": trades_window_all,
    "compaction_in_place": compaction_in_place,
    "retention_drops_days": retention_drops_days,
    "path_metrics": path_metrics,
    "live_changes": live_changes,
    "live_changes_window": live_changes_window,
    "live_window_batches": live_window_batches,
    "live_window_out_of_order": live_window_out_of_order,
    "live_window_new_checkpoint": live_window_new_checkpoint,
}
