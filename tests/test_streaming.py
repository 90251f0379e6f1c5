import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tests.samples import TICKER, TRADE, candle_payload, envelope, frame, records
from tests.test_window import Reference
from tickloom.operators import maintenance, stats
from tickloom.operators.decode import decode_envelopes
from tickloom.operators.latest import apply_changes, changes_between
from tickloom.plans import queries as reads
from tickloom.schemas import BOOK_TICKERS, KLINES, TRADES
from tickloom.sources.frames import stream_frames
from tickloom.sources.lake import read_table
from tickloom.sources.topics import stream_topic_files
from tickloom.streaming import cold, hot, ingest, metrics, sinks
from tickloom.streaming.live_window import CHANGES, arrive
from tickloom.streaming.snapshots import Snapshot

TRADES_TOPIC, TICKERS_TOPIC, KLINES_TOPIC = TRADES.topic, BOOK_TICKERS.topic, KLINES.topic


def land(spark, path, rows):
    records(spark, rows).coalesce(1).write.mode("append").parquet(path)


def trade(symbol, price, offset):
    return (symbol, envelope("agg_trade", {**TRADE, "s": symbol, "p": price, "a": offset}), TRADES_TOPIC, 1, offset)


def candle(symbol, interval, open_time, offset, close="1.5"):
    return (symbol, envelope("kline", candle_payload(symbol, interval, open_time, close)), KLINES_TOPIC, 2, offset)


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def test_cold_path_resumes_without_loss_or_repeats(spark, tmp_path):
    topic, lake, parked, checkpoint = (str(tmp_path / name) for name in ("topic", "lake", "dlq", "checkpoint"))

    def run(sink):
        return cold.start_cold_path(stream_topic_files(spark, topic), lake, checkpoint, sink, available_now=True)

    land(spark, topic, [
        trade("A", "1.5", 1), trade("A", "0.000000015", 2), ("A", "junk", TRADES_TOPIC, 1, 3), ("A", None, TRADES_TOPIC, 1, 4),
        candle("A", "1m", 0, 5), ("A", envelope("book_ticker", {**TICKER, "s": "A"}), TICKERS_TOPIC, 0, 6),
        ("B", envelope("agg_trade", {**TRADE, "s": "B"}), KLINES_TOPIC, 1, 7),
    ])
    drain(run(cold.dead_letter_files(parked)))
    assert sorted((r["symbol"], r["kafka_offset"]) for r in read_table(spark, lake, TRADES).collect()) == [("A", 1), ("A", 2), ("B", 7)]
    assert f"{read_table(spark, lake, TRADES, 'A').filter('kafka_offset = 2').first()['price']:.8f}" == "0.00000002"
    assert read_table(spark, lake, KLINES, "A", "1m").count() == 1
    assert read_table(spark, lake, BOOK_TICKERS).count() == 1
    dead = spark.read.parquet(parked).collect()
    assert [bytes(r["value"]) for r in dead] == [b"junk"] and dead[0]["consumer"] == "cold"

    # The second batch fails after its lake write began: nothing is committed.
    land(spark, topic, [trade("A", "3", 8), ("A", "junk2", TRADES_TOPIC, 1, 9)])
    real_write, calls = sinks.write_lake, []

    def failing_write(rows, root, table, batch_id, writer):
        calls.append(table)
        if table is KLINES:
            raise OSError("upload failed")
        real_write(rows, root, table, batch_id, writer)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(sinks, "write_lake", failing_write)
        with pytest.raises(Exception, match="upload failed"):
            run(cold.dead_letter_files(parked)).awaitTermination()
    assert TRADES in calls
    drain(run(cold.dead_letter_files(parked)))
    drain(run(cold.dead_letter_files(parked)))
    assert sorted(r["kafka_offset"] for r in read_table(spark, lake, TRADES).collect()) == [1, 2, 7, 8]
    assert sorted(bytes(r["value"]) for r in spark.read.parquet(parked).collect()) == [b"junk", b"junk2"]


def test_dead_letters_come_before_the_lake(spark, tmp_path):
    def unavailable(rows, batch_id, writer):
        raise OSError("dead-letter topic unavailable")

    batch = records(spark, [trade("A", "1.5", 1)])
    with pytest.raises(OSError):
        cold.cold_batch(batch, 0, str(tmp_path), unavailable)
    assert read_table(spark, str(tmp_path), TRADES).count() == 0


def test_hot_path_over_several_batches(spark, tmp_path):
    topic, parked, checkpoint = (str(tmp_path / name) for name in ("topic", "dlq", "checkpoint"))
    tables = hot.LiveTables(spark, str(tmp_path / "live"), keep=5, slack=2)
    expected = Reference(5, 2)
    offset = 0

    def seconds(times):
        nonlocal offset
        rows = []
        for t in times:
            offset += 1
            expected.arrive("A", t, f"{offset}.10")
            rows.append(candle("A", "1s", t, offset, f"{offset}.10"))
        return rows

    batches = [
        lambda: [*seconds(range(0, 9000, 1000)), candle("A", "1m", 60_000, 900), trade("A", "007.50", 901), trade("A", "8.0", 902)],
        lambda: [*seconds([9000, 9000, 3000, 10_000, 11_000]), candle("A", "1m", 0, 903), ("A", "junk", TRADES_TOPIC, 1, 904)],
        lambda: [*seconds([2000, 12_000, 2000, 13_000]), trade("B", "2.00", 905), trade("A", "7.9", 1)],
        lambda: [("A", envelope("book_ticker", {**TICKER, "s": "A", "b": "1.10", "a": "1.234"}), TICKERS_TOPIC, 0, 5)],
    ]
    for batch in batches:
        land(spark, topic, batch())
        drain(hot.start_hot_path(
            stream_topic_files(spark, topic), tables, checkpoint, cold.dead_letter_files(parked), available_now=True,
        ))
        drain(hot.start_window_path(stream_topic_files(spark, topic), tables, checkpoint + "-window", available_now=True))
        got = sorted((r["symbol"], r["open_time"], r["close"]) for r in tables.kline_second.read().collect())
        assert got == expected.table()

    # An older candle that arrives later replaces the current one.
    current = {r["id"]: r["open_time"] for r in tables.kline.read().collect()}
    assert current["A:1m"] == 0 and current["A:1s"] == 13_000
    assert {r["symbol"]: (r["price"], r["side"]) for r in reads.live_trades(tables.trade.read()).collect()} == {
        "A": ("7.9", "sell"), "B": ("2.00", "sell")}
    assert reads.live_tickers(tables.book_ticker.read()).first()["spread"] == "0.13"
    assert [bytes(r["value"]) for r in spark.read.parquet(parked).collect()] == [b"junk"]
    tables.register_views(spark)
    assert reads.live_sql(spark, "SELECT count(*) AS n FROM live_kline").first()["n"] == 2
    chart = reads.live_chart(read_table(spark, str(tmp_path / "none"), KLINES), tables.kline_second.read(), "A")
    assert [r["open_time"] for r in chart.collect()] == [t for _, t, _ in expected.table()]


def test_applying_a_version_twice_changes_nothing(spark, tmp_path):
    tables = hot.LiveTables(spark, str(tmp_path), keep=3, slack=1)
    first = decode_envelopes(records(spark, [candle("A", "1s", t, t) for t in range(5)] + [trade("A", "1", 9)]))
    second = decode_envelopes(records(spark, [candle("A", "1s", t, t) for t in range(5, 8)]))
    change = lambda t, what: (f"A:{t}", "A", *["1"] * 6, 1, t, t + 1, True, what)
    changes = [spark.createDataFrame(rows, CHANGES) for rows in (
        [change(t, "insert") for t in (1, 2, 3)], [change(4, "insert"), change(3, "update"), change(1, "delete")])]
    state = lambda: [sorted(map(tuple, s.read().collect())) for s in (tables.trade, tables.kline, tables.kline_second)]
    for batch_id, decoded in enumerate((first, second)):
        tables.apply(decoded, batch_id)
        tables.apply_window(changes[batch_id], batch_id)
    once = state()
    tables.apply(second, 1)
    tables.apply_window(changes[1], 1)
    assert state() == once and once[0][0][1] == "1" and [r[9] for r in once[2]] == [2, 3, 4]


def test_snapshots_keep_a_few_complete_versions(spark, tmp_path):
    from tickloom.schemas import LIVE_TRADE

    snapshot = Snapshot(spark, str(tmp_path), "t", LIVE_TRADE, retain_seconds=0)
    assert snapshot.versions() == [] and snapshot.read().count() == 0
    for version in range(6):
        snapshot.write(spark.createDataFrame([("A", str(version), "1", 1, 1, True)], LIVE_TRADE), version)
    snapshot.drop_old()
    assert snapshot.versions() == [("direct", n) for n in (3, 4, 5)]
    assert snapshot.read().first()["price"] == "5" and snapshot.before(5).first()["price"] == "4"
    (tmp_path / "t" / "version=000000000009-direct-9").mkdir()
    assert snapshot.versions() == [("direct", n) for n in (3, 4, 5)]


def test_readers_keep_their_version(spark, tmp_path):
    from tickloom.schemas import LIVE_TRADE

    snapshot = Snapshot(spark, str(tmp_path), "t", LIVE_TRADE)
    write = lambda n: snapshot.write(spark.createDataFrame([("A", str(n), "1", 1, 1, True)], LIVE_TRADE), n)
    write(0)
    open_ = snapshot.read()
    for n in range(1, 6):
        write(n)
    assert open_.first()["price"] == "0" and len(snapshot.versions()) == 6


def test_a_new_checkpoint_goes_on(spark, tmp_path):
    """Batch ids start anew with a checkpoint; lake rows, dead letters and live state stay."""
    lake, parked = str(tmp_path / "lake"), str(tmp_path / "dlq")
    tables = hot.LiveTables(spark, str(tmp_path / "live"), keep=5, slack=2)
    for run in (1, 2):
        topic = str(tmp_path / f"topic{run}")
        land(spark, topic, [trade("A", f"{run}.5", run), candle("A", "1s", run * 1000, run), ("A", f"junk{run}", TRADES_TOPIC, 1, run)])
        for _ in range(2):  # the second drain has nothing to do
            drain(cold.start_cold_path(
                stream_topic_files(spark, topic), lake, str(tmp_path / f"cold{run}"), cold.dead_letter_files(parked), available_now=True))
            drain(hot.start_hot_path(
                stream_topic_files(spark, topic), tables, str(tmp_path / f"hot{run}"), cold.dead_letter_files(str(tmp_path / "dlq2")), available_now=True))
            drain(hot.start_window_path(stream_topic_files(spark, topic), tables, str(tmp_path / f"window{run}"), available_now=True))
    assert sorted(r["kafka_offset"] for r in read_table(spark, lake, TRADES).collect()) == [1, 2]
    assert sorted(bytes(r["value"]) for r in spark.read.parquet(parked).collect()) == [b"junk1", b"junk2"]
    assert tables.trade.read().first()["price"] == "2.5"
    assert sorted(r["open_time"] for r in tables.kline_second.read().collect()) == [1000, 2000]
    maintenance.compact(spark, lake, lake + "-large", TRADES)
    topic = str(tmp_path / "topic3")
    land(spark, topic, [trade("A", "3.5", 3)])
    drain(cold.start_cold_path(
        stream_topic_files(spark, topic), lake + "-large", str(tmp_path / "cold3"), cold.dead_letter_files(parked), available_now=True))
    assert sorted(r["kafka_offset"] for r in read_table(spark, lake + "-large", TRADES).collect()) == [1, 2, 3]


def test_ingest_counts_and_publishes(spark, tmp_path):
    frames, out, checkpoint = (str(tmp_path / name) for name in ("frames", "out", "checkpoint"))
    texts = [frame("a@aggTrade", TRADE), frame("a@depth", {}), frame("!serverShutdown", {}), "", frame("a@bookTicker", TICKER)]
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(frames)
    query = ingest.start_ingest(
        stream_frames(spark, frames), lambda rows, batch: sinks.write_records(rows, out, batch), checkpoint, available_now=True,
    )
    drain(query)
    counts = next(p.observedMetrics["ingest"].asDict() for p in query.recentProgress if "ingest" in p.observedMetrics)
    assert counts == {
        "events": 2, "agg_trades": 1, "book_tickers": 1, "klines": 0, "decode_errors": 1, "server_shutdowns": 1}
    rows = spark.read.parquet(out).collect()
    assert sorted((r["topic"], r["key"]) for r in rows) == [(TICKERS_TOPIC, "NOVAUSD"), (TRADES_TOPIC, "NOVAUSD")]
    assert json.loads(rows[0]["value"])["schema_version"] == 1


def test_update_stream(spark, tmp_path):
    topic, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    seen = []

    def follow():
        updates = hot.latest_stream(stream_topic_files(spark, topic), "agg_trade", ["symbol"])
        drain(updates.writeStream.outputMode("update").foreachBatch(
            lambda batch, _: seen.append({r["symbol"]: r["price"] for r in batch.collect()})
        ).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())

    land(spark, topic, [trade("A", "1", 1), trade("A", "2", 2), trade("B", "5", 3)])
    follow()
    land(spark, topic, [trade("A", "3", 4)])
    follow()
    assert [batch for batch in seen if batch] == [{"A": "2", "B": "5"}, {"A": "3"}]


def test_recorder_starts_over(spark, tmp_path):
    path = str(tmp_path / "frames")
    for text in ("one", "two"):
        sinks.record_frames(spark.createDataFrame([(text,)], "value string"), path)
    assert [r["value"] for r in spark.read.text(path).collect()] == ["two"]
    sinks.discard(spark.range(3).withColumn("x", F.col("id") + 1))


def test_window_state_one_arrival_at_a_time():
    rng = random.Random(6)
    for _ in range(200):
        keep, slack = rng.randint(1, 6), rng.randint(0, 3)
        reference, held = Reference(keep, slack), []
        for _ in range(5):
            times = [rng.randint(0, 20) for _ in range(rng.randint(0, 12))]
            held = arrive(held, times, keep, slack)
            for t in times:
                reference.arrive("A", t, "x")
            assert held == [t for _, t, _ in reference.table()]


def test_change_feed_rebuilds_the_window(spark, tmp_path):
    """Late and returning candles over several batches, one of which fails after its table was written."""
    topic, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    tables = hot.LiveTables(spark, str(tmp_path / "live"), keep=4, slack=2, feed=str(tmp_path / "feed"))
    expected, offset, rng = Reference(4, 2), 0, random.Random(7)

    def run():
        return hot.start_window_path(stream_topic_files(spark, topic), tables, checkpoint, available_now=True)

    for batch in range(4):
        rows = []
        for t in [1000 * (3 * batch + rng.randint(-4, 6)) for _ in range(9)]:
            offset += 1
            symbol = rng.choice("AB")
            expected.arrive(symbol, t, f"{offset}.5")
            rows.append(candle(symbol, "1s", t, offset, f"{offset}.5"))
        rng.shuffle(rows)
        land(spark, topic, rows)
        if batch in (0, 2):
            with pytest.MonkeyPatch.context() as patch:
                def lost(*_):
                    raise OSError("feed lost")

                patch.setattr(tables, "_tell", lost)
                with pytest.raises(Exception, match="feed lost"):
                    run().awaitTermination()
        drain(run())
        state = lambda rows: sorted((r["symbol"], r["open_time"], r["close"]) for r in rows)
        assert state(tables.kline_second.read().collect()) == expected.table()
        last = {}
        for r in sorted(tables.read_feed(tables.kline_second).collect(), key=lambda r: r["batch"]):
            last[(r["symbol"], r["open_time"])] = r
        assert state(r for r in last.values() if r["change"] != "delete") == expected.table()
    assert {r["change"] for r in last.values()} >= {"insert", "delete"}


def test_changes_between_states(spark):
    schema = "symbol string, price string, n int"
    frame_of = lambda rows: spark.createDataFrame(rows, schema)
    before = frame_of([("A", "1", None), ("B", "2", 1), ("C", None, 1), ("D", "4", 4)])
    after = frame_of([("A", "1", None), ("B", "2", None), ("C", None, 1), ("E", "5", 5)])
    changes = changes_between(before, after, ["symbol"])
    assert sorted(map(tuple, changes.collect())) == [
        ("B", "2", None, "update"), ("D", None, None, "delete"), ("E", "5", 5, "insert")]
    assert sorted(map(tuple, apply_changes(before, changes, ["symbol"]).collect()), key=str) == sorted(map(tuple, after.collect()), key=str)


def test_listing_of_many_versions_is_flat(spark, tmp_path):
    from tickloom.schemas import LIVE_TRADE

    snapshot = Snapshot(spark, str(tmp_path), "t", LIVE_TRADE)
    snapshot.write(spark.createDataFrame([("A", "1", "1", 1, 1, True)], LIVE_TRADE), 0)
    for n in range(1, 4000):
        (tmp_path / "t" / f"version={n:012d}-direct-{n}").mkdir()
        (tmp_path / "t" / f"version={n:012d}-direct-{n}" / "_SUCCESS").touch()
    started = time.time()
    assert len(snapshot._entries()) == 4000
    assert time.time() - started < 2


def test_counters_of_a_batch_that_ran_twice(spark, tmp_path):
    topic, checkpoint, counted = (str(tmp_path / name) for name in ("topic", "checkpoint", "metrics"))
    lake, parked = str(tmp_path / "lake"), str(tmp_path / "dlq")

    def run():
        return cold.start_cold_path(
            stream_topic_files(spark, topic), lake, checkpoint, cold.dead_letter_files(parked), available_now=True, metrics=counted)

    land(spark, topic, [trade("A", "1", 1), ("A", "junk", TRADES_TOPIC, 1, 2), ("A", None, TRADES_TOPIC, 1, 3), candle("A", "1m", 0, 4)])
    with pytest.MonkeyPatch.context() as patch:
        def lost(*args):
            metrics.record_metrics(*args)
            raise OSError("lost after counting")

        patch.setattr(cold, "record_metrics", lost)
        with pytest.raises(Exception, match="lost after counting"):
            run().awaitTermination()
    drain(run())
    land(spark, topic, [trade("A", "2", 5)])
    drain(run())
    totals = stats.total_metrics(metrics.read_metrics(spark, counted)).collect()
    assert sorted(map(tuple, totals)) == [("cold", KLINES_TOPIC, 1, 0, 1, 0), ("cold", TRADES_TOPIC, 4, 1, 2, 1)]
