"""Steps that must grow with the input, on rows of their own."""

import random

import pytest
from pyspark.sql import functions as F

from checks import registry, views
from tests.samples import TRADE, envelope, records
from tickloom.operators import decode, encode, stats
from tickloom.plans.lake_pages import LakePages
from tickloom.plans.queries import next_cursor
from tickloom.schemas import KLINES
from tickloom.streaming import sinks
from tickloom.streaming.live_window import STATE_PARTITIONS, with_keyed_state


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """A table folder with 900 events of two symbols over ten days."""
    folder = str(tmp_path_factory.mktemp("tables"))
    i = F.col("id")
    spark.range(900).select(
        i.alias("event_id"), F.timestamp_millis(F.lit(1_704_067_200_000) + i * 960_000).cast("timestamp_ntz").alias("ts"),
        (i % 8).alias("user_id"), F.when(i % 5 == 0, "view").otherwise("click").alias("event_type"),
        (i % 50 + 1.25).alias("value"), F.concat(F.lit('{"k": '), (i % 90).cast("string"), F.lit("}")).alias("props"),
    ).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_records_are_made_by_as_many_tasks_as_asked(spark, events):
    dealt, whole = views.topic_records(spark, events, 5), views.topic_records(spark, events)
    assert (dealt.rdd.getNumPartitions(), whole.rdd.getNumPartitions()) == (5, 1)
    assert rows_of(dealt) == rows_of(whole)


def test_written_inputs_have_a_file_for_so_many_rows(spark, events, monkeypatch):
    assert registry.input_files(spark, events) == registry.INPUT_FILES
    monkeypatch.setattr(registry, "FILE_ROWS", 40)
    assert registry.input_files(spark, events) == 23


def test_a_flush_reads_its_own_rows_alone(spark, events, tmp_path):
    rows = views.klines(spark, events).withColumn("flush", F.col("kafka_offset") % 3)
    rows.write.partitionBy("flush").parquet(f"{tmp_path}/rows")
    flush = registry.read_flush(spark, f"{tmp_path}/rows", KLINES, 1)
    assert rows_of(flush.select(KLINES.schema.names)) == rows_of(rows.filter("flush = 1").select(KLINES.schema.names))
    plan = flush._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(flush" in plan
    assert registry.read_flush(spark, f"{tmp_path}/rows", KLINES, 7).count() == 0


def test_pages_of_one_read_are_the_pages_by_cursor(spark, events, tmp_path):
    for flush in range(2):
        rows = views.klines(spark, events).filter(F.col("kafka_offset") % 2 == flush)
        sinks.write_lake(rows, str(tmp_path), KLINES, flush)
    pages, after, walked = LakePages(spark, str(tmp_path)), None, []
    while True:
        page = pages.klines("CLICK", "1d", 7, after=after).collect()
        after = next_cursor(page, "open_time")
        if after is None:
            break
        walked.append(sorted(r["kafka_offset"] for r in page if r["is_closed"]))
    found = pages.kline_pages("CLICK", "1d", 7, 1000).groupBy("page").agg(F.sort_array(F.collect_list("kafka_offset")).alias("o"))
    assert [r["o"] for r in found.orderBy("page").collect()] == walked and len(walked) > 2
    first = pages.klines("CLICK", "1d", 7)
    rest = pages.kline_pages("CLICK", "1d", 7, 2, after=next_cursor(first.collect(), "open_time"))
    assert [r["o"] for r in rest.groupBy("page").agg(F.sort_array(F.collect_list("kafka_offset")).alias("o")).orderBy("page").collect()] == walked[1:3]


def test_a_walk_over_pages_is_landed_by_stretch(spark, events, monkeypatch):
    monkeypatch.setattr(registry, "PAGE_ROWS", 3)
    monkeypatch.setattr(registry, "PAGES_A_READ", 2)
    found = registry.pages_cover_all_rows(spark, events)
    closed = views.klines(spark, events).filter("symbol = 'CLICK' AND interval = '1d' AND is_closed")
    assert sorted(r[0] for r in found.select("kafka_offset").collect()) == sorted(r[0] for r in closed.select("kafka_offset").collect())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and closed.count() > 2 * 3


@pytest.mark.parametrize("values", [[], [None], [5], [7, None, 7], [3, 1], [-4, 10**12, 0, None, 2], "many"])
def test_middle_value(spark, values):
    if values == "many":
        rng = random.Random(3)
        values = [rng.choice([rng.randrange(10**6), 77]) for _ in range(3001)]
    rows = spark.createDataFrame([(v,) for v in values], "offset bigint")
    known = rows.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY offset)")).first()[0]
    assert stats.middle_value(rows, "offset") == known


def test_a_batch_keeps_texts_of_parked_records_alone(spark):
    good, bad = envelope("agg_trade", TRADE), envelope("candle", TRADE)
    decoded = decode.decode_envelopes(records(spark, [("A", good, "market.trades", 0, 1), (None, bad, "market.trades", 0, 2)]))
    kept = decode.for_sinks(decoded)
    assert [(r["offset"], r["value"] is None, r["key"] is None) for r in kept.orderBy("offset").collect()] == [
        (1, True, True), (2, False, True)]
    assert rows_of(encode.dead_letters(kept, "cold")) == rows_of(encode.dead_letters(decoded, "cold"))


def test_keyed_state_is_in_few_partitions(spark):
    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(key, "300")
    try:
        with with_keyed_state(spark):
            assert int(spark.conf.get(key)) == STATE_PARTITIONS
        assert spark.conf.get(key) == "300"
    finally:
        spark.conf.set(key, before)


def test_backfill_fields_come_from_one_parse(spark, events, tmp_path):
    folder = tmp_path / "t"
    spark.read.parquet(f"{events}/events.parquet").write.parquet(f"{folder}/events.parquet")
    spark.range(40).select(
        F.col("id").alias("o_orderkey"), F.lit("O").alias("o_orderstatus"), F.lit(10.5).alias("o_totalprice"),
        F.to_timestamp_ntz(F.lit("1996-01-02 00:00:00")).alias("o_orderdate"), (F.col("id") + 1).alias("o_custkey"),
    ).write.parquet(f"{folder}/orders.parquet")
    found = registry.backfill_union(spark, str(folder))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan
    first = found.filter("key = 'O'")
    row = first.orderBy("volume").first()
    assert (row["interval"], row["open"], row["first_trade_id"], row["volume"]) == ("1d", "10.50000000", -1, "1.5")
    assert found.filter("open_time IS NULL OR is_closed IS NULL").count() == 0
