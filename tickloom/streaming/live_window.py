"""The rolling candle window as keyed state of a stream.

Per symbol the state is the open times that the window holds, so a batch costs what
arrived: arrivals of a symbol are taken in order, each updates, inserts or trims as it
comes, and what goes out are the rows that changed. Nothing is planned around whether a
trim may happen, and a late or returning candle is one more arrival.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators.decode import decode_envelopes
from tickloom.operators.latest import CHANGE, DELETED, INSERTED, UPDATED
from tickloom.operators.window import window_arrivals
from tickloom.schemas import LIVE_KLINE_SECOND, WINDOW_KEEP, WINDOW_SLACK

_ARRIVAL = ["kafka_partition", "kafka_offset"]
CHANGES = T.StructType([
    *[T.StructField(f.name, f.dataType, f.name not in ("symbol", "open_time")) for f in LIVE_KLINE_SECOND.fields],
    T.StructField(CHANGE, T.StringType(), False)])


def arrive(held: list[int], times: list[int], keep: int, slack: int) -> list[int]:
    """Open times held after these arrived one by one; both lists of held times are sorted."""
    held = list(held)
    for time in times:
        at = bisect_left(held, time)
        if at < len(held) and held[at] == time:
            continue
        held.insert(at, time)
        if len(held) > keep + slack:
            held = held[-keep:]
    return held


class RollingWindow(StatefulProcessor):
    """Changes of a symbol's window in a batch: its newest rows that are held, and the keys that left."""

    def __init__(self, keep: int, slack: int):
        self._keep, self._slack = keep, slack

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._held = handle.getValueState("held", "times array<bigint>")

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:
        known = set(self._held.get()[0]) if self._held.exists() else set()
        self._held.update((sorted(known | set(initialState["open_time"].tolist())),))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrivals = pd.concat(list(rows)).sort_values(_ARRIVAL, kind="stable")
        before = list(self._held.get()[0]) if self._held.exists() else []
        after = arrive(before, arrivals["open_time"].tolist(), self._keep, self._slack)
        self._held.update((after,))
        known, held = set(before), set(after)
        newest = arrivals.drop_duplicates("open_time", keep="last")
        newest = newest[newest["open_time"].isin(held)].copy()
        newest[CHANGE] = [UPDATED if t in known else INSERTED for t in newest["open_time"]]
        gone = sorted(known - held)
        if gone:
            deleted = pd.DataFrame({"symbol": key[0], "open_time": gone, CHANGE: DELETED})
            newest = pd.concat([newest, deleted.reindex(columns=newest.columns)])
        yield newest[CHANGES.names].astype({"trade_count": "Int64", "close_time": "Int64", "is_closed": "boolean"})

    def close(self) -> None:
        pass


def window_changes(
    records: DataFrame, held: DataFrame, keep: int = WINDOW_KEEP, slack: int = WINDOW_SLACK, strict_version: bool = False
) -> DataFrame:
    """Changes of the window per micro-batch; ``held`` is what it holds before the first one.

    Needs the RocksDB state store (``with_keyed_state``).
    """
    arrivals = window_arrivals(decode_envelopes(records, strict_version))
    return arrivals.groupBy("symbol").transformWithStateInPandas(
        RollingWindow(keep, slack), CHANGES, "Update", "None", held.select("symbol", "open_time").groupBy("symbol"))


# State is one list per symbol: more partitions only start more stores and workers in every batch.
STATE_PARTITIONS = 16


class with_keyed_state:
    """The state store that keyed state needs, in few partitions, for queries started inside; others keep theirs.

    A checkpoint that was begun with another number of partitions goes on with it.
    """

    _PROVIDER = "spark.sql.streaming.stateStore.providerClass"
    _CLASS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    _PARTITIONS = "spark.sql.shuffle.partitions"

    def __init__(self, spark: SparkSession):
        self._conf = spark.conf

    def __enter__(self) -> None:
        self._before = {key: self._conf.get(key, None) for key in (self._PROVIDER, self._PARTITIONS)}
        self._conf.set(self._PROVIDER, self._CLASS)
        self._conf.set(self._PARTITIONS, min(STATE_PARTITIONS, int(self._conf.get(self._PARTITIONS))))

    def __exit__(self, *_) -> None:
        for key, value in self._before.items():
            if value is None:
                self._conf.unset(key)
            else:
                self._conf.set(key, value)
