"""Historical candles landed as positional JSON rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.functions.decimals import canonical_decimal_text
from tickloom.functions.strict_json import JSON_OPTIONS, USUAL, is_wrong, long_value, rarely
from tickloom.operators.decode import event_type
from tickloom.schemas import AGG_TRADE, BOOK_TICKER, KLINE, KLINE_EVENT_FIELDS, KLINE_FIELDS

# Positions in a historical row; trade ids are not provided there.
ROW_POSITIONS = {
    "open_time": 0, "open": 1, "high": 2, "low": 3, "close": 4, "volume": 5, "close_time": 6,
    "quote_volume": 7, "trade_count": 8, "taker_buy_base_volume": 9, "taker_buy_quote_volume": 10,
}
NO_TRADE_ID = -1

_KINDS = {f.name: f.kind for f in KLINE_FIELDS}


def read_responses(spark: SparkSession, root: str) -> DataFrame:
    """Landed responses under ``symbol=…/interval=…``, one response per line.

    A response holds at most 1000 rows, which bounds the text of one record.
    """
    return spark.read.schema("value string, symbol string, interval string").text(root)


def response_rows(responses: DataFrame) -> DataFrame:
    """One positional ``row`` per candle; no response goes unseen.

    What is no array, in part or whole, becomes a row without values, which decodes to
    an error: one for a bad element, one for a response that cannot be read at all. An
    empty array has no rows.
    """
    whole = F.try_parse_json("value")
    elements = F.try_variant_get(whole, "$", "array<variant>")
    rows = F.transform(F.coalesce(elements, F.array(F.lit(None).cast("variant"))), lambda x: F.try_variant_get(x, "$", "array<variant>"))
    return responses.select("symbol", "interval", F.explode(rows).alias("row"))


def parse_row_text(rows: DataFrame, text: str = "row_text") -> DataFrame:
    """``row`` from the JSON text of a single positional row."""
    wrapped = F.from_json(
        F.concat(F.lit('{"row":'), F.col(text), F.lit("}")), "row array<variant>", JSON_OPTIONS
    )
    return rows.withColumn("row", wrapped["row"])


# Fields past the last position are not looked at.
_USUAL_ROW = r"^\[" + ",".join(USUAL[_KINDS[name]] for name in ROW_POSITIONS) + r"[,\]]"


def _at(row: Column, name: str) -> Column:
    return F.get(row, F.lit(ROW_POSITIONS[name]))


def _first_bad(row: Column) -> Column:
    return F.coalesce(*[
        F.when(is_wrong(_at(row, name), _KINDS[name]), F.lit(str(at))) for name, at in ROW_POSITIONS.items()
    ])


def _event(row: Column, now_ms: int, canonical: bool) -> Column:
    def value(name: str) -> Column:
        if _KINDS[name] == "long":
            return long_value(_at(row, name))
        text = _at(row, name).cast("string")
        return text if canonical else canonical_decimal_text(text)

    derived = {
        "symbol": F.col("symbol"),
        "interval": F.col("interval"),
        "first_trade_id": F.lit(NO_TRADE_ID).cast("bigint"),
        "last_trade_id": F.lit(NO_TRADE_ID).cast("bigint"),
        "is_closed": value("close_time") < F.lit(now_ms),
        "event_type": F.lit(KLINE),
        "event_time": F.lit(now_ms).cast("bigint"),
        "event_symbol": F.col("symbol"),
    }
    fields = (*KLINE_EVENT_FIELDS, *KLINE_FIELDS)
    return F.struct(*[(derived[f.name] if f.name in derived else value(f.name)).alias(f.name) for f in fields])


def decode_rows(rows: DataFrame, now_ms: int) -> DataFrame:
    """Candle events from positional rows, in the shape of decoded live events: they
    go to ``encode.to_topic_rows`` as they are.

    ``symbol`` and ``interval`` come from the request. A candle is closed once its
    close time is before ``now_ms``, one value per run. A bad row carries an error
    instead of ending the run.
    """
    row, usual, good = F.col("row"), F.col("_usual"), F.col("error").isNull()
    reason = F.concat(F.lit("field "), "_bad", F.lit(" is missing or has a wrong value"))
    checked = (
        rows.withColumn("_usual", F.coalesce(F.to_json(row).rlike(_USUAL_ROW), F.lit(False)))
        .withColumn("_bad", F.when(~usual, F.coalesce(rarely(row, _first_bad), F.when(row.isNull(), "0"))))
        .withColumn("error", F.when(F.col("_bad").isNotNull(), reason))
    )
    keep = [c for c in rows.columns if c != "row"]
    event = F.when(usual, _event(row, now_ms, True)).when(good, rarely(row, lambda r: _event(r, now_ms, False)))
    others = [F.lit(None).cast(event_type(kind)).alias(kind) for kind in (AGG_TRADE, BOOK_TICKER)]
    decoded = F.struct(F.when(good, KLINE).alias("kind"), "error", *others, event.alias(KLINE))
    return checked.select(*keep, F.explode(F.array(decoded)).alias("_decoded")).select(*keep, "_decoded.*")
