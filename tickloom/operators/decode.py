"""Strict decode of raw frames and topic envelopes.

A text in the documented layout (fields in order, no blanks, no escapes) is
recognised by one pattern per kind, which already settles the type of every value;
``from_json`` then only has to split it. Any other text takes the general way, a
single ``from_json`` pass over the wrapper and its payload. A JSON parse that fills
typed columns is more forgiving than the contract in four ways, each closed there:

* STRING columns take JSON numbers: text fields are parsed as VARIANT and must
  hold a string.
* A missing field is NULL, not an error: every field is checked.
* Text after the first JSON value is ignored: the text is parsed inside ``[ ]``,
  where a tail is either a syntax error or a second element. A text holding
  ``]`` could close the bracket itself, so it is parsed once more inside an
  object, which that tail cannot close.
* Wire keys differ only by case: the parsed struct is renamed by position.

Known differences left open: of duplicate keys the last one wins, and a stream
name written with JSON escapes is accepted.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.decimals import canonical_decimal_text, to_lake_decimal
from tickloom.functions.strict_json import JSON_OPTIONS, PLAIN, USUAL, has_type, is_wrong, long_value, rarely
from tickloom.schemas import (
    AGG_TRADE, AGG_TRADE_SUFFIX, BOOK_TICKER, BOOK_TICKER_SUFFIX, BOOK_TICKERS, CONTROL, Field,
    KLINE, KLINE_EVENT_FIELDS, KLINE_FIELDS, KLINE_SUFFIX_PREFIX, KLINES, LakeTable, SCHEMA_VERSION,
    SHUTDOWN_STREAM, SNIPPET_LENGTH, TICKER_FIELDS, TRADE_FIELDS, TRADES,
)

_SQL_TYPES = {"text": "variant", "decimal": "variant", "long": "bigint", "boolean": "boolean"}


def _payload_columns() -> list[tuple[str, str, str]]:
    """(wire key, column, type) over all kinds; a key typed two ways is VARIANT."""
    columns: dict[str, tuple[str, str]] = {}
    for field in (*TRADE_FIELDS, *TICKER_FIELDS, *KLINE_EVENT_FIELDS):
        sql_type = _SQL_TYPES[field.kind]
        known = columns.get(field.wire)
        if known is None:
            columns[field.wire] = (f"f{len(columns)}", sql_type)
        elif known[1] != sql_type:
            columns[field.wire] = (known[0], "variant")
    return [(wire, name, sql_type) for wire, (name, sql_type) in columns.items()]


_PAYLOAD = _payload_columns()
_PAYLOAD_NAMES = {wire: (name, sql_type) for wire, name, sql_type in _PAYLOAD}


def _struct_type(named: list[tuple[str, str]]) -> str:
    return "struct<" + ",".join(f"{name}:{sql_type}" for name, sql_type in named) + ">"


def _payload_type(renamed: bool, texts_as: str = "variant") -> str:
    kline = _struct_type([(f.name if renamed else f.wire, _SQL_TYPES[f.kind]) for f in KLINE_FIELDS])
    own = [(name if renamed else wire, sql_type) for wire, name, sql_type in _PAYLOAD]
    return _struct_type([*own, ("kline" if renamed else "k", kline)]).replace(":variant", f":{texts_as}")


# An empty symbol would name no directory and no live row.
_NAMES = ("symbol", "event_symbol")


def _filled(field: Field, patterns: dict[str, str]) -> str:
    """The pattern of a field's text; a symbol is not empty."""
    return '(?!"")' + patterns[field.kind] if field.name in _NAMES else patterns[field.kind]


def _members(fields: tuple[Field, ...]) -> str:
    return ",".join(f'"{f.wire}":{_filled(f, PLAIN)}' for f in fields)


# Payload layouts; the members after the last one are documented as ignored.
_LAYOUTS = {
    AGG_TRADE: r"\{" + _members(TRADE_FIELDS) + r'(?:,"M":' + PLAIN["boolean"] + r")?\}",
    BOOK_TICKER: r"\{" + _members(TICKER_FIELDS) + r"\}",
    KLINE: r"\{" + _members(KLINE_EVENT_FIELDS) + r',"k":\{' + _members(KLINE_FIELDS)
    + r'(?:,"B":' + PLAIN["text"] + r")?\}\}",
}


def _in_layout(text: Column, wrapper: dict[str, str]) -> Column:
    """Kind of a text in the documented layout; NULL for any other text.

    ``wrapper`` is the pattern of what precedes each kind's payload.
    """
    chain = F
    for kind, layout in _LAYOUTS.items():
        chain = chain.when(text.rlike("^" + wrapper[kind] + layout + r"\}\z"), kind)
    return chain


def _parse_wrapped(
    df: DataFrame, text: Column, head: list[tuple[str, str]], payload_key: str, wrapper: dict[str, str]
) -> DataFrame:
    """Add ``_layout`` and ``plain`` for texts in the documented layout, and ``parsed``
    for the others: the wrapper as a struct of ``head`` and ``payload``, or NULL."""
    df = df.withColumn("_layout", F.when(F.is_valid_utf8(text), _in_layout(text, wrapper)))
    plain = F.from_json(
        F.when(F.col("_layout").isNotNull(), text),
        f"struct<{payload_key}:{_payload_type(renamed=False, texts_as='string')}>",
    ).cast(f"struct<payload:{_payload_type(renamed=True, texts_as='string')}>")
    text = F.when(F.col("_layout").isNull(), text)
    wire = _struct_type([*head, (payload_key, _payload_type(renamed=False))])
    renamed = _struct_type([*head, ("payload", _payload_type(renamed=True))])
    whole = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{wire}>", JSON_OPTIONS)
    nested = F.from_json(
        F.concat(F.lit('{"w":'), text, F.lit("}")), f"w struct<{head[0][0]}:{head[0][1]}>", JSON_OPTIONS
    )
    single = (F.size("_whole") == 1) & (~F.contains(text, F.lit("]")) | nested["w"].isNotNull())
    # The plain layout cannot hold a key twice; any other text is asked.
    single = single & F.try_parse_json(text).isNotNull()
    return (
        df.withColumns({"plain": plain["payload"], "_whole": whole.cast(f"array<{renamed}>")})
        .withColumn("parsed", F.when(single, F.col("_whole")[0]))
        .drop("_whole")
    )


def _raw(field: Field, payload: Column) -> tuple[Column, str]:
    """Parsed column and its type; kline fields sit in the nested struct."""
    if field.in_candle:
        return payload["kline"][field.name], _SQL_TYPES[field.kind]
    name, sql_type = _PAYLOAD_NAMES[field.wire]
    return payload[name], sql_type


def _is_bad(field: Field, payload: Column) -> Column:
    value, sql_type = _raw(field, payload)
    bad = is_wrong(value, field.kind) if sql_type == "variant" else value.isNull()
    return bad | (value.cast("string") == "") if field.name in _NAMES else bad


def _first_bad(fields: tuple[Field, ...], payload: Column) -> Column:
    return F.coalesce(*[F.when(_is_bad(f, payload), f.wire) for f in fields])


def _values(fields: tuple[Field, ...], payload: Column, canonical: bool) -> Column:
    columns = []
    for field in fields:
        value, sql_type = _raw(field, payload)
        if field.kind in ("text", "decimal"):
            value = value.cast("string")
            if field.kind == "decimal" and not canonical:
                value = canonical_decimal_text(value)
        elif sql_type == "variant":
            value = long_value(value)
        columns.append(value.alias(field.name))
    return F.struct(*columns)


def _is_usual(fields: tuple[Field, ...], payload: Column) -> Column:
    variants, pattern, typed = [], [], []
    for field in fields:
        value, sql_type = _raw(field, payload)
        if sql_type == "variant":
            key = f"v{len(variants)}"
            variants.append(value.alias(key))
            pattern.append(f'"{key}":{_filled(field, USUAL)}')
        else:
            typed.append(value.isNotNull() & (value.cast("string") != "") if field.name in _NAMES else value.isNotNull())
    matches = F.to_json(F.struct(*variants)).rlike("^\\{" + ",".join(pattern) + "\\}$")
    return reduce(lambda left, right: left & right, typed, F.coalesce(matches, F.lit(False)))


_FIELDS = {AGG_TRADE: TRADE_FIELDS, BOOK_TICKER: TICKER_FIELDS, KLINE: (*KLINE_EVENT_FIELDS, *KLINE_FIELDS)}


def _by_kind(expression, kinds=_FIELDS) -> Column:
    """CASE over the routed kind."""
    chain = F
    for kind in kinds:
        chain = chain.when(F.col("_kind") == kind, expression(kind))
    return chain


def _plain_values(fields: tuple[Field, ...]) -> Column:
    """Event of a text in the documented layout; only a shared key needs a cast."""
    columns = []
    for field in fields:
        value, sql_type = _raw(field, F.col("plain"))
        is_shared = sql_type == "variant" and field.kind == "long"
        columns.append((value.cast("bigint") if is_shared else value).alias(field.name))
    return F.struct(*columns)


# The columns below name no DataFrame, so they are built once: each is hundreds of
# expressions, and building them takes longer than planning them.

@lru_cache
def _usual_column() -> Column:
    payload = F.col("parsed.payload")
    return F.when(F.col("_wrapper_error").isNull(), _by_kind(lambda k: _is_usual(_FIELDS[k], payload)))


@lru_cache
def _bad_column() -> Column:
    payload = F.col("parsed.payload")
    return F.when(~F.col("_usual"), _by_kind(lambda k: rarely(payload, lambda p: _first_bad(_FIELDS[k], p))))


@lru_cache
def _event_column(name: str) -> Column:
    payload, is_kind, fields = F.col("parsed.payload"), F.col("kind") == name, _FIELDS[name]
    return (
        F.when(F.col("_layout") == name, _plain_values(fields))
        .when(is_kind & F.col("_usual"), _values(fields, payload, canonical=True))
        .when(is_kind, rarely(payload, lambda p: _values(fields, p, canonical=False)))
        .alias(name)
    )


def _with_payload(df: DataFrame, kind: Column, wrapper_error: Column, prefix: dict[str, str]) -> DataFrame:
    """Check the payload of each kind and add one struct column per kind.

    The explode over one element keeps filters on the result from being pushed
    below it, where each would parse the text once more.
    """
    checked = (
        df.withColumn("_kind", kind)
        .withColumn("_wrapper_error", wrapper_error)
        .withColumn("_usual", _usual_column())
        .withColumn("_bad", _bad_column())
        .withColumn(
            "error",
            F.coalesce(
                F.col("_wrapper_error"),
                F.when(F.col("_bad").isNotNull(), F.concat(
                    _by_kind(lambda k: F.lit(prefix[k])),
                    F.lit("field `"), F.col("_bad"), F.lit("` is missing or has a wrong value"),
                )),
            ),
        )
        .withColumn("kind", F.coalesce(F.col("_layout"), F.when(F.col("error").isNull(), F.col("_kind"))))
    )
    keep = [c for c in df.columns if c not in ("parsed", "plain") and not c.startswith("_")]
    decoded = F.struct("kind", "error", *map(_event_column, _FIELDS))
    return checked.select(*keep, F.explode(F.array(decoded)).alias("_decoded")).select(*keep, "_decoded.*")


def decode_frames(frames: DataFrame, text: str = "value") -> DataFrame:
    """Decode combined-stream frames, keeping every input column.

    Adds ``kind`` (agg_trade, book_ticker, kline, control; NULL when undecodable),
    ``error`` (NULL when decodable) and one struct column per event kind.
    """
    value = F.col(text).cast("string")
    suffixes = {AGG_TRADE: AGG_TRADE_SUFFIX, BOOK_TICKER: BOOK_TICKER_SUFFIX, KLINE: KLINE_SUFFIX_PREFIX + r'[^"\\\x00-\x1f]*+'}
    wrapper = {k: r'\{"stream":"[^"\\@\x00-\x1f]*+@' + suffix + '","data":' for k, suffix in suffixes.items()}
    parsed = _parse_wrapped(frames, value, [("stream", "variant")], "data", wrapper)
    stream = F.when(has_type(F.col("parsed.stream"), "STRING"), F.col("parsed.stream").cast("string"))
    parsed = parsed.withColumn("_stream", stream)
    stream = F.col("_stream")
    at = F.instr(stream, "@")
    suffix = F.when(at > 0, F.substr(stream, at + 1, F.length(stream)))
    kind = (
        F.when(stream == SHUTDOWN_STREAM, CONTROL)
        .when(suffix == AGG_TRADE_SUFFIX, AGG_TRADE)
        .when(suffix == BOOK_TICKER_SUFFIX, BOOK_TICKER)
        .when(suffix.startswith(KLINE_SUFFIX_PREFIX), KLINE)
    )
    # A NULL payload may still be present; only then the keys are looked at.
    has_data = F.col("parsed.payload").isNotNull() | F.coalesce(
        F.array_contains(F.json_object_keys(value), "data"), F.lit(False)
    )
    wrapper_error = (
        F.when(F.col("_layout").isNotNull(), F.lit(None).cast("string"))
        .when(stream.isNull() | ~has_data, F.lit("malformed text"))
        .when(F.col("_kind").isNull(), F.concat(F.lit("no route for stream `"), stream, F.lit("`")))
    )
    prefix = dict.fromkeys(_FIELDS, "malformed text: ")
    return _with_payload(parsed, kind, wrapper_error, prefix)


def decode_envelopes(records: DataFrame, strict_version: bool = False) -> DataFrame:
    """Decode topic records by the envelope's ``event_type``, whatever their topic.

    Records without a value are skipped, not dead-lettered. ``strict_version``
    rejects envelopes of another schema version; by default it is not looked at.
    """
    value = F.col("value").cast("string")
    present = records.filter(F.col("value").isNotNull())
    version = str(SCHEMA_VERSION) if strict_version else "[1-9][0-9]{0,8}"
    wrapper = {k: rf'\{{"event_type":"{k}","schema_version":{version},"payload":' for k in _FIELDS}
    head = [("event_type", "variant"), ("schema_version", "variant")]
    parsed = _parse_wrapped(present, value, head, "payload", wrapper)
    event_type = F.when(has_type(F.col("parsed.event_type"), "STRING"), F.col("parsed.event_type").cast("string"))
    parsed = parsed.withColumn("_event_type", event_type)
    event_type = F.col("_event_type")
    has_payload = F.col("parsed.payload").isNotNull() | F.coalesce(
        F.array_contains(F.json_object_keys(value), "payload"), F.lit(False)
    )
    wrapper_error = F.when(F.col("_layout").isNotNull(), F.lit(None).cast("string")).when(
        event_type.isNull() | ~has_payload | ~F.is_valid_utf8(value), F.lit("not an envelope")
    ).when(
        ~event_type.isin(AGG_TRADE, BOOK_TICKER, KLINE), F.concat(F.lit("no such event type: `"), event_type, F.lit("`"))
    )
    if strict_version:
        version = F.col("parsed.schema_version")
        known = F.coalesce(version.cast("string") == str(SCHEMA_VERSION), F.lit(False))
        wrapper_error = wrapper_error.when(
            ~known, F.concat(F.lit("other schema version: "), F.coalesce(version.cast("string"), F.lit("null")))
        )
    prefix = {
        AGG_TRADE: "bad trade: ",
        BOOK_TICKER: "bad ticker: ",
        KLINE: "bad candle: ",
    }
    return _with_payload(parsed, event_type, wrapper_error, prefix)


def for_sinks(decoded: DataFrame) -> DataFrame:
    """What the sinks of a batch need of its decoded topic records: key and text of those to be parked alone."""
    parked = F.col("error").isNotNull()
    texts = [F.when(parked, F.col(c)).alias(c) for c in ("key", "value")]
    return decoded.select(*texts, "topic", "partition", "offset", "kind", "error", *_FIELDS)


def event_type(kind: str) -> str:
    """SQL type of the struct column of a kind."""
    types = {"long": "bigint", "boolean": "boolean"}
    return "struct<" + ",".join(f"{f.name}:{types.get(f.kind, 'string')}" for f in _FIELDS[kind]) + ">"


def bad_rows(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("error").isNotNull())


def with_snippet(decoded: DataFrame, text: str = "value") -> DataFrame:
    """Leading bytes of the text, without a character cut in two; the text stays beside it."""
    raw = F.col(text).cast("binary")
    cuts = [F.try_validate_utf8(F.substring(raw, 1, SNIPPET_LENGTH - n).cast("string")) for n in range(4)]
    return decoded.withColumn("snippet", F.coalesce(*cuts, F.make_valid_utf8(F.substring(raw, 1, SNIPPET_LENGTH).cast("string"))))


def events_of(decoded: DataFrame, kind: str, *keep: str) -> DataFrame:
    """Flat typed rows of one kind (decimals still text), plus ``keep`` columns."""
    return decoded.filter(F.col("kind") == kind).select(*keep, F.col(f"{kind}.*"))


def lake_rows(decoded: DataFrame, table: LakeTable) -> DataFrame:
    """Rows of one lake table from decoded topic records, with lineage columns."""
    source = F.col(table.kind)
    columns = []
    for field in table.schema.fields:
        if field.name == "kafka_partition":
            column = F.col("partition")
        elif field.name == "kafka_offset":
            column = F.col("offset")
        elif field.dataType.typeName() == "decimal":
            column = to_lake_decimal(source[field.name])
        else:
            column = source[field.name]
        columns.append(column.alias(field.name))
    return decoded.filter(F.col("kind") == table.kind).select(*columns)


__all__ = [
    "AGG_TRADE", "BOOK_TICKER", "KLINE", "TRADES", "BOOK_TICKERS", "KLINES", "bad_rows", "decode_envelopes",
    "decode_frames", "events_of", "for_sinks", "lake_rows", "with_snippet",
]
