"""Strict typing on top of a forgiving JSON parse.

Values that must keep their JSON type are parsed as VARIANT. The usual value is
settled by one pattern over the JSON text of all of them; whatever does not match
is looked at field by field.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from tickloom.functions.decimals import is_plain_decimal

JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

# Usual JSON text per kind: decimals plain, canonical and in range, longs in range.
USUAL = {
    "text": r'"[^"\\]*+(?:\\.[^"\\]*+)*+"',
    "decimal": r'"-?(?:0|[1-9][0-9]{0,27})(?:\.[0-9]{1,28})?"',
    "long": r"-?[0-9]{1,18}",
}

# The same inside a raw text in the documented layout: no escapes, no blanks.
PLAIN = {
    "text": r'"[^"\\\x00-\x1f]*+"',
    "decimal": USUAL["decimal"],
    "long": r"-?(?:0|[1-9][0-9]{0,17})",
    "boolean": "(?:true|false)",
}


def has_type(value: Column, name: str) -> Column:
    return F.coalesce(F.schema_of_variant(value) == name, F.lit(False))


def is_wrong(value: Column, kind: str) -> Column:
    """Whether a VARIANT is missing, of another JSON type, or no plain decimal."""
    if kind == "long":
        return ~has_type(value, "BIGINT")
    if kind == "text":
        return ~has_type(value, "STRING")
    return ~(has_type(value, "STRING") & F.coalesce(is_plain_decimal(value.cast("string")), F.lit(False)))


def long_value(value: Column) -> Column:
    return F.try_variant_get(value, "$", "bigint")


def rarely(argument: Column, expression: Callable[[Column], Column]) -> Column:
    """Evaluate ``expression`` inside a lambda, keeping it out of the compiled row loop."""
    return F.get(F.transform(F.array(argument), expression), 0)
