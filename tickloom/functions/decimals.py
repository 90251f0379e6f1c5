"""Exact decimals: text validation, lake rescale, text output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickloom.schemas import DECIMAL_PATTERN, LAKE_DECIMAL, MAX_DECIMAL

# Any text this short is inside the 96-bit range, so the cast can be skipped.
_ALWAYS_IN_RANGE = len(MAX_DECIMAL) - 1


def to_lake_decimal(text: Column | str) -> Column:
    """Decimal text to DECIMAL(38,8); extra digits round half up, bad text is NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(DECIMAL_PATTERN), text.try_cast(LAKE_DECIMAL))


def is_plain_decimal(text: Column) -> Column:
    """True for plain decimal notation within the in-flight decimal's range."""
    whole = F.abs(F.substring_index(text, ".", 1).try_cast(T.DecimalType(38, 0)))
    return text.rlike(DECIMAL_PATTERN) & (
        (F.length(text) <= _ALWAYS_IN_RANGE)
        | F.coalesce(whole <= F.lit(MAX_DECIMAL).cast(T.DecimalType(38, 0)), F.lit(False))
    )


def canonical_decimal_text(text: Column) -> Column:
    """Keep scale and digits; only drop redundant leading zeros."""
    return F.when(text.rlike("^-?0[0-9]"), F.regexp_replace(text, "^(-?)0+(?=[0-9])", "$1")).otherwise(text)


def decimals_to_text(df: DataFrame) -> DataFrame:
    """Every decimal column as exact plain text, other columns untouched.

    Apply after ``limit``: only returned rows pay for the cast.
    """
    decimals = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return df.select(*[F.col(c).cast("string").alias(c) if c in decimals else F.col(c) for c in df.columns])
