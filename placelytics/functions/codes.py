"""Identifiers that arrive as text or numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: digits of a shop code.
SHOP_CODE_DIGITS = 3


def shop_code(df: DataFrame, column: str) -> Column:
    """Shop code padded with zeros to three digits; longer codes stay whole.

    Numeric columns go through an integer first, so shop 1.0 becomes ``001``.
    """
    code = F.col(column)
    if isinstance(df.schema[column].dataType, T.NumericType):
        code = code.cast("long")
    code = code.cast("string")
    return F.when(F.length(code) < SHOP_CODE_DIGITS, F.lpad(code, SHOP_CODE_DIGITS, "0")).otherwise(code)


def strict_int(column: str) -> Column:
    """Text to int; text that is no number fails the read instead of turning into null."""
    text = F.trim(F.col(column))
    number = text.try_cast("int")
    complaint = F.concat(F.lit(f"{column} is not a whole number: "), text)
    return F.when(text.isNotNull() & number.isNull(), F.raise_error(complaint).cast("int")).otherwise(number)
