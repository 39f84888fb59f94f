"""Text to typed columns; text outside the accepted form becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymart import schemas as S
from tallymart.functions.clock import zoned


def na_to_null(col: Column) -> Column:
    return F.when(~col.isin(S.NA_TOKENS), col)


def matches(col: Column, pattern: str) -> Column:
    return F.coalesce(col.rlike(pattern), F.lit(False))


def guarded(col: Column, pattern: str, type_name: str) -> Column:
    return F.when(col.rlike(pattern), col.try_cast(type_name))


def to_int(col: Column) -> Column:
    """Optional blanks and sign around digits, which is all ``try_cast`` takes for an INT."""
    return col.try_cast("int")


def to_count(col: Column) -> Column:
    """Digits only: no sign, blank or fraction."""
    return guarded(col, S.DIGITS_PATTERN, "int")


def to_price(col: Column) -> Column:
    """Non-negative decimal, rounded half up to cents."""
    return guarded(col, S.PRICE_PATTERN, "decimal(10,2)")


def to_date(col: Column) -> Column:
    return guarded(col, S.DATE_PATTERN, "date")


def to_timestamp(col: Column) -> Column:
    """UTC unless the text names a zone."""
    return F.when(col.rlike(S.TIMESTAMP_PATTERN), zoned(col).try_cast("timestamp"))
