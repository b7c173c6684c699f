"""Text-to-number and epoch conversions that never raise and never yield NaN."""

from collections.abc import Callable

from pyspark.sql import Column, functions as F

WHITESPACE = " \t\n\r\x0b\x0c"


def as_col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` mentions it."""
    return F.transform(F.array(value), body)[0]


def strip(value: str | Column) -> Column:
    """Trim every ASCII white-space character, not only blanks."""
    return F.trim(as_col(value).cast("string"), F.lit(WHITESPACE))


def number_or_null(value: str | Column) -> Column:
    """Double, with unparsable text and NaN both as NULL."""
    number = as_col(value).try_cast("double")
    return F.when(~F.isnan(number), number)


def number_or_zero(value: str | Column) -> Column:
    return F.coalesce(number_or_null(value), F.lit(0.0))


def whole_or_null(value: str | Column, dtype: str = "int") -> Column:
    """Whole number by truncation; '5.0' is 5."""
    return number_or_null(value).try_cast(dtype)


def whole_or_zero(value: str | Column, dtype: str = "int") -> Column:
    return F.coalesce(whole_or_null(value, dtype), F.lit(0).cast(dtype))


def epoch_to_timestamp(value: str | Column) -> Column:
    """Fractional epoch seconds to TIMESTAMP with microsecond precision; bad input is NULL."""
    return F.timestamp_micros(F.rint(number_or_null(value) * 1000000).try_cast("bigint"))


def text_or(value: str | Column, fill: str) -> Column:
    return F.coalesce(as_col(value).cast("string"), F.lit(fill))
