"""Typed values out of staging strings.

ANSI mode makes a plain cast fail the whole job, so every parser is a `try_`
form: blank gives NULL, and so does text that cannot be read. `unreadable` tells
the two apart, which is what the loaders send to the reject table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.text import col, is_digits, strip, stripped

# Spellings of "true".
TRUE_WORDS = ("1", "true", "yes", "t")

ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?([+-]\d{2}:?\d{2}(:?\d{2})?|Z)?)?$"
PLAIN_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
BARE_HOUR = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2})(?=[+-]|Z|$)"


def parse_date(c: Column | str) -> Column:
    head = F.substring(strip(c), 1, 10)
    return F.when(head.rlike(ISO_DATE), head.try_cast("date"))


def parse_timestamp(c: Column | str) -> Column:
    """ISO 8601 instant; a value without an offset is UTC (the session zone)."""
    text = strip(c)
    minute = F.regexp_replace(text, BARE_HOUR, "$1:00")
    return F.when(text.rlike(ISO_TIMESTAMP), minute.try_cast("timestamp"))


def local_date(c: Column | str) -> Column:
    """The calendar day in the offset the source wrote, not in UTC."""
    return parse_date(c)


def utc_date(ts: Column | str) -> Column:
    return F.to_date(col(ts))


def decimal_text(c: Column | str) -> Column:
    return strip(F.replace(col(c), F.lit(","), F.lit(".")))


def parse_decimal(c: Column | str, precision: int, scale: int) -> Column:
    return decimal_text(c).try_cast(f"decimal({precision},{scale})")


def parse_number(c: Column | str) -> Column:
    """Finite double of any length; 'NaN', 'inf' and suffixed literals do not count as numbers."""
    text = decimal_text(c)
    value = text.try_cast("double")
    return F.when(text.rlike(PLAIN_NUMBER) & (F.abs(value) < float("inf")), value)


def number_text(value: Column) -> Column:
    """Plain decimal notation of a double, at least one digit after the point."""
    plain = value.cast("string").try_cast("decimal(38,18)").cast("string")
    return F.coalesce(
        F.regexp_replace(plain, r"(\.\d+?)0*$", "$1"), value.cast("string")
    )


def parse_bool(c: Column | str) -> Column:
    value = col(c)
    return F.when(value.isNotNull() & (value != ""), F.lower(value).isin(*TRUE_WORDS))


def parse_unsigned(c: Column | str, kind: str = "int") -> Column:
    text = strip(c)
    return F.when(is_digits(text), text.try_cast(kind))


def parse_signed(c: Column | str, kind: str = "int") -> Column:
    text = strip(c)
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast(kind))


def unreadable(raw: Column | str, parsed: Column) -> Column:
    """True where the source held something but the parser could not read it."""
    return stripped(raw).isNotNull() & parsed.isNull()
