"""String rules shared by sources and loaders. All of them run in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a feed may pad a value with (Unicode white space
# plus the four ASCII separators). `trim` alone removes only U+0020.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def stripped(c: Column | str) -> Column:
    """Trimmed value, NULL when nothing is left."""
    return blank_to_null(strip(c))


def or_default(c: Column | str, default: str) -> Column:
    """The value, or `default` where it is NULL or empty (blanks count as values)."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def cut(c: Column | str, width: int) -> Column:
    return F.substring(col(c), 1, width)


def is_digits(c: Column | str) -> Column:
    return F.coalesce(col(c).rlike("^[0-9]+$"), F.lit(False))


def join_present(parts: list[Column], separator: str = " ") -> Column:
    """Concatenate the non-empty parts; '' when there are none."""
    return F.concat_ws(separator, *[blank_to_null(p) for p in parts])


def recode(c: Column, codes: dict[str, str]) -> Column:
    """Replace listed values, keep the others."""
    chain = reduce(
        lambda acc, item: acc.when(c == item[0], F.lit(item[1])),
        codes.items(),
        F,
    )
    return chain.otherwise(c)
