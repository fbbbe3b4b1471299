"""Small value conversions: seconds, milliseconds, numbers in text, paths."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# What counts as a number in an annotation's time code.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_EXPONENT = rf"(?:[eE][+-]?{_DIGITS})?"
NUMBER = (
    rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?{_EXPONENT}"
    rf"|\.{_DIGITS}{_EXPONENT}|(?i:inf|infinity))$"
)
# -----------------------------------------------------------------------------


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed a single time per row. An expression
    named inside a lambda is otherwise computed again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def div(value: Column, by: int) -> Column:
    """Whole-number division, exact for all 64-bit values."""
    return F.call_function("div", value.cast("bigint"), F.lit(by).cast("bigint"))


def parse_seconds(text: Column) -> Column:
    """Seconds from text, null where the text is not a number. Accepts what a
    time code may hold: padding, exponents, digit grouping, infinities."""
    stripped = F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))
    return F.when(
        stripped.rlike(NUMBER), F.translate(stripped, "_", "").try_cast("double")
    )


def format_seconds(seconds: Column, digits: int) -> Column:
    """Fixed-point text, correctly rounded (ties of the binary value to even).

    The JVM's formatters round the shortest decimal form of a double instead,
    which differs at apparent ties. Here the value is compared exactly with the
    middle between its two neighbours: both halves of the split double times
    ``2 * 10 ** digits`` are exact.
    """
    unit = 10**digits
    size = F.abs(seconds)
    below = F.floor(size * unit).cast("bigint")
    large = size * 134_217_729.0
    high = large - (large - size)
    middle = (2 * below + 1).cast("double")
    beyond = (high * (2.0 * unit) - middle) + (size - high) * (2.0 * unit)
    up = (beyond > 0) | ((beyond == 0) & (F.pmod(below, F.lit(2)) == 1))
    whole = below + up.cast("bigint")
    return F.concat(
        F.when(seconds < 0, "-").otherwise(""),
        div(whole, unit).cast("string"),
        F.lit("."),
        F.lpad(F.pmod(whole, F.lit(unit)).cast("string"), digits, "0"),
    )


def to_millis(seconds: Column) -> Column:
    """Whole milliseconds, half to even."""
    return F.rint(seconds * 1000).cast("bigint")


def numbered(pattern: str, *columns: Column) -> Column:
    """printf-style names. Numbers wider than the pattern keep all digits."""
    return F.format_string(pattern, *columns)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """File name without its last suffix; a leading dot is no suffix."""
    return F.regexp_extract(file_name(path), r"^(.+?)(\.[^.]+)?$", 1)


def suffix(path: Column) -> Column:
    return F.regexp_extract(file_name(path), r"^(.+?)(\.[^.]+)?$", 2)


def parent(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
