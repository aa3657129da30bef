"""String-stored columns to typed columns: null markers and safe casts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for a missing number in landed string tables.
NULL_MARKERS = ("nan",)

# The expressions here stay short on purpose: a wide table repeats them per column, and
# the JVM leaves a generated method above 8000 bytes of code uncompiled.
# Year-month-day with optional time. Bare years, bare hours and padded text are not
# timestamps here although Spark's cast would take them.
_NUMBER_SUFFIX = r"[0-9.][dDfF]\s*$"
_TIMESTAMP_SHAPE = r"^\d+([-/])\d+\1\d+(?:[ T]\d+:\d+.*)?$"


def null_if_marker(text: Column, markers: Sequence[str] = NULL_MARKERS) -> Column:
    return F.when(~text.isin(*markers), text)


def not_marker(text: Column, markers: Sequence[str] = NULL_MARKERS) -> Column:
    """Filter predicate; like ``<>`` it is also not true for a null."""
    return ~text.isin(*markers)


def _unmarked(text: Column) -> Column:
    """Without markers, of which a cast to a number only finds out by an exception; numbers may be typed already."""
    return F.when(~text.cast("string").isin(*NULL_MARKERS), text)


def try_double(text: Column) -> Column:
    """Text to double, null when it is no number. NaN and infinities are kept.

    Java's number suffixes (``1d``, ``2.5f``) are refused.
    """
    return F.when(~text.rlike(_NUMBER_SUFFIX), text).try_cast("double")


def drop_nan(number: Column) -> Column:
    return F.nullif(number, F.lit(float("nan")))


def clean_double(text: Column) -> Column:
    """Text to double with both bad text and NaN turned into null."""
    return drop_nan(try_double(_unmarked(text)))


def strict_double(text: Column) -> Column:
    """Text to double, NaN to null; under ANSI bad text fails the job."""
    return drop_nan(_unmarked(text).cast("double"))


def round_to_int(number: Column) -> Column:
    """Double to int, halves to the even neighbour; NaN and overflow become null."""
    return F.rint(number).try_cast("int")


def try_int(text: Column) -> Column:
    """Text that may be written as a float (``'4021.0'``) to int."""
    return round_to_int(try_double(text))


def try_long(text: Column) -> Column:
    """As ``try_int``, to a 64-bit integer; text without a fraction keeps all its digits."""
    return F.coalesce(text.try_cast("bigint"), F.rint(try_double(text)).try_cast("bigint"))


def try_timestamp(text: Column) -> Column:
    """Text to a zone-less timestamp, null when it is none."""
    return F.when(text.rlike(_TIMESTAMP_SHAPE), F.replace(text, F.lit("/"), F.lit("-"))).try_cast("timestamp_ntz")


def positive_flag(number: Column) -> Column:
    """True only for a number above zero; null and NaN give false."""
    return F.coalesce((number > 0) & ~F.isnan(number), F.lit(False))


def positive_flag_nan_high(number: Column) -> Column:
    """As ``positive_flag`` but NaN sorts above every number, so it counts as positive."""
    return F.coalesce(number > 0, F.lit(False))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null on a zero or null denominator."""
    return numerator / F.nullif(denominator, F.lit(0))
