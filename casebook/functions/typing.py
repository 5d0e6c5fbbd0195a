"""Safe typing of text columns: a value that does not fit becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.functions.text import as_text, present

# The two written forms of a source timestamp.
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS"
SPACED_SECONDS = "yyyy-MM-dd HH:mm:ss"


def safe_cast(value: Column | str, type_: str) -> Column:
    return as_text(value).try_cast(type_)


def uncastable(value: Column | str, type_: str) -> Column:
    """Has content, but the content is not of the type."""
    return present(value) & safe_cast(value, type_).isNull()


def outside(value: Column | str, low: float, high: float) -> Column:
    """Has content, but is no number inside the closed range. NaN is outside."""
    number = safe_cast(value, "double")
    return present(value) & ~F.coalesce(number.between(low, high), F.lit(False))


def flag(value: Column | str) -> Column:
    """Text flag as a boolean that is never NULL; unreadable text counts as false."""
    return F.coalesce(safe_cast(value, "boolean"), F.lit(False))


def parse_timestamp(value: Column | str, pattern: str = ISO_MILLIS) -> Column:
    """One exact pattern; like Spark's formatter, it takes letters in either case.

    A failed match costs a Java exception per row, so text without the pattern's
    own date/time divider is turned away before the formatter sees it.
    """
    text = as_text(value)
    parsed = F.try_to_timestamp(text, F.lit(pattern))
    if "'T'" in pattern:
        return F.when(text.contains("T") | text.contains("t"), parsed)
    if " " in pattern:
        return F.when(text.contains(" "), parsed)
    return parsed


def parse_timestamp_any(value: Column | str, free_form: bool = True) -> Column:
    """First readable form of ISO with milliseconds, spaced seconds and free form.

    The free-form reader accepts every value of the two patterns with the same
    result, and does so without exceptions. It therefore goes first; the patterns
    only see what it could not read. ``free_form=False`` keeps to the two patterns.
    """
    text = as_text(value)
    written = [parse_timestamp(text, ISO_MILLIS), parse_timestamp(text, SPACED_SECONDS)]
    if not free_form:
        return F.coalesce(*written)
    return F.coalesce(F.try_to_timestamp(text), *written)
