"""Text tests and tokens."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what a path-safe token may not contain.
UNSAFE_IN_PATH = "[^A-Za-z0-9_.=-]"


def as_text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def blank(value: Column | str) -> Column:
    """NULL, empty or spaces only. Tabs and other white space count as content."""
    text = as_text(value)
    return F.coalesce(F.trim(text) == "", F.lit(True))


def present(value: Column | str) -> Column:
    return ~blank(value)


def column_or_null(df: DataFrame, name: str, type_: str = "string") -> Column:
    """The named column, or a typed NULL when the input has no column of exactly that name."""
    return F.col(name).cast(type_) if name in df.columns else F.lit(None).cast(type_)


def path_token(value: Column | str) -> Column:
    return F.regexp_replace(as_text(value), UNSAFE_IN_PATH, "_")


def path_token_text(value: str) -> str:
    """Same token for one driver-side value, such as a run id in a folder name."""
    return re.sub(UNSAFE_IN_PATH, "_", value)
