"""From raw strings to one typed row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions import safe_cast


def retype(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts columns in place; what does not fit becomes NULL."""
    return df.withColumns({name: safe_cast(name, type_) for name, type_ in types.items()})


def keep_valid_keys(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Column | str) -> DataFrame:
    """One row per key: the one with the greatest ``newest``, ties broken by all columns.

    The filter on the row number lets Spark keep one row per key in each task before
    the shuffle, so a key that holds much of the table arrives as one row per task.
    """
    latest = (F.col(newest) if isinstance(newest, str) else newest).desc_nulls_last()
    ties = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(latest, *ties))
    return df.withColumn("__position", position).filter(F.col("__position") == 1).drop("__position")


def attach_category(df: DataFrame, lookup: DataFrame, on: str, category: str, default: str = "Other") -> DataFrame:
    """Left join to a lookup with unique keys; exact match, everything else is ``default``.

    The lookup carries no hint: Spark broadcasts it if its known size is below the
    session's threshold and otherwise merge-joins, splitting skewed keys.
    """
    return df.join(lookup, on=on, how="left").withColumn(category, F.coalesce(category, F.lit(default)))
