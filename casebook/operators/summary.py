"""Daily summaries and trailing averages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW_DAYS = 7


def summarize(df: DataFrame, by: Sequence[Column | str], flags: Mapping[str, Column], total: str) -> DataFrame:
    """Row count and one conditional count per flag; a NULL flag counts as false."""
    counted = [F.count(F.lit(1)).alias(total)]
    return df.groupBy(*by).agg(*counted, *[F.count_if(is_set).alias(name) for name, is_set in flags.items()])


def rolling_avg_rows(
    df: DataFrame, value: str, by: Sequence[str], order: str, name: str, size: int = WINDOW_DAYS
) -> DataFrame:
    """Mean over the current and the previous ``size - 1`` rows. A NULL date sorts first and takes a place.

    Takes a table already summed to one row per group and day: a group has no more
    rows than there are days, however large the data behind it.
    """
    frame = Window.partitionBy(*by).orderBy(F.col(order).asc_nulls_first()).rowsBetween(1 - size, 0)
    return df.withColumn(name, F.avg(value).over(frame))


def rolling_avg_days(
    df: DataFrame, value: str, by: Sequence[str], order: str, name: str, size: int = WINDOW_DAYS
) -> DataFrame:
    """Mean over the rows of the current and the previous ``size - 1`` calendar days.

    Days without a row add nothing: they lower neither the sum nor the divisor.
    """
    frame = Window.partitionBy(*by).orderBy(F.unix_date(order)).rangeBetween(1 - size, 0)
    return df.withColumn(name, F.avg(value).over(frame))


def rolling_avg_days_between(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    order: str,
    name: str,
    first: Column,
    last: Column,
    size: int = WINDOW_DAYS,
) -> DataFrame:
    """``rolling_avg_days`` for the days from ``first`` to ``last`` only.

    A filter after the window cannot pass through it, so the range is widened by the
    frame, filtered at the scan, and trimmed afterwards.
    """
    day = F.col(order)
    widened = df.filter(day.between(F.date_sub(first, size - 1), last))
    return rolling_avg_days(widened, value, by, order, name, size).filter(day >= first)


def resum(summary: DataFrame, by: Sequence[Column | str], measures: Sequence[str]) -> DataFrame:
    """Additive measures summed to a coarser grain. Averages are not additive: take them anew."""
    return summary.groupBy(*by).agg(*[F.sum(m).alias(m) for m in measures])
