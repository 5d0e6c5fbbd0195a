"""Reports over the daily summary. All use additive measures only.

A summary has one row per day and type, so everything here runs on data whose size
follows the calendar and the type list, not the number of incidents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIODS = ("day", "week", "month", "year")


def period_start(unit: str, day: Column | str) -> Column:
    """First day of the period; weeks start on Monday."""
    return F.to_date(F.date_trunc(unit, day))


def narrow(
    summary: DataFrame, day: str, first: Column | None = None, last: Column | None = None, **wanted: Sequence
) -> DataFrame:
    """Rows of a date range and of the given values per column, as in ``primary_type=["THEFT"], year=[2024]``.

    Plain comparisons, which reach the scan: as pruned folders of a table laid out by
    year and month, and as filters on the stored statistics otherwise.
    """
    rows = summary
    if first is not None:
        rows = rows.filter(F.col(day) >= first)
    if last is not None:
        rows = rows.filter(F.col(day) <= last)
    for column, values in wanted.items():
        rows = rows.filter(F.col(column).isin(list(values)))
    return rows


def total_by_period(
    summary: DataFrame, day: str, measure: str, units: Sequence[str] = PERIODS, by: Sequence[str] = ()
) -> DataFrame:
    """Sum of the measure per period, for several period lengths in one pass."""
    periods = F.array(
        *[F.struct(F.lit(u).alias("period_unit"), period_start(u, F.col(day)).alias("period_start")) for u in units]
    )
    return (
        summary.select(*by, measure, F.inline(periods))
        .groupBy("period_unit", "period_start", *by)
        .agg(F.sum(measure).alias(measure))
    )


def trend(
    summary: DataFrame, day: str, measure: str, units: Sequence[str] = PERIODS, by: Sequence[str] = ()
) -> DataFrame:
    """Sum per period with the previous period that has rows, the change, and its direction."""
    totals = total_by_period(summary, day, measure, units, by)
    order = Window.partitionBy("period_unit", *by).orderBy(F.col("period_start").asc_nulls_first())
    change = F.col(measure) - F.col("previous")
    direction = (
        F.when(change > 0, "increasing").when(change < 0, "decreasing").when(change == 0, "unchanged")
    )
    return totals.withColumn("previous", F.lag(measure).over(order)).withColumns(
        {"change": change, "direction": direction}
    )


def total_by(summary: DataFrame, by: Sequence[str], measure: str) -> DataFrame:
    return summary.groupBy(*by).agg(F.sum(measure).alias(measure))


def top(summary: DataFrame, by: Sequence[str], measure: str, k: int = 10) -> DataFrame:
    """The ``k`` groups with the greatest sum; equal sums rank by name."""
    names = [F.col(c).asc_nulls_last() for c in by]
    return total_by(summary, by, measure).orderBy(F.col(measure).desc(), *names).limit(k)


def share(summary: DataFrame, by: Sequence[str], measure: str) -> DataFrame:
    """Sum per group and its part of the overall sum, which is computed once as a scalar."""
    everything = summary.agg(F.sum(measure)).scalar()
    return total_by(summary, by, measure).withColumn("share", F.col(measure) / everything)
