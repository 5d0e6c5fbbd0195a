"""Parts of dates and times of day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First hour of each bucket, in the order of the day.
DAYPARTS = (("night", 0), ("morning", 6), ("afternoon", 12), ("evening", 18))


def date_parts(day: Column) -> dict[str, Column]:
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "weekday": F.date_format(day, "EEEE"),
    }


def daypart(hour: Column) -> Column:
    label = F.lit(None).cast("string")
    for name, first in DAYPARTS:
        label = F.when(hour >= first, F.lit(name)).otherwise(label)
    return label


def time_parts(moment: Column) -> dict[str, Column]:
    return {"hour": F.hour(moment), "minute": F.minute(moment)}
