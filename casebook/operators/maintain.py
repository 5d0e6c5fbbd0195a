"""Summaries and dimensions kept up by what has changed.

Counts are additive: a change takes its old version out and puts its new one in. Trailing averages are not; they are
taken anew for the groups that changed, over rows that are already sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.operators import summary

MOST_WORDS = 2_000_000  # words of 64 ids that are broadcast: some 32 MB


def outcome_of(changes: DataFrame, base: DataFrame, key: str, newest: str, ignored: Sequence[str] = ()) -> DataFrame:
    """Per change ``key, outcome, old, new``: what it does to the base, with both versions as structs.

    ``inserted``: the base lacks the key. ``updated``: the change is newer, or as old and not the same; it replaces the
    base's row. ``repeated``: it is the base's row once more, but for the ``ignored`` columns. ``stale``: the base is
    newer. Only the first two change a table. Both sides hold each key once. Only rows of ``base`` whose key
    is among the changes take part.
    """
    columns = base.columns
    compared = [c for c in columns if c not in ignored]
    new = changes.select(F.col(key), F.struct(*columns).alias("new"))
    old = base.select(F.col(key), F.struct(*columns).alias("old"))
    both = new.join(old, key, "left")
    same = F.struct(*[F.col(f"old.{c}") for c in compared]).eqNullSafe(F.struct(*[F.col(f"new.{c}") for c in compared]))
    newer = F.col(f"old.{newest}").isNull() | F.coalesce(F.col(f"new.{newest}") >= F.col(f"old.{newest}"), F.lit(False))
    outcome = F.when(F.col("old").isNull(), "inserted").when(same, "repeated").when(newer, "updated").otherwise("stale")
    return both.select(key, outcome.alias("outcome"), "old", "new")


def summary_delta(added: DataFrame, removed: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """What two summaries of the same form, of new and of superseded rows, change. Sums that cancel out are left out."""
    negative = removed.select(*by, *[(-F.col(m)).alias(m) for m in measures])
    delta = summary.resum(added.select(*by, *measures).unionByName(negative), by, measures)
    unchanged = F.lit(True)
    for m in measures:
        unchanged &= F.col(m) == 0
    return delta.where(~unchanged)


def updated_groups(
    stored: DataFrame, delta: DataFrame, by: Sequence[str], measures: Sequence[str], kind: str, order: str, average: str
) -> DataFrame:
    """All rows of the ``kind`` groups that ``delta`` touches, with the delta applied and their averages taken anew.

    ``changed`` marks rows that differ from the stored ones: those of the delta, and the rows after them whose
    frame has other rows now. A row whose count has fallen to zero is gone. ``measures[0]`` is the count that averages are of.
    """
    kinds = delta.select(F.col(kind).alias("__kind")).distinct()
    mine = stored.join(kinds, F.col(kind).eqNullSafe(F.col("__kind")), "left_semi")
    old = mine.select(*by, *measures, F.col(average).alias("__was"), F.lit(False).alias("changed"))
    new = delta.select(*by, *measures, F.lit(None).cast("double").alias("__was"), F.lit(True).alias("changed"))
    merged = old.unionByName(new).groupBy(*by).agg(
        *[F.sum(m).alias(m) for m in measures], F.max("__was").alias("__was"), F.max("changed").alias("changed")
    )
    rolled = summary.rolling_avg_rows(merged.where(F.col(measures[0]) != 0), measures[0], [kind], order, average)
    differs = ~F.col(average).eqNullSafe(F.col("__was"))
    return rolled.select(*by, *measures, average, (F.col("changed") | differs).alias("changed"))


def other_groups(stored: DataFrame, delta: DataFrame, kind: str) -> DataFrame:
    """The rows of ``stored`` whose group the delta does not touch."""
    kinds = delta.select(F.col(kind).alias("__kind")).distinct()
    return stored.join(kinds, F.col(kind).eqNullSafe(F.col("__kind")), "left_anti")


def new_members(members: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """The members that the stored dimension lacks."""
    return members.join(stored.select(key), key, "left_anti").select(*members.columns)


def in_range(df: DataFrame, key: str, low, high) -> DataFrame:
    """Rows with keys in a range that the scan can use to skip files and row groups."""
    return df.where(F.col(key).between(low, high)) if low is not None else df.limit(0)


def id_words(ids: DataFrame, key: str) -> DataFrame:
    """BIGINT ids as words of 64 bits: a row for each 64 neighbours of which some are there, and never more rows than ids."""
    return ids.groupBy(F.shiftright(key, 6).alias("word")).agg(F.bit_or(_bit_of(key)).alias("bits"))


def chosen(df: DataFrame, key: str, words: DataFrame, among: bool) -> DataFrame:
    """The rows whose key is among the ids of ``words``, or those whose key is not. The words are broadcast: no row is shuffled.

    A NULL key is not among them.
    """
    at = df.select("*", F.shiftright(key, 6).alias("__word"))
    both = at.join(F.broadcast(words.select(F.col("word").alias("__word"), "bits")), "__word", "left")
    held = F.coalesce(F.col("bits").bitwiseAND(_bit_of(key)) != 0, F.lit(False))
    return both.where(held if among else ~held).select(*df.columns)


def _bit_of(key: str) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(key).bitwiseAND(F.lit(63)).cast("int"))  # by a column


def month_of(moment: Column) -> Column:
    """The part that a row belongs to: its month, or ``none``."""
    return F.coalesce(F.date_format(moment, "yyyy-MM"), F.lit("none"))
