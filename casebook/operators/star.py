"""Star schema with hashed keys.

A key is a function of the natural columns, so the fact table is a projection: it
needs no join to its dimensions and no numbering. Where rows are grouped, grouping
comes first and hashing after, on the few rows that remain.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions import surrogate_key


@dataclass(frozen=True)
class Dimension:
    """``natural`` names the columns that identify a member, each with its expression on the detail.

    ``attributes`` derive further columns from the natural ones. ``members`` may list
    rows that exist whether or not they were observed.
    """

    name: str
    key: str
    natural: Mapping[str, Column]
    attributes: Mapping[str, Column] = field(default_factory=dict)
    members: Callable[[DataFrame], DataFrame] | None = None

    def key_on_detail(self) -> Column:
        return surrogate_key(*self.natural.values()).alias(self.key)


def columns(*names: str) -> dict[str, Column]:
    return {name: F.col(name) for name in names}


def build_dimension(detail: DataFrame, dim: Dimension) -> DataFrame:
    """Distinct members with key and attributes. A member may have NULL parts; it still has a key."""
    members = detail.select(*[c.alias(n) for n, c in dim.natural.items()])
    if dim.members is not None:
        members = members.unionByName(dim.members(detail))
    return keyed(members.distinct(), dim)


def keyed(members: DataFrame, dim: Dimension) -> DataFrame:
    """Members, given by their natural columns, with key and attributes."""
    attributes = [c.alias(n) for n, c in dim.attributes.items()]
    return members.select(surrogate_key(*dim.natural).alias(dim.key), *dim.natural, *attributes)


def build_fact(detail: DataFrame, dims: Sequence[Dimension], carried: Mapping[str, Column]) -> DataFrame:
    """One row per detail row: carried columns and one foreign key per dimension, never NULL."""
    return detail.select(*[c.alias(n) for n, c in carried.items()], *[d.key_on_detail() for d in dims])


def denormalize(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """All fact rows with the columns of all dimensions, given as ``{key column: dimension}``.

    A fact whose member is absent keeps its row, with NULLs in that dimension's columns.
    No hints: dimensions stored as tables have a known size, so small ones are
    broadcast and a large one is merge-joined with skewed keys split at run time.
    """
    wide = fact
    for key, dim in dimensions.items():
        wide = wide.join(dim, on=key, how="left")
    return wide


def star_totals(
    fact: DataFrame,
    dimensions: Mapping[str, DataFrame],
    by: Sequence[str],
    measures: Mapping[str, Column],
    large: Sequence[str] = (),
) -> DataFrame:
    """Additive measures of the fact by dimension attributes.

    Small dimensions are looked up first, cut to the attributes asked for: as broadcast
    joins they let each task sum what it reads, and only sums are shuffled. Dimensions
    whose keys are named in ``large`` come after that: the fact is summed per such key,
    so a key that holds much of the fact is a handful of rows in the join.
    """
    def cut(key: str) -> DataFrame:
        return dimensions[key].select(key, *[c for c in by if c in dimensions[key].columns])

    small = {key: cut(key) for key in dimensions if key not in large}
    wide = denormalize(fact, small)
    early = [c for c in by if c in wide.columns]
    sums = wide.groupBy(*early, *large).agg(*[m.alias(n) for n, m in measures.items()])
    if not large:
        return sums
    wide = denormalize(sums, {key: cut(key) for key in large})
    return wide.groupBy(*by).agg(*[F.sum(n).alias(n) for n in measures])


def foreign_key_orphans(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Per foreign key: how many fact rows and distinct keys have no dimension row.

    One pass over the fact, counted per key before the join.
    """
    keys = list(dimensions)
    used = (
        fact.select(*keys)
        .unpivot([], keys, "foreign_key", "key_value")
        .groupBy("foreign_key", "key_value")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    known = None
    for key, dim in dimensions.items():
        one = dim.select(F.lit(key).alias("foreign_key"), F.col(key).alias("key_value"), F.lit(True).alias("known"))
        known = one if known is None else known.unionByName(one)
    checked = used.join(known, on=["foreign_key", "key_value"], how="left")
    orphan = F.col("known").isNull()
    return checked.groupBy("foreign_key").agg(
        F.sum("uses").alias("fact_rows"),
        F.count_if(orphan).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(orphan, F.col("uses"))), F.lit(0)).cast("bigint").alias("orphan_rows"),
    )


def summarize_by_key(
    detail: DataFrame,
    day: str,
    kind: Dimension,
    date_key: str,
    shown: Sequence[str],
    flags: Mapping[str, Column],
    total: str,
) -> DataFrame:
    """Daily summary at the grain of (date key, ``kind`` key), computed from the detail.

    Groups by the natural columns and hashes the groups, not the rows.
    """
    natural = [c.alias(n) for n, c in kind.natural.items()]
    grouped = (
        detail.groupBy(day, *natural)
        .agg(F.count(F.lit(1)).alias(total), *[F.count_if(f).alias(n) for n, f in flags.items()])
    )
    return grouped.select(
        surrogate_key(day).alias(date_key),
        surrogate_key(*kind.natural).alias(kind.key),
        day,
        *shown,
        total,
        *flags,
    )
