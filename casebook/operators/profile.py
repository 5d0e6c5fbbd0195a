"""Column profiles: how many values, and which columns could be keys."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEW_VALUES = 5_000  # a column of so few is counted as a set
AT_ONCE = 100  # sketches of combined columns taken in one pass
SLICES = 64  # repeated values are looked for in one of so many slices first
SHOWN = 100  # hashes that repeat and are held against the values


def _long(row: DataFrame, columns: Sequence[str], **fields: str) -> DataFrame:
    """One row of ``<field>_<i>`` columns turned into one row per profiled column."""
    records = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{p}_{i}").alias(n) for n, p in fields.items()])
        for i, c in enumerate(columns)
    ]
    return row.select(*[c for c in ("total_rows",) if c in row.columns], F.inline(F.array(*records)))


def _sketched(df: DataFrame, column: str, log_size: int) -> Column:
    """Approximate distinct count from one HLL sketch per task, merged at the end."""
    direct = dict(df.dtypes)[column] in ("int", "bigint", "string", "binary")
    value = F.col(column) if direct else F.col(column).cast("string")
    estimate = F.hll_sketch_estimate(F.hll_sketch_agg(value, F.lit(log_size)))
    return F.coalesce(estimate, F.lit(0)).cast("bigint")


def _exact(df: DataFrame, names: Sequence[str], log_size: int = 12) -> DataFrame:
    """One row of exact distinct counts ``d_<i>``.

    Sketches come first. Columns of few values are counted as sets, all in one pass and
    of bounded size; only the others pay for a copy of the rows per column.
    """
    guess = df.agg(*[_sketched(df, c, log_size).alias(f"d_{i}") for i, c in enumerate(names)]).first()
    few = [i for i in range(len(names)) if guess[f"d_{i}"] <= FEW_VALUES]
    sets = [F.size(F.collect_set(_plain(df, names[i]))).cast("bigint").alias(f"d_{i}") for i in few]
    rest = [F.count_distinct(c).alias(f"d_{i}") for i, c in enumerate(names) if i not in few]
    parts = [df.agg(*aggregates) for aggregates in (sets, rest) if aggregates]
    if len(parts) == 1:
        return parts[0]
    return parts[0].withColumn("one", F.lit(1)).join(parts[1].withColumn("one", F.lit(1)), "one").drop("one")


def _plain(df: DataFrame, column: str) -> Column:
    """Zero has one sign, as in grouping."""
    return F.col(column) + F.lit(0.0) if dict(df.dtypes)[column] in ("double", "float") else F.col(column)


def distinct_profile(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False, log_size: int = 12
) -> DataFrame:
    """Distinct non-NULL values per column, ascending.

    Exact counts shuffle each distinct value once per column and task. The approximate
    form shuffles one sketch of at most ``2 ** log_size`` bytes per column and task; its
    standard error is about ``1.04 / sqrt(2 ** log_size)``, 1.6 % by default.
    """
    names = list(columns or df.columns)
    if approximate:
        row = df.agg(*[_sketched(df, c, log_size).alias(f"d_{i}") for i, c in enumerate(names)])
    else:
        row = _exact(df, names, log_size)
    return _long(row, names, distinct_count="d").orderBy("distinct_count", "column_name")


def possible_keys(df: DataFrame, columns: Sequence[str] | None = None, log_size: int = 12) -> list[str]:
    """Columns without NULLs whose sketched count of values is near the number of rows.

    One pass that moves a sketch per column and task. Six standard errors below the row
    count are allowed for, so a real key is not missed; exact counts can then be confined to these.
    """
    names = list(columns or df.columns)
    row = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(names)],
        *[_sketched(df, c, log_size).alias(f"d_{i}") for i, c in enumerate(names)],
    ).first()
    least = row["total"] * (1 - 6 * 1.04 / 2 ** (log_size / 2))
    return [c for i, c in enumerate(names) if row[f"n_{i}"] == 0 and row[f"d_{i}"] >= least]


def key_candidates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, NULLs and distinct values per column, and whether the column identifies a row.

    If only the keys matter, ask ``possible_keys`` first and pass what it leaves.
    """
    names = list(columns or df.columns)
    row = df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(names)]
    )
    row = row.withColumn("one", F.lit(1)).join(_exact(df, names).withColumn("one", F.lit(1)), "one").drop("one")
    is_key = F.col("distinct_count") == F.col("total_rows")
    verdict = F.when(is_key, "unique key").otherwise("review")
    return _long(row, names, null_count="n", distinct_count="d").withColumn("verdict", verdict)


def column_sketches(df: DataFrame, by: Column, columns: Sequence[str], log_size: int = 12) -> DataFrame:
    """Per ``by`` (as ``day``) and column: rows, NULLs and a sketch of the values, from one pass over ``df``.

    Sketches can be merged: stored per day beside the data, they profile any range of days without its rows.
    One shuffled row per day and task, with a sketch of at most ``2 ** log_size`` bytes per column.
    """
    row = df.groupBy(by.alias("day")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[F.hll_sketch_agg(_plain(df, c).cast("string"), F.lit(log_size)).alias(f"s_{i}") for i, c in enumerate(columns)],
    )
    records = [F.struct(F.lit(c).alias("column_name"), "rows", F.col(f"n_{i}").alias("nulls"), F.col(f"s_{i}").alias("sketch")) for i, c in enumerate(columns)]
    return row.select("day", F.inline(F.array(*records)))


def merged_profile(sketches: DataFrame) -> DataFrame:
    """Rows, NULLs and the estimated distinct count per column, over all the days of ``sketches``."""
    estimate = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    merged = sketches.groupBy("column_name").agg(F.sum("rows").alias("total_rows"), F.sum("nulls").alias("null_count"), estimate.alias("distinct_count"))
    return merged.withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)).cast("bigint"))


def smallest_keys(df: DataFrame, columns: Sequence[str] | None = None, most: int = 3, log_size: int = 12) -> list[tuple[str, ...]]:
    """All minimal sets of at most ``most`` columns that identify a row, by size and order of columns.

    Level by level: sets that hold a key found before are left out, and so are sets whose columns have too few values
    for the rows, whatever their combinations. What is left is sketched, many sets in one pass that moves a
    sketch per set and task; only sets whose estimate is near the number of rows, six standard errors allowed for, are
    checked exactly (``_unique``). Columns with NULLs are no part of a key.
    """
    names = list(columns or df.columns)
    row = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(names)],
        *[_sketched(df, c, log_size).alias(f"d_{i}") for i, c in enumerate(names)],
    ).first()
    total, margin = row["total"], 6 * 1.04 / 2 ** (log_size / 2)
    values = {c: max(1, row[f"d_{i}"]) * (1 + margin) for i, c in enumerate(names) if row[f"n_{i}"] == 0}
    keys: list[tuple[str, ...]] = []
    for size in range(1, most + 1):
        sets = [s for s in itertools.combinations(values, size) if not any(set(k) <= set(s) for k in keys)]
        sets = [s for s in sets if _product(values[c] for c in s) >= total]
        near = [s for s in sets if size == 1 and values[s[0]] >= total * (1 - margin)]
        for start in range(0, len(sets) if size > 1 else 0, AT_ONCE):
            some = sets[start : start + AT_ONCE]
            combined = [F.xxhash64(*[_plain(df, c) for c in s]) for s in some]
            found = df.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(c, F.lit(log_size))).alias(f"d_{i}") for i, c in enumerate(combined)]).first()
            near += [s for i, s in enumerate(some) if (found[f"d_{i}"] or 0) >= total * (1 - margin)]
        keys += [s for s in near if _unique(df, s)]
    return keys


def _product(numbers) -> float:
    result = 1.0
    for n in numbers:
        result *= n
    return result


def _unique(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether no values repeat, exactly.

    Equal values have equal hashes. A repeated value in one slice of the hashes settles it, so most sets that are no key move a
    small part of their rows. For the others all hashes are moved, and nothing else: if none repeats, no values do.
    Hashes that repeat are held against their values; only if many do and all by chance, the values themselves are moved.
    """
    names = [f"k{i}" for i in range(len(columns))]
    rows = df.select(*[_plain(df, c).alias(n) for c, n in zip(columns, names, strict=True)]).withColumn("hash", F.xxhash64(*names))
    if _repeats(rows.where(F.pmod("hash", F.lit(SLICES)) == 0), names):
        return False
    hashes = rows.select("hash").repartition("hash").groupBy("hash").count().where("count > 1")
    shown = [r.hash for r in hashes.select("hash").limit(SHOWN).collect()]
    if shown and _repeats(rows.where(F.col("hash").isin(shown)), names):
        return False
    return len(shown) < SHOWN or not _repeats(rows, names)


def _repeats(rows: DataFrame, names: Sequence[str]) -> bool:
    return not rows.groupBy(*names).count().where("count > 1").isEmpty()
