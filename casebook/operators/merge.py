"""Incremental refresh of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.operators.clean import latest_per_key


def upsert_latest(base: DataFrame, changes: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """Base with the changes applied: per key the version with the greatest ``newest``.

    A change also wins a tie, so applying the same changes again alters nothing. The
    base must hold each key once; changes may hold several versions of a key.

    The base is joined to one row per changed key. Spark broadcasts that side if its
    size allows, and then the base is not shuffled; otherwise its wide rows are
    shuffled once, and its keys once more to find the changes that are new.
    """
    keys = list(keys)
    others = [c for c in base.columns if c not in keys]
    latest = latest_per_key(changes.select(*base.columns), keys, newest)

    change = F.col("__change")
    applies = change.isNotNull() & (F.col(newest).isNull() | F.coalesce(change[newest] >= F.col(newest), F.lit(False)))
    packed = latest.select(*keys, F.struct(*others).alias("__change"))
    kept = base.join(packed, on=keys, how="left").select(
        *[F.when(applies, change[c]).otherwise(F.col(c)).alias(c) if c in others else F.col(c) for c in base.columns]
    )

    known = base.select(*keys).join(latest.select(*keys), on=keys, how="left_semi")
    added = latest.join(known, on=keys, how="left_anti").select(*base.columns)
    return kept.unionByName(added)
