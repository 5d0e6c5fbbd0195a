"""Deterministic keys over natural-key columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.functions.text import as_text


def surrogate_key(*fields: Column | str) -> Column:
    """SHA-256 over the fields, 64 hex digits, the same in every run and partition.

    Each field is written as ``length:value`` and NULL as ``-``, so that no two
    different tuples of one arity share an encoding, whatever text they hold.
    """
    encoded = []
    for field in fields:
        text = as_text(field)
        encoded.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*encoded), 256)
