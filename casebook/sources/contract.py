"""Column contract, checked on the plan before any job runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


class MissingColumnsError(ValueError):
    def __init__(self, missing: Sequence[str], file: str | None = None):
        self.missing = list(missing)
        super().__init__(f"Missing required columns: {', '.join(self.missing)}" + (f" in {file}" if file else ""))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Absent names in contract order. Exact spelling: ``ID`` does not stand for ``id``."""
    have = set(df.columns)
    return [name for name in required if name not in have]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise MissingColumnsError(missing)
    return df
