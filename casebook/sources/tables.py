"""Parquet tables and small literal tables."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A Parquet table. Give the schema where folder names would be read as other types."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def lookup_table(spark: SparkSession, entries: Mapping[str, str], key: str, value: str) -> DataFrame:
    """Two string columns from a mapping, one row per key.

    Built from Arrow, so the optimizer knows its exact size: it is broadcast below
    ``spark.sql.autoBroadcastJoinThreshold`` and merge-joined above, without a hint.
    """
    table = pa.table({key: pa.array(entries.keys(), pa.string()), value: pa.array(entries.values(), pa.string())})
    return spark.createDataFrame(table)
