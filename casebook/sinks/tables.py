"""Parquet sinks. Each write also reports its row count, without a second job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _write_counted(df: DataFrame, path: str, mode: str, partition_by: Sequence[str] = (), **options) -> int:
    # The count sits directly under the write, in its result stage: a task that is
    # run again after a lost executor is counted once.
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def write_table(df: DataFrame, path: str) -> int:
    """Overwrites the table and returns the number of rows written."""
    return _write_counted(df, path, "overwrite")


def write_tables(frames: Mapping[str, DataFrame], at_once: int = 4) -> dict[str, int]:
    """Overwrites several independent tables, given by path; a few jobs run side by side.

    The short last stages of one write then overlap with the scan of the next.
    """
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(frames, pool.map(write_table, frames.values(), frames), strict=True))


def append_partitioned(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Adds rows to a partitioned history. Running it twice adds them twice."""
    return _write_counted(df, path, "append", partition_by)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Overwrites only the partitions that occur in ``df``, so a retried run leaves one copy."""
    return _write_counted(df, path, "overwrite", partition_by, partitionOverwriteMode="dynamic")


def write_by_month(df: DataFrame, path: str, day: str) -> int:
    """Overwrites a table laid out by year and month of ``day``.

    The rebalance gathers a month into few files, merges small months, and splits a
    month that holds much of the table over several tasks.
    """
    dated = df.withColumns({"year": F.year(day), "month": F.month(day)})
    return _write_counted(dated.hint("rebalance", "year", "month"), path, "overwrite", ("year", "month"))


RANGES = "_ranges"  # hidden from a plain read of the folder


def write_clustered(df: DataFrame, path: str, column: str, rows_per_file: int = 1_000_000, mode: str = "overwrite") -> int:
    """Writes files of about ``rows_per_file`` rows, each holding a range of ``column`` in order, and the range of each file.

    Takes a stored table: it is counted, sampled and written. The ranges are read back from that column of the new files
    alone. Rows of one value are dealt to several files if they are many. ``append`` adds files, whose
    ranges may overlap older ones. A file without a known range, as after a failure in between, is read by every extract.
    """
    spark = df.sparkSession
    files = max(1, -(-df.count() // rows_per_file))
    known = set(spark.read.schema(df.schema).parquet(path).inputFiles()) if mode == "append" and _names(spark, path) else set()
    ordered = df.withColumn("__tie", F.xxhash64(*df.columns)).repartitionByRange(files, F.col(column), F.col("__tie"))
    rows = _write_counted(ordered.sortWithinPartitions(column, "__tie").drop("__tie"), path, mode)
    new = [file for file in spark.read.schema(df.schema).parquet(path).inputFiles() if file not in known]
    written = spark.read.schema(df.schema).parquet(*map(unquote, new))
    ranges = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(column).alias("first"), F.max(column).alias("last"))
    _write_counted(ranges.coalesce(1), f"{path}/{RANGES}", mode)
    return rows


def read_clustered(spark: SparkSession, path: str, column: str, first: Column, last: Column) -> DataFrame:
    """The rows with ``first <= column <= last``; files whose range lies elsewhere are not part of the plan."""
    table = spark.read.parquet(path)
    held = F.col(column).between(first, last)
    skipped = set()
    if RANGES in _names(spark, path):
        ranges = spark.read.parquet(f"{path}/{RANGES}")
        away = (F.col("last") < first) | (F.col("first") > last) | F.col("first").isNull()
        skipped = {r.file for r in ranges.where(away).select("file").collect()}
    wanted = [file for file in map(unquote, table.inputFiles()) if file.rpartition("/")[2] not in skipped]
    return spark.read.schema(table.schema).parquet(*wanted).where(held) if wanted else table.where(held).limit(0)


def _names(spark: SparkSession, path: str) -> list[str]:
    from casebook.sinks.versions import Folder

    return Folder(spark, path).names()
