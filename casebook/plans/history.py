"""The history of check records: a folder per date and run, and one file per compaction for dates that are closed.

A run writes its records into a folder of its own. ``compact`` gathers the runs of earlier dates into one file and then
swaps a manifest (``casebook.sinks.versions``) that names the runs it holds; from then on readers take those from the
file. The old folders stay until ``vacuum``, so a reader that began before the swap goes on. A compaction that fails
half-way has changed nothing that is read. A run that is repeated after its date was closed is taken out of the
manifest again (``reopen``), and counts from its own folder until the next compaction.
"""

from __future__ import annotations

from typing import TYPE_CHECKING
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.operators import quality
from casebook.sinks.versions import Folder, Table, VersionedTables
from casebook.sources import read_table

if TYPE_CHECKING:
    from casebook.plans.pipeline import Zones

RECORDS = "records"
PARTITIONS = ("logical_date", "run_id")


def _name(logical_date: str, run_id: str) -> str:
    return f"{logical_date}/{run_id}"


def _closed(spark: SparkSession, zones: Zones) -> VersionedTables:
    return VersionedTables(spark, zones.closed_history)


def _runs(closed: VersionedTables) -> list[str]:
    return closed.parts(RECORDS) if RECORDS in closed else []


def _names(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "name STRING")


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumn("name", F.concat_ws("/", *PARTITIONS))


def _open(spark: SparkSession, zones: Zones, closed: VersionedTables) -> DataFrame:
    """The rows in folders that no closed run has. The schema is given because a date-like folder name would turn into a DATE."""
    if not Folder(spark, zones.history).names():
        return spark.createDataFrame([], quality.RESULT_SCHEMA)
    rows = read_table(spark, zones.history, quality.RESULT_SCHEMA)
    names = _runs(closed)
    return _named(rows).join(_names(spark, names), "name", "left_anti").drop("name") if names else rows


def read(spark: SparkSession, zones: Zones) -> DataFrame:
    """All records: those of closed runs from their files, and those of the others."""
    closed = _closed(spark, zones)
    rows = _open(spark, zones, closed).select(*quality.RESULT_COLUMNS)
    names = _runs(closed)
    if not names:
        return rows
    held = _named(closed.read(RECORDS)).join(_names(spark, names), "name", "left_semi")
    return rows.unionByName(held.select(*quality.RESULT_COLUMNS))


def compact(spark: SparkSession, zones: Zones, before: str) -> int:
    """Gathers the runs of dates before ``before`` into one file; returns its records.

    A history is a dozen records per run, so one file is small. Earlier files are kept, but for one of them per run
    that has been repeated since.
    """
    closed = _closed(spark, zones)
    rows = _open(spark, zones, closed).where(F.col("logical_date") < before)
    found = rows.select(*PARTITIONS).distinct().collect()
    if not found:
        return 0
    draft = closed.begin()
    earlier = dict(closed.tables[RECORDS].parts) if RECORDS in closed else {}
    count = draft.replace(RECORDS, rows.select(*quality.RESULT_COLUMNS).coalesce(1))
    written = draft.tables[RECORDS]
    (folder,) = written.parts.values()
    draft.tables[RECORDS] = Table(written.schema, earlier | {_name(*r): folder for r in found})
    draft.commit()
    return count


def reopen(spark: SparkSession, zones: Zones, run: quality.Run) -> None:
    """Lets the records in the run's own folder count, if the run has been closed before."""
    closed = _closed(spark, zones)
    name = _name(run.logical_date, run.run_id)
    if name not in _runs(closed):
        return
    draft = closed.begin()
    table = closed.tables[RECORDS]
    draft.tables[RECORDS] = Table(table.schema, {n: f for n, f in table.parts.items() if n != name})
    draft.commit()


def vacuum(spark: SparkSession, zones: Zones) -> list[str]:
    """Removes the folders of closed runs, and manifests and files that no reader needs who begins now."""
    closed = _closed(spark, zones)
    names, plain, removed = set(_runs(closed)), Folder(spark, zones.history), []
    for date in plain.names():
        runs = plain.names(date)
        gone = [r for r in runs if f"{unquote(date.partition('=')[2])}/{unquote(r.partition('=')[2])}" in names]
        for run in gone:
            plain.delete(date, run)
            removed.append(f"{date}/{run}")
        if gone and len(gone) == len(runs):
            plain.delete(date)
    return removed + closed.vacuum()
