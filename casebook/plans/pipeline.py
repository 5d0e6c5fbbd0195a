"""Landing to raw to quality gate to clean tables to star schema.

Every step reads what the step before it has written, so a step that is run again,
after a lost executor or a failed job, starts from a stored table and leaves one result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.functions import path_token_text
from casebook.operators import merge, quality, star
from casebook.plans import history, incidents
from casebook.sinks import (
    append_partitioned,
    replace_partitions,
    write_by_month,
    write_lines,
    write_single_csv,
    write_table,
    write_tables,
)
from casebook.sources import (
    MissingColumnsError,
    landing_layouts,
    missing_columns,
    read_table,
    require_columns,
    require_in_files,
    scan_landing,
    scan_large,
    with_lineage,
)


class QualityError(ValueError):
    def __init__(self, failed: Sequence[str]):
        self.failed = list(failed)
        super().__init__(f"Critical data quality checks failed: {', '.join(self.failed)}")


# One layout for both ways of storing, so that they can be mixed in one history.
HISTORY_PARTITIONS = ("logical_date", "run_id")


@dataclass(frozen=True)
class Zones:
    """Where the tables of one data set live; any path Spark can write to."""

    root: str
    dataset: str = "incidents"

    def _at(self, zone: str, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), zone, *parts])

    @property
    def raw(self) -> str:
        return self._at("raw", self.dataset)

    @property
    def raw_changes(self) -> str:
        return self._at("raw", f"{self.dataset}_changes")

    @property
    def detail(self) -> str:
        return self._at("clean", f"{self.dataset}_detail")

    @property
    def changes(self) -> str:
        return self._at("clean", f"{self.dataset}_changes")

    @property
    def daily(self) -> str:
        return self._at("clean", f"{self.dataset}_daily_summary")

    @property
    def by_month(self) -> str:
        return self._at("analytics", f"{self.dataset}_by_month")

    @property
    def history(self) -> str:
        return self._at("quality", f"raw_{self.dataset}", "dq_results_history")

    @property
    def closed_history(self) -> str:
        return self._at("quality", f"raw_{self.dataset}", "dq_results_closed")

    @property
    def report(self) -> str:
        return self._at("quality", f"raw_{self.dataset}", "reports", "raw_dq_latest.md")

    @property
    def maintained(self) -> str:
        return self._at("maintained", self.dataset)

    def records(self, run_id: str) -> str:
        return self._at("quality", f"raw_{self.dataset}", "dq_records", f"run_id={path_token_text(run_id)}")

    def current(self, run_id: str) -> str:
        return self._at("quality", f"raw_{self.dataset}", "dq_results", f"run_id={path_token_text(run_id)}")

    def star(self, table: str) -> str:
        return self._at("star", table)


def new_run(
    dataset: str, run_id: str = "manual_run", logical_date: str | None = None, layer: str = "raw"
) -> quality.Run:
    """Run identity; the logical date defaults to today in UTC."""
    now = datetime.now(timezone.utc)
    return quality.Run(run_id, logical_date or now.date().isoformat(), now.isoformat(), dataset, layer)


def ingest(
    spark: SparkSession,
    landing: str | Sequence[str],
    zones: Zones,
    required: Sequence[str] = incidents.REQUIRED_COLUMNS,
    columns: Sequence[str] | None = None,
    large_files: bool = False,
    raw: str | None = None,
) -> int:
    """Landing CSV to raw Parquet, all strings, with lineage. Returns the rows written.

    Every file must have the required columns. ``large_files`` reads each file with many
    tasks; see ``scan_large``. ``raw`` lands somewhere else than in the raw zone.
    """
    layouts = landing_layouts(spark, landing)
    require_in_files(layouts, required)
    scan = (scan_large if large_files else scan_landing)(spark, landing, columns, source_file=True, layouts=layouts)
    require_columns(scan, required)
    return write_table(with_lineage(scan), raw or zones.raw)


def check_quality(
    spark: SparkSession,
    zones: Zones,
    run: quality.Run,
    min_rows: int = incidents.MIN_RAW_ROWS,
    max_rows: int = incidents.MAX_RAW_ROWS,
    fail_on_error: bool = True,
    now: Column | None = None,
    keep_every_attempt: bool = False,
    raw: str | None = None,
    suite_of: Callable[..., quality.Suite] = incidents.quality_suite,
) -> DataFrame:
    """Runs the suite on the raw zone, stores the records three ways, then applies the gate.

    The history keeps one copy per logical date and run. ``keep_every_attempt``
    appends instead, so that a repeated run shows up twice.
    """
    table = read_table(spark, raw or zones.raw)
    missing = missing_columns(table, incidents.REQUIRED_COLUMNS)
    suite = suite_of(table, min_rows, max_rows, now)
    records = quality.assess(table, suite, run)

    # The checks run once; sinks and gate read the dozen stored records.
    stored = zones.records(run.run_id)
    write_table(records, stored)
    results = read_table(spark, stored, records.schema)
    rows = results.drop("check_no")

    write_single_csv(results, zones.current(run.run_id), order_by="check_no")
    store = append_partitioned if keep_every_attempt else replace_partitions
    store(rows, zones.history, HISTORY_PARTITIONS)
    history.reopen(spark, zones, run)
    write_lines(quality.report_lines(results, run, short=bool(missing)), zones.report)

    if missing:
        raise MissingColumnsError(missing)
    if fail_on_error:
        enforce(results)
    return results


def enforce(results: DataFrame) -> None:
    """Raises if a critical check failed, naming the checks (never more than the suite has)."""
    failed = [row.check_name for row in quality.blocking(results).orderBy("check_no").collect()]
    if failed:
        raise QualityError(failed)


def read_history(spark: SparkSession, zones: Zones) -> DataFrame:
    """All stored check records, compacted or not."""
    return history.read(spark, zones)


def transform(
    spark: SparkSession, zones: Zones, category_of_type: Mapping[str, str] = incidents.CATEGORY_OF_TYPE
) -> dict[str, int]:
    """Raw to clean detail and daily summary. Returns rows written per table.

    De-duplication leaves one row per id and task before its one shuffle, whether or not
    ids are repeated. The summary is computed from the stored detail, so the two always agree.
    """
    raw = read_table(spark, zones.raw)
    detail_rows = write_table(incidents.clean_detail(spark, raw, category_of_type), zones.detail)
    return {"detail": detail_rows, "daily_summary": _summarize(spark, zones)}


def _summarize(spark: SparkSession, zones: Zones) -> int:
    """Daily summary and its layout by month, from the stored detail."""
    rows = write_table(incidents.daily_summary(read_table(spark, zones.detail)), zones.daily)
    write_by_month(read_table(spark, zones.daily), zones.by_month, "crime_date")
    return rows


def _apart(source: Zones, target: Zones) -> None:
    """A refresh reads the source while it writes the target: neither may hold the other."""
    a, b = (zones.root.rstrip("/") + "/" for zones in (source, target))
    if a.startswith(b) or b.startswith(a):
        raise ValueError(f"the target {target.root} must lie apart from the source {source.root}")


def refresh(
    spark: SparkSession,
    zones: Zones,
    landing: str | Sequence[str],
    target: Zones,
    run: quality.Run,
    min_rows: int = 1,
    max_rows: int = incidents.MAX_RAW_ROWS,
    fail_on_error: bool = True,
    now: Column | None = None,
    category_of_type: Mapping[str, str] = incidents.CATEGORY_OF_TYPE,
    large_files: bool = False,
) -> dict[str, int]:
    """Applies newly landed rows to the tables of ``zones``; all tables of the result go to ``target``.

    The changes land in a zone of their own, pass the gate, which takes several versions of an id, and per id
    the latest ``updated_on`` stays. The old tables are only read, so a refresh that fails
    half-way is simply run again. ``target`` must be another place than ``zones``.
    """
    _apart(zones, target)
    ingest(spark, landing, target, large_files=large_files, raw=target.raw_changes)
    check_quality(
        spark, target, run, min_rows, max_rows, fail_on_error, now, raw=target.raw_changes, suite_of=incidents.changes_suite
    )
    changes = incidents.clean_detail(spark, read_table(spark, target.raw_changes), category_of_type)
    # Stored, the changes are cleaned once, and their known size decides how they are joined.
    write_table(changes, target.changes)
    base, changes = read_table(spark, zones.detail), read_table(spark, target.changes)
    merged = merge.upsert_latest(base, changes, ["id"], "updated_timestamp")
    detail_rows = write_table(merged, target.detail)
    daily_rows = _summarize(spark, target)
    return {"detail": detail_rows, "daily_summary": daily_rows, **build_star(spark, target)}


def build_star(spark: SparkSession, zones: Zones) -> dict[str, int]:
    """Clean detail to seven dimensions, the incident fact and its daily summary. Returns rows per table."""
    detail = read_table(spark, zones.detail)
    tables = {name: star.build_dimension(detail, dim) for name, dim in incidents.dimensions().items()}
    tables["fact_crime_incident"] = incidents.incident_fact(detail)
    tables["agg_daily_crime_summary"] = incidents.daily_summary_by_key(detail)
    rows = write_tables({zones.star(name): frame for name, frame in tables.items()})
    return {name: rows[zones.star(name)] for name in tables}


def run_pipeline(
    spark: SparkSession,
    landing: str | Sequence[str],
    zones: Zones,
    run: quality.Run,
    min_rows: int = incidents.MIN_RAW_ROWS,
    max_rows: int = incidents.MAX_RAW_ROWS,
    fail_on_error: bool = True,
    now: Column | None = None,
    category_of_type: Mapping[str, str] = incidents.CATEGORY_OF_TYPE,
    large_files: bool = False,
) -> DataFrame:
    """Ingest, check, transform; returns the stored daily summary. A failed gate stops before the transform."""
    ingest(spark, landing, zones, large_files=large_files)
    check_quality(spark, zones, run, min_rows, max_rows, fail_on_error, now)
    transform(spark, zones, category_of_type)
    return read_table(spark, zones.daily)
