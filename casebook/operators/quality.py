"""Data-quality checks in two aggregates, whatever the number of checks.

All row rules are counted in one pass that shuffles one row per task. Key uniqueness
is the only rule that needs the keys brought together; it reads the key column alone.
Both results are single rows that are turned into check records without a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions import outside, present, safe_cast, uncastable
from casebook.functions.text import blank
from casebook.functions.typing import parse_timestamp_any
from casebook.sources.contract import missing_columns

CRITICAL = "critical"
WARNING = "warning"

# Columns of a result record, all strings, in order.
RESULT_COLUMNS = (
    "run_id",
    "logical_date",
    "run_timestamp",
    "dataset_name",
    "layer_name",
    "check_name",
    "status",
    "severity",
    "observed_value",
    "rule",
    "details",
)

# Names of the two checks that open every suite, and the wording of the report.
REQUIRED_COLUMNS_CHECK = "required_columns_exist"
ROW_COUNT_CHECK = "row_count_between_expected_range"
REPORT_TITLE = "# Raw Data Quality Report"
REPORT_TABLE_HEAD = "| Check | Status | Severity | Observed Value | Rule |"
REPORT_TABLE_RULE = "|---|---|---|---:|---|"
REPORT_MISSING = "Critical failure: missing required columns."

# The rules as the records state them.
REQUIRED_RULE = "All required columns must exist"
REQUIRED_PRESENT = "All required columns exist"
REQUIRED_MISSING = "Missing columns: {}"
ROW_COUNT_RULE = "Row count must be between {} and {}"
ROW_COUNT_DETAILS = "Validates the expected data volume"
NOT_NULL_RULE = "{} must not be null"
CASTABLE_RULE = "{} must be castable to {}"
UNIQUE_RULE = "{} must be unique"
NO_DUPLICATES_RULE = "No duplicate {} rows"
TIMESTAMP_RULE = "{} must be parseable as timestamp"
NOT_FUTURE_RULE = "{} must not be in the future"
RANGE_RULE = "{} should be within [{}, {}]"

RESULT_SCHEMA = ", ".join(f"{name} STRING" for name in RESULT_COLUMNS)


@dataclass(frozen=True)
class Run:
    """Identity of one quality run, repeated on each of its records."""

    run_id: str
    logical_date: str
    run_timestamp: str
    dataset_name: str
    layer_name: str = "raw"


@dataclass(frozen=True)
class RowCheck:
    """Counts the rows for which ``offends`` is true; none may be."""

    name: str
    offends: Column
    rule: str
    details: str
    severity: str = CRITICAL


@dataclass(frozen=True)
class KeyCheck:
    """Counts keys seen more than once, and the rows beyond the first of each key.

    ``also`` adds columns to the key. With ``per``, what is counted are not rows but the different values of that column.
    """

    key: Column
    groups_name: str
    rows_name: str
    rule: str
    rows_rule: str
    details: str = "Keys that occur more than once"
    rows_details: str = "Rows beyond the first of each key"
    also: Sequence[Column] = ()
    per: Column | None = None
    severity: str = CRITICAL


@dataclass(frozen=True)
class Suite:
    """Checks in the order in which their records are numbered.

    ``derived`` columns are computed once per row and shared by the checks.
    """

    required: Sequence[str]
    min_rows: int
    max_rows: int
    checks: Sequence[RowCheck | KeyCheck]
    derived: Mapping[str, Column] = field(default_factory=dict)


def null_check(name: str, column: Column | str, label: str) -> RowCheck:
    return RowCheck(name, blank(column), NOT_NULL_RULE.format(label), f"{label} is NULL or blank")


def cast_check(name: str, column: Column | str, type_: str, label: str) -> RowCheck:
    return RowCheck(
        name,
        uncastable(column, type_),
        CASTABLE_RULE.format(label, type_.upper()),
        f"{label} has content that is no {type_.upper()}",
    )


def time_checks(invalid_name: str, future_name: str, column: str, label: str, now: Column | None = None):
    """Derived column and two checks for text timestamps: unreadable, and after ``now``."""
    parsed = f"__{column}_parsed"
    moment = F.current_timestamp() if now is None else now
    derived = {parsed: parse_timestamp_any(column)}
    checks = [
        RowCheck(
            invalid_name,
            present(column) & F.col(parsed).isNull(),
            TIMESTAMP_RULE.format(label),
            f"{label} has content that is no timestamp",
        ),
        RowCheck(
            future_name,
            F.col(parsed) > moment,
            NOT_FUTURE_RULE.format(label),
            f"{label} lies after the time of the check",
        ),
    ]
    return derived, checks


def range_check(name: str, column: Column | str, low: float, high: float, label: str) -> RowCheck:
    return RowCheck(
        name,
        outside(column, low, high),
        RANGE_RULE.format(label, low, high),
        f"{label} has content that is no number in the range",
        WARNING,
    )


def key_check(groups_name: str, rows_name: str, column: str, type_: str, label: str) -> KeyCheck:
    return KeyCheck(
        safe_cast(column, type_), groups_name, rows_name, UNIQUE_RULE.format(label), NO_DUPLICATES_RULE.format(label)
    )


def count_offending(df: DataFrame, offends: Mapping[str, Column]) -> DataFrame:
    """One row: ``total_rows`` and one count per predicate, all from a single scan."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count_if(p).alias(name) for name, p in offends.items()]
    )


def count_duplicates(df: DataFrame, *keys: Column | str, per: Column | None = None) -> DataFrame:
    """One row: ``duplicate_groups`` and ``duplicate_rows``. NULL keys are no duplicates.

    Counts are combined before the shuffle, so a key that holds a large part of the
    rows arrives as one row per task. With ``per``, equal values of it count once.
    """
    if per is not None:
        keyed = [(F.col(k) if isinstance(k, str) else k).alias(f"key{i}") for i, k in enumerate(keys)]
        df, keys = df.select(*keyed, per.alias("per")).distinct(), [f"key{i}" for i in range(len(keyed))]
    named = [(F.col(k) if isinstance(k, str) else k).alias(f"k{i}") for i, k in enumerate(keys)]
    names = [f"k{i}" for i in range(len(keys))]
    keyed = df.select(*named)
    for name in names:
        keyed = keyed.filter(F.col(name).isNotNull())
    per_key = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.col("n") > 1
    return per_key.agg(
        F.count_if(repeated).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(repeated, F.col("n") - 1)), F.lit(0)).cast("bigint").alias("duplicate_rows"),
    )


def _record(number: int, name: str, passed: Column, on_fail: str, severity: str, observed, rule: str, details: str):
    return F.struct(
        F.lit(number).alias("check_no"),
        F.lit(name).alias("check_name"),
        F.when(passed, "PASS").otherwise(on_fail).alias("status"),
        F.lit(severity).alias("severity"),
        observed.cast("string").alias("observed_value"),
        F.lit(rule).alias("rule"),
        F.lit(details).alias("details"),
    )


def _count_record(number: int, name: str, severity: str, rule: str, details: str, column: str):
    on_fail = "WARN" if severity == WARNING else "FAIL"
    return _record(number, name, F.col(column) == 0, on_fail, severity, F.col(column), rule, details)


def assess(df: DataFrame, suite: Suite, run: Run) -> DataFrame:
    """Check records: ``check_no`` plus the result columns, one row per check.

    If required columns are missing, only that finding and the row count are given.
    """
    missing = missing_columns(df, suite.required)
    checks = [] if missing else list(suite.checks)
    row_checks = [c for c in checks if isinstance(c, RowCheck)]

    typed = df if missing else df.withColumns(dict(suite.derived))
    totals = count_offending(typed, {c.name: c.offends for c in row_checks})

    from_rows = [
        _record(
            1,
            REQUIRED_COLUMNS_CHECK,
            F.lit(not missing),
            "FAIL",
            CRITICAL,
            F.lit(",".join(missing) if missing else "none"),
            REQUIRED_RULE,
            REQUIRED_MISSING.format(missing) if missing else REQUIRED_PRESENT,
        ),
        _record(
            2,
            ROW_COUNT_CHECK,
            F.col("total_rows").between(suite.min_rows, suite.max_rows),
            "FAIL",
            CRITICAL,
            F.col("total_rows"),
            ROW_COUNT_RULE.format(suite.min_rows, suite.max_rows),
            ROW_COUNT_DETAILS,
        ),
    ]
    frames = []
    number = 3
    for check in checks:
        if isinstance(check, RowCheck):
            from_rows.append(
                _count_record(number, check.name, check.severity, check.rule, check.details, check.name)
            )
            number += 1
        else:
            records = [
                _count_record(number, check.groups_name, check.severity, check.rule, check.details, "duplicate_groups"),
                _count_record(
                    number + 1, check.rows_name, check.severity, check.rows_rule, check.rows_details, "duplicate_rows"
                ),
            ]
            counted = count_duplicates(df, check.key, *check.also, per=check.per)
            frames.append(counted.select(F.inline(F.array(*records))))
            number += 2
    records = totals.select(F.inline(F.array(*from_rows)))
    for frame in frames:
        records = records.unionByName(frame)

    identity = [F.lit(getattr(run, name)).alias(name) for name in RESULT_COLUMNS[:5]]
    return records.select("check_no", *identity, *RESULT_COLUMNS[5:])


def blocking(results: DataFrame) -> DataFrame:
    """The records that stop a pipeline: critical checks that failed. Warnings never do."""
    return results.filter((F.col("status") == "FAIL") & (F.col("severity") == CRITICAL))


def report_lines(results: DataFrame, run: Run, short: bool = False) -> DataFrame:
    """Markdown report as ``line_no, line``; ``short`` when required columns are missing."""
    head = [
        REPORT_TITLE,
        f"Run ID: {run.run_id}",
        f"Logical Date: {run.logical_date}",
        f"Run Timestamp: {run.run_timestamp}",
    ]
    if short:
        lines = [F.lit(text) for title in head for text in (title, "")]
        lines.append(F.lit(REPORT_MISSING))
        first = results.filter(F.col("check_name") == REQUIRED_COLUMNS_CHECK)
        return first.select(F.posexplode(F.array(*lines)).alias("line_no", "line"))

    head += [f"Dataset: {run.dataset_name}", f"Layer: {run.layer_name}"]
    lines = [F.lit(text) for title in head for text in (title, "")]
    lines += [
        F.concat(F.lit("Total Rows: "), "observed_value"),
        F.lit(""),
        F.lit(REPORT_TABLE_HEAD),
        F.lit(REPORT_TABLE_RULE),
    ]
    row_count = results.filter(F.col("check_name") == ROW_COUNT_CHECK)
    top = row_count.select(F.posexplode(F.array(*lines)).alias("line_no", "line"))
    cells = ["check_name", "status", "severity", "observed_value", "rule"]
    table = results.select(
        (F.col("check_no") + len(lines)).alias("line_no"),
        F.format_string("| %s | %s | %s | %s | %s |", *cells).alias("line"),
    )
    return top.unionByName(table)
