"""Data-quality checks over the dirty landing rows and over typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions import blank, outside, uncastable
from casebook.functions.typing import parse_timestamp_any
from casebook.operators import quality
from casebook.plans import incidents, pipeline
from casebook.session import shared_dir
from casebook.sinks import write_table
from casebook.sources import MissingColumnsError
from suite.landing import ANY_TIME, BIGINT, BLANK, DOUBLE, landing, landing_sql
from suite.registry import query, table

RUN = quality.Run("run 1/a", "2026-01-01", "2026-01-01T00:00:00+00:00", "incidents")
MIN_ROWS, MAX_ROWS = 1, 1_000_000_000
NOW = "2026-01-01 00:00:00"


def now() -> Column:
    return F.to_timestamp(F.lit(NOW))


def suite_for(df: DataFrame) -> quality.Suite:
    return incidents.quality_suite(df, MIN_ROWS, MAX_ROWS, now())


def outside_sql(column: str, low: float, high: float) -> str:
    number = DOUBLE(column)
    return f"(NOT {BLANK(column)} AND ({number} IS NULL OR {number} < {low} OR {number} > {high}))"


OFFENDS_SQL = {
    "null_id_count": BLANK("id"),
    "invalid_id_count": f"(NOT {BLANK('id')} AND {BIGINT('id')} IS NULL)",
    "null_date_count": BLANK('"date"'),
    "invalid_date_count": f"(NOT {BLANK('date')} AND {ANY_TIME('date')} IS NULL)",
    "future_date_count": f"COALESCE({ANY_TIME('date')} > TIMESTAMP '{NOW}', false)",
    "null_primary_type_count": BLANK("primary_type"),
    "invalid_latitude_count": outside_sql("latitude", *incidents.LATITUDE_RANGE),
    "invalid_longitude_count": outside_sql("longitude", *incidents.LONGITUDE_RANGE),
}
DUPLICATES_SQL = f"""SELECT count(*) AS groups, CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS extra FROM (
  SELECT {BIGINT('id')} AS k, count(*) AS n FROM landing GROUP BY 1 HAVING k IS NOT NULL AND n > 1)"""

# name, severity, rule, details
RECORDS = (
    ("null_id_count", "critical", "ID must not be null", "ID is NULL or blank"),
    ("invalid_id_count", "critical", "ID must be castable to BIGINT", "ID has content that is no BIGINT"),
    ("duplicate_id_group_count", "critical", "ID must be unique", "Keys that occur more than once"),
    ("duplicate_record_count", "critical", "No duplicate ID rows", "Rows beyond the first of each key"),
    ("null_date_count", "critical", "Date must not be null", "Date is NULL or blank"),
    ("invalid_date_count", "critical", "Date must be parseable as timestamp", "Date has content that is no timestamp"),
    ("future_date_count", "critical", "Date must not be in the future", "Date lies after the time of the check"),
    ("null_primary_type_count", "critical", "Primary type must not be null", "Primary type is NULL or blank"),
    (
        "invalid_latitude_count",
        "warning",
        "Latitude should be within [41.0, 42.1]",
        "Latitude has content that is no number in the range",
    ),
    (
        "invalid_longitude_count",
        "warning",
        "Longitude should be within [-88.0, -87.0]",
        "Longitude has content that is no number in the range",
    ),
)


def records_sql(dirty: bool) -> str:
    """The twelve records with run identity, as the eleven result columns."""
    counts = ", ".join(f"count(*) FILTER ({text}) AS {name}" for name, text in OFFENDS_SQL.items())
    rows = [
        "SELECT 'required_columns_exist' AS check_name, 'PASS' AS status, 'critical' AS severity,"
        " 'none' AS observed_value, 'All required columns must exist' AS rule,"
        " 'All required columns exist' AS details",
        f"SELECT 'row_count_between_expected_range', CASE WHEN total BETWEEN {MIN_ROWS} AND {MAX_ROWS}"
        " THEN 'PASS' ELSE 'FAIL' END, 'critical', CAST(total AS VARCHAR),"
        f" 'Row count must be between {MIN_ROWS} and {MAX_ROWS}', 'Validates the expected data volume' FROM counted",
    ]
    source = {"duplicate_id_group_count": "groups", "duplicate_record_count": "extra"}
    for name, severity, rule, details in RECORDS:
        column = source.get(name, name)
        origin = "duplicated" if name in source else "counted"
        on_fail = "WARN" if severity == "warning" else "FAIL"
        rows.append(
            f"SELECT '{name}', CASE WHEN {column} = 0 THEN 'PASS' ELSE '{on_fail}' END, '{severity}',"
            f" CAST({column} AS VARCHAR), '{rule}', '{details}' FROM {origin}"
        )
    return f"""WITH landing AS ({landing_sql(dirty)}),
counted AS (SELECT count(*) AS total, {counts} FROM landing),
duplicated AS ({DUPLICATES_SQL})
SELECT '{RUN.run_id}' AS run_id, '{RUN.logical_date}' AS logical_date, '{RUN.run_timestamp}' AS run_timestamp,
  '{RUN.dataset_name}' AS dataset_name, '{RUN.layer_name}' AS layer_name, * FROM ({" UNION ALL ".join(rows)})"""


@query("dq_report", records_sql(dirty=True))
def dq_report(spark, sf_dir):
    raw = landing(spark, sf_dir, dirty=True)
    return quality.assess(raw, suite_for(raw), RUN).drop("check_no")


@query("dq_report_clean", records_sql(dirty=False))
def dq_report_clean(spark, sf_dir):
    raw = landing(spark, sf_dir)
    return quality.assess(raw, suite_for(raw), RUN).drop("check_no")


@query(
    "dq_gate",
    f"SELECT check_name, observed_value FROM ({records_sql(dirty=True)}) WHERE status = 'FAIL' AND severity = 'critical'",
)
def dq_gate(spark, sf_dir):
    raw = landing(spark, sf_dir, dirty=True)
    return quality.blocking(quality.assess(raw, suite_for(raw), RUN)).select("check_name", "observed_value")


@query(
    "dq_missing_columns",
    f"""SELECT 'record' AS part, 'required_columns_exist FAIL arrest,year' AS line
    UNION ALL SELECT 'record', 'row_count_between_expected_range PASS ' || CAST(count(*) AS VARCHAR) FROM events
    UNION ALL SELECT 'report', line FROM (VALUES ('{quality.REPORT_TITLE}'), (''), ('Run ID: {RUN.run_id}'), (''),
      ('Logical Date: {RUN.logical_date}'), (''), ('Run Timestamp: {RUN.run_timestamp}'), (''),
      ('{quality.REPORT_MISSING}')) l(line)""",
)
def dq_missing_columns(spark, sf_dir):
    """The early end: the two records and the lines of the short report, as stored."""
    raw = landing(spark, sf_dir).drop("arrest", "year")
    zones = pipeline.Zones(shared_dir(spark, "missing_columns"))
    write_table(raw, zones.raw)
    try:
        pipeline.check_quality(spark, zones, RUN, MIN_ROWS, MAX_ROWS, fail_on_error=False, now=now())
    except MissingColumnsError:
        pass
    else:
        raise AssertionError("the check must end with an error")
    records = pipeline.read_history(spark, zones)
    lines = spark.read.text(zones.report).select(F.lit("report").alias("part"), F.col("value").alias("line"))
    found = records.select(F.lit("record").alias("part"), F.concat_ws(" ", "check_name", "status", "observed_value").alias("line"))
    return found.union(lines)


def _offending_sql(names: dict[str, str]) -> str:
    counts = ", ".join(f"count(*) FILTER ({text}) AS {name}" for name, text in names.items())
    return f"WITH landing AS ({landing_sql(dirty=True)}) SELECT count(*) AS total_rows, {counts} FROM landing"


@query("dq_counts_one_pass", _offending_sql(OFFENDS_SQL))
def dq_counts_one_pass(spark, sf_dir):
    raw = landing(spark, sf_dir, dirty=True)
    suite = suite_for(raw)
    offends = {c.name: c.offends for c in suite.checks if isinstance(c, quality.RowCheck)}
    return quality.count_offending(raw.withColumns(dict(suite.derived)), offends)


BLANK_COLUMNS = ("id", "date", "primary_type", "arrest", "district", "latitude", "longitude")


@query("dq_null_blank", _offending_sql({f"blank_{c}": BLANK(f'"{c}"') for c in BLANK_COLUMNS}))
def dq_null_blank(spark, sf_dir):
    raw = landing(spark, sf_dir, dirty=True)
    return quality.count_offending(raw, {f"blank_{c}": blank(c) for c in BLANK_COLUMNS})


@query(
    "dq_invalid_cast",
    _offending_sql(
        {
            "invalid_id": OFFENDS_SQL["invalid_id_count"],
            "invalid_district": f"(NOT {BLANK('district')} AND {BIGINT('district')} IS NULL)",
            "invalid_latitude": f"(NOT {BLANK('latitude')} AND {DOUBLE('latitude')} IS NULL)",
            "invalid_date": OFFENDS_SQL["invalid_date_count"],
        }
    ),
)
def dq_invalid_cast(spark, sf_dir):
    raw = landing(spark, sf_dir, dirty=True)
    return quality.count_offending(
        raw,
        {
            "invalid_id": uncastable("id", "bigint"),
            "invalid_district": uncastable("district", "int"),
            "invalid_latitude": uncastable("latitude", "double"),
            "invalid_date": ~blank("date") & parse_timestamp_any("date").isNull(),
        },
    )


@query(
    "dq_future_date",
    """SELECT count(*) AS total_rows, 0::BIGINT AS unreadable,
    count(*) FILTER (l_shipdate > TIMESTAMP '1999-06-01') AS future FROM lineitem""",
)
def dq_future_date(spark, sf_dir):
    """The two time checks of the suite, on ship dates as text and with a fixed present."""
    moment = F.to_timestamp(F.lit("1999-06-01 00:00:00"))
    derived, checks = quality.time_checks("unreadable", "future", "shipped", "Ship date", moment)
    lines = table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped"))
    return quality.count_offending(lines.withColumns(derived), {c.name: c.offends for c in checks})


@query(
    "dq_range",
    """SELECT count(*) AS total_rows, count(*) FILTER (c_acctbal < 0 OR c_acctbal > 9000) AS outside_balance,
    count(*) FILTER (c_nationkey < 2 OR c_nationkey > 20) AS outside_nation FROM customer""",
)
def dq_range(spark, sf_dir):
    return quality.count_offending(
        table(spark, sf_dir, "customer"),
        {"outside_balance": outside("c_acctbal", 0, 9000), "outside_nation": outside("c_nationkey", 2, 20)},
    )


@query(
    "dq_duplicates",
    """SELECT count(*) AS duplicate_groups, CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (
      SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def dq_duplicates(spark, sf_dir):
    return quality.count_duplicates(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "dq_row_count_range",
    f"""SELECT check_name, status, observed_value, rule FROM ({records_sql(dirty=False)})
    WHERE check_name = 'row_count_between_expected_range'""",
)
def dq_row_count_range(spark, sf_dir):
    raw = landing(spark, sf_dir)
    records = quality.assess(raw, suite_for(raw), RUN)
    wanted = F.col("check_name") == "row_count_between_expected_range"
    return records.filter(wanted).select("check_name", "status", "observed_value", "rule")
