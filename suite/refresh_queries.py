"""A maintained store after two refreshes: changed and moved incidents, several versions of an id, new ids, old news."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook import shared_dir
from casebook.operators import profile, quality
from casebook.plans import maintained, pipeline
from suite.clean_queries import as_text, key_sql
from suite.landing import ANY_TIME, BIGINT, CATEGORY, TIME_FORMATS, TYPED, detail_ctes, expressions, flag_sql
from suite.quality_queries import MAX_ROWS, MIN_ROWS, OFFENDS_SQL, now
from suite.registry import query, table
from suite.report_queries import landed_rows
from suite.star_queries import FACT_SQL, POINT_COLUMNS, TYPE_COLUMNS, dimension_sql

NEW_ID = "CASE event_id % 5 WHEN 0 THEN CAST(event_id + 1000000000 AS STRING) ELSE CAST(event_id AS STRING) END"


def versions(dialect: str, batch: int) -> list[tuple[str, dict[str, str]]]:
    """Condition on the events and columns that differ, per version of an incident in the batch."""
    later = TIME_FORMATS[dialect]["iso"].format("(ts + INTERVAL '40' DAY)")
    when = "CASE WHEN event_id % 3 = 0 THEN '{}T00:00:00.000' ELSE '{}T00:00:00.000' END".format
    if batch == 1:
        return [
            ("event_id % 2 = 0", {"id": NEW_ID, "primary_type": "'ROBBERY'", "updated_on": when("2025-12-31", "1990-01-01")}),
            ("event_id % 8 = 0", {"id": NEW_ID, "primary_type": "'ASSAULT'", "updated_on": when("2026-06-30", "1989-01-01")}),
        ]
    return [("event_id % 7 = 0", {"date": later, "arrest": "'true'", "updated_on": "'2026-12-31T00:00:00.000'"})]


def base_columns(dialect: str) -> dict[str, str]:
    """The dirty landing rows; latitudes are clean, as the two engines write NaN differently in hashed text."""
    return {**expressions(dialect, dirty=True), "latitude": expressions(dialect, dirty=False)["latitude"]}


def select_sql(columns: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f'{text} AS "{name}"' for name, text in columns.items()) + " FROM events"


def selected(events, columns: dict[str, str]):
    return events.selectExpr(*[f"{text} AS `{name}`" for name, text in columns.items()])


def batch_rows(spark, sf_dir, batch: int):
    events, rows = table(spark, sf_dir, "events"), None
    for where, changed in versions("spark", batch):
        part = selected(events.where(where), {**expressions("spark", dirty=False), **changed})
        rows = part if rows is None else rows.union(part)
    return rows


def batch_sql(batch: int) -> str:
    columns = expressions("duckdb", dirty=False)
    return " UNION ALL ".join(f"{select_sql({**columns, **changed})} WHERE {where}" for where, changed in versions("duckdb", batch))


REFRESHED_CATEGORY = f"CASE primary_type WHEN 'ROBBERY' THEN 'Property Crime' WHEN 'ASSAULT' THEN 'Violent Crime' ELSE {CATEGORY} END"


def refreshed_ctes() -> str:
    """``before``, ``batch_1``, ``after_1``, ``batch_2`` and, as ``detail``, the detail after both batches."""
    newest = "row_number() OVER (PARTITION BY id ORDER BY updated_timestamp DESC NULLS LAST, change DESC) = 1"

    def batch(number: int) -> str:
        return f"""landed_{number} AS ({batch_sql(number)}), typed_{number} AS ({TYPED(f'landed_{number}')}),
        batch_{number} AS (SELECT *, CAST(crime_timestamp AS DATE) AS crime_date, {REFRESHED_CATEGORY} AS crime_category FROM typed_{number}
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_timestamp DESC NULLS LAST) = 1)"""

    def applied(before: str, number: int) -> str:
        return f"""SELECT * EXCLUDE (change) FROM (SELECT 0 AS change, * FROM {before} UNION ALL SELECT 1, * FROM batch_{number})
          QUALIFY {newest}"""

    return f"""{detail_ctes(rows=select_sql(base_columns('duckdb')), name='before')}, {batch(1)}, after_1 AS ({applied('before', 1)}),
    {batch(2)}, detail AS ({applied('after_1', 2)})"""


def refresh_all(spark, sf_dir, root: str) -> list[dict[str, int]]:
    """Full load of the dirty rows, the store, and both batches; what each batch did."""
    zones = pipeline.Zones(root)
    run = quality.Run("load", "2026-01-01", "2026-01-01T00:00:00+00:00", "incidents")
    pipeline.run_pipeline(spark, landed_rows(spark, selected(table(spark, sf_dir, "events"), base_columns("spark")), "gzip"), zones, run, MIN_ROWS, MAX_ROWS, False, now())
    maintained.create(spark, zones)
    done = []
    for batch in (1, 2):
        run = quality.Run(f"batch {batch}", "2026-01-01", "2026-01-01T00:00:00+00:00", "incidents")
        landed = landed_rows(spark, batch_rows(spark, sf_dir, batch), "gzip")
        done.append(maintained.refresh(spark, zones, landed, run, MIN_ROWS, MAX_ROWS, True, now()))
    return done


def refreshed(spark, sf_dir) -> pipeline.Zones:
    """The store after both batches, built for each query: its figures do not depend on what ran before in the session."""
    root = shared_dir(spark, "refreshed")
    refresh_all(spark, sf_dir, root)
    return pipeline.Zones(root)


def swept(spark, sf_dir) -> pipeline.Zones:
    zones = refreshed(spark, sf_dir)
    maintained.sweep(spark, zones)
    return zones


def outcome_sql(batch: int, before: str) -> str:
    return f"""SELECT {batch} AS batch, CASE WHEN b.id IS NULL THEN 'inserted'
      WHEN b.updated_timestamp IS NULL OR n.updated_timestamp >= b.updated_timestamp THEN 'updated' ELSE 'stale' END AS outcome,
      count(*) AS changes FROM batch_{batch} n LEFT JOIN {before} b ON b.id = n.id GROUP BY ALL"""


@query("refresh_outcomes", f"{refreshed_ctes()} {outcome_sql(1, 'before')} UNION ALL {outcome_sql(2, 'after_1')}")
def refresh_outcomes(spark, sf_dir):
    """Builds the store, refreshes it twice, and tells what became of the changes."""
    done = refresh_all(spark, sf_dir, shared_dir(spark, "refresh_outcomes"))
    rows = [
        (batch, name.removesuffix("_changes"), n)
        for batch, counts in enumerate(done, 1)
        for name, n in counts.items()
        if name.endswith("_changes") and n
    ]
    return spark.createDataFrame(rows, "batch INT, outcome STRING, changes BIGINT")


@query(
    "refresh_detail",
    f"""{refreshed_ctes()} SELECT id, case_number, strftime(crime_timestamp, '%Y-%m-%d %H:%M:%S.%g') AS moment, crime_date,
    primary_type, crime_category, arrest, domestic, district, strftime(updated_timestamp, '%Y-%m-%d %H:%M:%S.%g') AS updated FROM detail""",
)
def refresh_detail(spark, sf_dir):
    rows = maintained.read(spark, refreshed(spark, sf_dir), "detail")
    moments = as_text(F.col("crime_timestamp")).alias("moment"), as_text(F.col("updated_timestamp")).alias("updated")
    return rows.select("id", "case_number", moments[0], "crime_date", "primary_type", "crime_category", "arrest", "domestic", "district", moments[1])


AVERAGE_SQL = """avg(total_crimes) OVER (PARTITION BY {} ORDER BY crime_date NULLS FIRST
      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS seven_day_rolling_avg""".format
COUNTS_SQL = f"""count(*) AS total_crimes, count(*) FILTER ({flag_sql('arrest')}) AS total_arrests,
      count(*) FILTER ({flag_sql('domestic')}) AS domestic_crimes"""


@query(
    "refresh_daily",
    f"""{refreshed_ctes()}, daily AS (SELECT crime_date, CAST(year(crime_date) AS INTEGER) AS year, CAST(month(crime_date) AS INTEGER) AS month,
      primary_type, crime_category, {COUNTS_SQL} FROM detail GROUP BY ALL)
    SELECT *, {AVERAGE_SQL('primary_type')} FROM daily""",
)
def refresh_daily(spark, sf_dir):
    return maintained.read_daily(spark, refreshed(spark, sf_dir))


@query(
    "refresh_by_key",
    f"""{refreshed_ctes()}, daily AS (SELECT {key_sql('crime_date')} AS date_key, {key_sql(*TYPE_COLUMNS)} AS crime_type_key, crime_date,
      primary_type, crime_category, {COUNTS_SQL} FROM detail GROUP BY ALL)
    SELECT *, {AVERAGE_SQL('crime_type_key')} FROM daily""",
)
def refresh_by_key(spark, sf_dir):
    return maintained.read(spark, refreshed(spark, sf_dir), "agg_daily_crime_summary")


@query("refresh_fact", f"{refreshed_ctes()} {FACT_SQL}")
def refresh_fact(spark, sf_dir):
    fact = maintained.read(spark, refreshed(spark, sf_dir), "fact_crime_incident")
    return fact.withColumns({c: as_text(F.col(c)) for c in ("crime_timestamp", "updated_on")})


def swept_sql(key: str, columns: tuple[str, ...]) -> str:
    return dimension_sql(key, columns, dirty=True).replace(detail_ctes(dirty=True), refreshed_ctes())


@query("refresh_dim_type", swept_sql("crime_type_key", TYPE_COLUMNS))
def refresh_dim_type(spark, sf_dir):
    return maintained.read(spark, swept(spark, sf_dir), "dim_crime_type")


@query("refresh_dim_point", swept_sql("location_point_key", POINT_COLUMNS))
def refresh_dim_point(spark, sf_dir):
    return maintained.read(spark, swept(spark, sf_dir), "dim_location_point")


PROFILED_DAYS = ("2024-01-10", "2024-02-20")


@query(
    "refresh_profile",
    f"{refreshed_ctes()} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) FILTER ({c} IS NULL) AS null_count, true AS within_bound
        FROM detail WHERE crime_date BETWEEN DATE '{PROFILED_DAYS[0]}' AND DATE '{PROFILED_DAYS[1]}'"""
        for c in maintained.PROFILED
    ),
)
def refresh_profile(spark, sf_dir):
    """A range of days from stored sketches, held against exact counts: six standard errors are allowed."""
    zones = refreshed(spark, sf_dir)
    found = maintained.profile_of(spark, zones, *PROFILED_DAYS)
    days = [F.lit(d).cast("date") for d in PROFILED_DAYS]
    detail = maintained.read(spark, zones, "detail").where(F.col("crime_date").between(*days))
    exact = profile.distinct_profile(detail, maintained.PROFILED).withColumnRenamed("distinct_count", "exact")
    off = F.abs(F.col("distinct_count") - F.col("exact")) <= 6 * 1.04 / 64 * F.col("exact")
    return found.join(exact, "column_name").select("column_name", "total_rows", "null_count", off.alias("within_bound"))


def change_records_sql() -> str:
    counts = ", ".join(f"count(*) FILTER ({text}) AS {name}" for name, text in OFFENDS_SQL.items())
    updated = f"COALESCE({ANY_TIME('updated_on')}, TIMESTAMP '0001-01-01')"
    row = "SELECT '{0}' AS check_name, CASE WHEN {1} = 0 THEN 'PASS' ELSE '{2}' END AS status, CAST({1} AS VARCHAR) AS observed_value FROM {3}".format
    warned = {"invalid_latitude_count", "invalid_longitude_count"}
    rows = [
        "SELECT 'required_columns_exist', 'PASS', 'none'",
        "SELECT 'row_count_between_expected_range', 'PASS', CAST(total AS VARCHAR) FROM counted",
        *[row(name, name, "WARN" if name in warned else "FAIL", "counted") for name in OFFENDS_SQL],
        row("duplicate_id_group_count", "groups", "FAIL", "duplicated"),
        row("duplicate_record_count", "extra", "FAIL", "duplicated"),
        row("versioned_id_count", "groups", "WARN", "versioned"),
        row("superseded_version_count", "extra", "WARN", "versioned"),
    ]
    beyond = "SELECT count(*) AS groups, CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS extra FROM ({}) WHERE n > 1".format
    duplicated = beyond(f"SELECT count(*) AS n FROM landing WHERE {BIGINT('id')} IS NOT NULL GROUP BY {BIGINT('id')}, {updated}")
    versioned = beyond(f"SELECT count(DISTINCT {updated}) AS n FROM landing WHERE {BIGINT('id')} IS NOT NULL GROUP BY {BIGINT('id')}")
    return f"""WITH landing AS ({batch_sql(1)}), counted AS (SELECT count(*) AS total, {counts} FROM landing),
    duplicated AS ({duplicated}), versioned AS ({versioned})
    SELECT * FROM ({' UNION ALL '.join(reversed(rows))})"""


@query("refresh_quality", change_records_sql())
def refresh_quality(spark, sf_dir):
    """The records of the first batch: duplicates are rows of one id and one time of update, versions are counted apart."""
    history = pipeline.read_history(spark, refreshed(spark, sf_dir))
    return history.where("run_id = 'batch 1'").select("check_name", "status", "observed_value")
