"""Incident-shaped landing rows, one per event, as text.

The expressions are plain SQL that Spark and DuckDB read alike, but for the two time
formats. The dirty form plants defects over the whole table: blank, malformed and
repeated ids, unreadable, spaced and future dates, odd flags and coordinates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from suite.registry import table

TIME_FORMATS = {
    "spark": {
        "iso": "concat(date_format({0}, 'yyyy-MM-dd'), 'T', date_format({0}, 'HH:mm:ss.SSS'))",
        "spaced": "date_format({0}, 'yyyy-MM-dd HH:mm:ss')",
        "day": "date_format({0}, 'yyyy-MM-dd')",
    },
    "duckdb": {
        "iso": "strftime({0}, '%Y-%m-%dT%H:%M:%S.%g')",
        "spaced": "strftime({0}, '%Y-%m-%d %H:%M:%S')",
        "day": "strftime({0}, '%Y-%m-%d')",
    },
}

CODE = "regexp_extract(props, '([0-9]+)', 1)"
TYPE = (
    "CASE event_type WHEN 'purchase' THEN 'THEFT' WHEN 'signup' THEN 'BATTERY' WHEN 'click' THEN 'NARCOTICS'"
    " WHEN 'view' THEN 'DECEPTIVE PRACTICE' ELSE 'ARSON' END"
)
LATITUDE = "CAST(41.600 + (user_id % 400) * 0.001 AS STRING)"
LONGITUDE = "CAST(-87.900 + (user_id % 700) * 0.001 AS STRING)"


def expressions(dialect: str, dirty: bool) -> dict[str, str]:
    iso = TIME_FORMATS[dialect]["iso"].format
    spaced = TIME_FORMATS[dialect]["spaced"].format
    day = TIME_FORMATS[dialect]["day"].format
    columns = {
        "id": "CAST(event_id AS STRING)",
        "case_number": "concat('C', CAST(event_id AS STRING))",
        "date": iso("ts"),
        "block": "concat('BLOCK ', CAST(user_id AS STRING))",
        "iucr": f"lpad({CODE}, 4, '0')",
        "primary_type": TYPE,
        "description": f"concat('CODE ', {CODE})",
        "location_description": (
            f"CASE CAST({CODE} AS INT) % 6 WHEN 0 THEN NULL WHEN 1 THEN 'STREET' WHEN 2 THEN 'APARTMENT'"
            " WHEN 3 THEN 'SIDEWALK, \"NORTH\"' WHEN 4 THEN 'ALLEY' ELSE 'PARKING LOT' END"
        ),
        "arrest": "CASE WHEN value > 60 THEN 'true' ELSE 'false' END",
        "domestic": "CASE WHEN user_id % 4 = 0 THEN 'true' ELSE 'false' END",
        "beat": "lpad(CAST(user_id % 275 AS STRING), 4, '0')",
        "district": "lpad(CAST(user_id % 23 AS STRING), 3, '0')",
        "ward": "CAST(user_id % 50 AS STRING)",
        "community_area": "CAST(user_id % 77 AS STRING)",
        "fbi_code": "upper(substr(event_type, 1, 2))",
        "x_coordinate": "CAST(1100000 + user_id * 37 AS STRING)",
        "y_coordinate": "CAST(1800000 + user_id * 41 AS STRING)",
        "year": "CAST(year(ts) AS STRING)",
        "updated_on": iso("(ts + INTERVAL '30' DAY)"),
        "latitude": LATITUDE,
        "longitude": LONGITUDE,
        "location": f"concat('(', {LATITUDE}, ', ', {LONGITUDE}, ')')",
    }
    if dirty:
        columns |= {
            "id": (
                "CASE event_id % 97 WHEN 1 THEN NULL WHEN 2 THEN '   ' WHEN 3 THEN 'abc'"
                " WHEN 4 THEN concat(CAST(event_id AS STRING), '.0') WHEN 5 THEN chr(9)"
                " WHEN 6 THEN concat(' ', CAST(event_id AS STRING), ' ')"
                " WHEN 7 THEN CAST(event_id - 7 AS STRING) WHEN 8 THEN CAST(event_id - 8 AS STRING)"
                " ELSE CAST(event_id AS STRING) END"
            ),
            "date": (
                "CASE event_id % 89 WHEN 1 THEN NULL WHEN 2 THEN 'not a date' WHEN 3 THEN '  '"
                f" WHEN 4 THEN {spaced('ts')} WHEN 5 THEN {spaced('ts')}"
                f" WHEN 6 THEN '2999-01-01T00:00:00.000' WHEN 7 THEN {day('ts')} ELSE {iso('ts')} END"
            ),
            "primary_type": (
                f"CASE event_id % 83 WHEN 1 THEN NULL WHEN 2 THEN '  ' WHEN 3 THEN lower({TYPE}) ELSE {TYPE} END"
            ),
            "arrest": (
                "CASE event_id % 79 WHEN 1 THEN 'Y' WHEN 2 THEN 'maybe' WHEN 3 THEN NULL WHEN 4 THEN ' T '"
                " ELSE CASE WHEN value > 60 THEN 'true' ELSE 'false' END END"
            ),
            "district": (
                "CASE event_id % 67 WHEN 1 THEN 'x' WHEN 2 THEN NULL"
                " ELSE lpad(CAST(user_id % 23 AS STRING), 3, '0') END"
            ),
            "latitude": (
                "CASE event_id % 73 WHEN 1 THEN 'NaN' WHEN 2 THEN 'north' WHEN 3 THEN '  ' WHEN 4 THEN '40.9'"
                f" WHEN 5 THEN NULL WHEN 6 THEN '42.1' WHEN 7 THEN '41.0' ELSE {LATITUDE} END"
            ),
            "longitude": (
                "CASE event_id % 71 WHEN 1 THEN 'east' WHEN 2 THEN '-88.0' WHEN 3 THEN '-86.5' WHEN 4 THEN NULL"
                f" WHEN 5 THEN '-87.0' ELSE {LONGITUDE} END"
            ),
        }
    return columns


def landing(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    columns = expressions("spark", dirty)
    return table(spark, sf_dir, "events").selectExpr(*[f"{text} AS `{name}`" for name, text in columns.items()])


def landing_sql(dirty: bool = False) -> str:
    columns = expressions("duckdb", dirty)
    return "SELECT " + ", ".join(f'{text} AS "{name}"' for name, text in columns.items()) + " FROM events"


# Spark's casts in DuckDB terms.
BIGINT = "CASE WHEN regexp_full_match(trim({0}), '[+-]?[0-9]+') THEN TRY_CAST(trim({0}) AS BIGINT) END".format
INT = "CASE WHEN regexp_full_match(trim({0}), '[+-]?[0-9]+') THEN TRY_CAST(trim({0}) AS INTEGER) END".format
DOUBLE = "TRY_CAST(trim({0}) AS DOUBLE)".format
BLANK = "({0} IS NULL OR trim({0}) = '')".format
ISO = "TRY_STRPTIME({0}, '%Y-%m-%dT%H:%M:%S.%g')".format
PATTERN_TIME = "COALESCE(TRY_STRPTIME({0}, '%Y-%m-%dT%H:%M:%S.%g'), TRY_STRPTIME({0}, '%Y-%m-%d %H:%M:%S'))".format
# A day alone is read by the free form only.
ANY_TIME = (
    "COALESCE(TRY_STRPTIME({0}, '%Y-%m-%dT%H:%M:%S.%g'), TRY_STRPTIME({0}, '%Y-%m-%d %H:%M:%S'),"
    " TRY_STRPTIME({0}, '%Y-%m-%d'))"
).format
BOOLEAN = (
    "CASE WHEN lower(trim({0})) IN ('true', 't', '1', 'yes', 'y') THEN true"
    " WHEN lower(trim({0})) IN ('false', 'f', '0', 'no', 'n') THEN false END"
).format


def flag_sql(column: str) -> str:
    return f"COALESCE({BOOLEAN(column)}, false)"


CATEGORY = (
    "CASE primary_type WHEN 'THEFT' THEN 'Property Crime' WHEN 'BATTERY' THEN 'Violent Crime'"
    " WHEN 'NARCOTICS' THEN 'Drug Crime' WHEN 'DECEPTIVE PRACTICE' THEN 'Fraud' ELSE 'Other' END"
)


# Landing rows with the types of the detail.
TYPED = f"""SELECT * REPLACE ({BIGINT('id')} AS id, {INT('year')} AS year, {INT('district')} AS district,
    {INT('ward')} AS ward, {INT('community_area')} AS community_area,
    {DOUBLE('latitude')} AS latitude, {DOUBLE('longitude')} AS longitude),
    {ANY_TIME('updated_on')} AS updated_timestamp, {ANY_TIME('date')} AS crime_timestamp
  FROM {{}}""".format


def detail_ctes(dirty: bool = False, rows: str | None = None, name: str = "detail") -> str:
    """``WITH landing, detail`` for a query on the clean detail, of the landing rows or of other ``rows``."""
    return f"""
WITH landing AS ({rows or landing_sql(dirty)}),
typed AS ({TYPED('landing')}),
{name} AS (
  SELECT *, CAST(crime_timestamp AS DATE) AS crime_date, {CATEGORY} AS crime_category
  FROM typed WHERE id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id
    ORDER BY updated_timestamp DESC NULLS LAST, case_number NULLS FIRST) = 1)"""
