"""The incident model: column contract, types, lookup, quality rules and star schema."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.functions import (
    column_or_null,
    date_parts,
    daypart,
    flag,
    parse_timestamp_any,
    safe_cast,
    time_parts,
)
from casebook.operators import clean, quality, star, summary
from casebook.sources import lookup_table

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

LANDING_COLUMNS = (
    "id",
    "case_number",
    "date",
    "block",
    "iucr",
    "primary_type",
    "description",
    "location_description",
    "arrest",
    "domestic",
    "beat",
    "district",
    "ward",
    "community_area",
    "fbi_code",
    "x_coordinate",
    "y_coordinate",
    "year",
    "updated_on",
    "latitude",
    "longitude",
    "location",
)

REQUIRED_COLUMNS = ("id", "case_number", "date", "primary_type", "arrest", "domestic", "year")

CLEAN_TYPES = {
    "id": "bigint",
    "year": "int",
    "district": "int",
    "ward": "int",
    "community_area": "int",
    "latitude": "double",
    "longitude": "double",
}

CATEGORY_OF_TYPE = {
    "THEFT": "Property Crime",
    "BURGLARY": "Property Crime",
    "ROBBERY": "Property Crime",
    "MOTOR VEHICLE THEFT": "Property Crime",
    "BATTERY": "Violent Crime",
    "ASSAULT": "Violent Crime",
    "CRIMINAL SEXUAL ASSAULT": "Violent Crime",
    "HOMICIDE": "Violent Crime",
    "NARCOTICS": "Drug Crime",
    "CRIMINAL DAMAGE": "Property Damage",
    "DECEPTIVE PRACTICE": "Fraud",
}
OTHER_CATEGORY = "Other"

MIN_RAW_ROWS = 200_000
MAX_RAW_ROWS = 400_000
LATITUDE_RANGE = (41.0, 42.1)
LONGITUDE_RANGE = (-88.0, -87.0)

# Names of the checks on rows and ids, in the order of their records.
NULL_ID_CHECK = "null_id_count"
INVALID_ID_CHECK = "invalid_id_count"
DUPLICATE_IDS_CHECK = "duplicate_id_group_count"
DUPLICATE_ROWS_CHECK = "duplicate_record_count"
NULL_DATE_CHECK = "null_date_count"
INVALID_DATE_CHECK = "invalid_date_count"
FUTURE_DATE_CHECK = "future_date_count"
NULL_TYPE_CHECK = "null_primary_type_count"
LATITUDE_CHECK = "invalid_latitude_count"
LONGITUDE_CHECK = "invalid_longitude_count"

# Names of the checks on changes alone.
VERSIONED_IDS_CHECK = "versioned_id_count"
SUPERSEDED_ROWS_CHECK = "superseded_version_count"

# ---------------------------------------------------------------------------


def quality_suite(
    df: DataFrame,
    min_rows: int = MIN_RAW_ROWS,
    max_rows: int = MAX_RAW_ROWS,
    now: Column | None = None,
) -> quality.Suite:
    """The twelve checks of the raw zone. Coordinates are optional and only warn."""
    derived, (invalid_date, future_date) = quality.time_checks(
        INVALID_DATE_CHECK, FUTURE_DATE_CHECK, "date", "Date", now
    )
    latitude, longitude = column_or_null(df, "latitude"), column_or_null(df, "longitude")
    return quality.Suite(
        required=REQUIRED_COLUMNS,
        min_rows=min_rows,
        max_rows=max_rows,
        derived=derived,
        checks=(
            quality.null_check(NULL_ID_CHECK, "id", "ID"),
            quality.cast_check(INVALID_ID_CHECK, "id", "bigint", "ID"),
            quality.key_check(DUPLICATE_IDS_CHECK, DUPLICATE_ROWS_CHECK, "id", "bigint", "ID"),
            quality.null_check(NULL_DATE_CHECK, "date", "Date"),
            invalid_date,
            future_date,
            quality.null_check(NULL_TYPE_CHECK, "primary_type", "Primary type"),
            quality.range_check(LATITUDE_CHECK, latitude, *LATITUDE_RANGE, "Latitude"),
            quality.range_check(LONGITUDE_CHECK, longitude, *LONGITUDE_RANGE, "Longitude"),
        ),
    )


def changes_suite(
    df: DataFrame,
    min_rows: int = MIN_RAW_ROWS,
    max_rows: int = MAX_RAW_ROWS,
    now: Column | None = None,
) -> quality.Suite:
    """The checks for rows that change others. An id may come in several versions, each with its own time of update.

    Rows of one id and one time of update are duplicates; ids with several versions are counted apart, and only warn.
    """
    suite = quality_suite(df, min_rows, max_rows, now)
    updated = F.coalesce(parse_timestamp_any(column_or_null(df, "updated_on")).cast("string"), F.lit(""))
    checks = [replace(c, also=(updated,)) if isinstance(c, quality.KeyCheck) else c for c in suite.checks]
    versions = quality.KeyCheck(
        safe_cast("id", "bigint"),
        VERSIONED_IDS_CHECK,
        SUPERSEDED_ROWS_CHECK,
        "IDs should come in one version",
        "No version should be superseded by another",
        "IDs with several times of update",
        "Versions beyond the first of each ID",
        per=updated,
        severity=quality.WARNING,
    )
    return replace(suite, checks=(*checks, versions))


def clean_detail(
    spark: SparkSession,
    raw: DataFrame,
    category_of_type: Mapping[str, str] = CATEGORY_OF_TYPE,
) -> DataFrame:
    """Typed, one row per id, with time stamps and category. Only rows without a valid id are dropped."""
    typed = clean.keep_valid_keys(clean.retype(raw, CLEAN_TYPES), "id")
    dated = typed.withColumn("updated_timestamp", parse_timestamp_any("updated_on"))
    single = clean.latest_per_key(dated, ["id"], "updated_timestamp")
    timed = single.withColumn("crime_timestamp", parse_timestamp_any("date"))
    timed = timed.withColumn("crime_date", F.to_date("crime_timestamp"))
    lookup = lookup_table(spark, category_of_type, "primary_type", "crime_category")
    return clean.attach_category(timed, lookup, "primary_type", "crime_category", OTHER_CATEGORY)


SUMMARY_GRAIN = ("crime_date", "primary_type", "crime_category")
SUMMARY_FLAGS = {"total_arrests": "arrest", "domestic_crimes": "domestic"}
SUMMARY_MEASURES = ("total_crimes", *SUMMARY_FLAGS)


def summary_flags() -> dict[str, Column]:
    return {name: flag(column) for name, column in SUMMARY_FLAGS.items()}


def daily_summary(detail: DataFrame) -> DataFrame:
    """Counts per date, type and category, with the trailing mean over seven rows of a type."""
    daily = summary.summarize(detail, SUMMARY_GRAIN, summary_flags(), "total_crimes")
    return summary.rolling_avg_rows(
        daily, "total_crimes", ["primary_type"], "crime_date", "seven_day_rolling_avg"
    )


# Star schema


def _all_minutes(detail: DataFrame) -> DataFrame:
    minutes = detail.sparkSession.range(24 * 60)
    return minutes.select(
        F.expr("CAST(id DIV 60 AS INT)").alias("hour"), F.expr("CAST(id % 60 AS INT)").alias("minute")
    )


def dimensions() -> dict[str, star.Dimension]:
    """The seven dimensions over the clean detail, by table name."""
    moment = F.col("crime_timestamp")
    dims = (
        star.Dimension(
            "dim_date", "date_key", star.columns("crime_date"), attributes=date_parts(F.col("crime_date"))
        ),
        star.Dimension(
            "dim_time_of_day",
            "time_of_day_key",
            time_parts(moment),
            attributes={"daypart": daypart(F.col("hour"))},
            members=_all_minutes,
        ),
        star.Dimension(
            "dim_crime_type",
            "crime_type_key",
            star.columns("iucr", "primary_type", "description", "fbi_code", "crime_category"),
        ),
        star.Dimension("dim_police_area", "police_area_key", star.columns("beat", "district")),
        star.Dimension("dim_civic_area", "civic_area_key", star.columns("ward", "community_area")),
        star.Dimension("dim_location_type", "location_type_key", star.columns("location_description")),
        star.Dimension(
            "dim_location_point",
            "location_point_key",
            {
                "block": F.col("block"),
                # Grouping takes -0.0 for 0.0; adding zero makes the fact's key do the same.
                "latitude": F.col("latitude") + F.lit(0.0),
                "longitude": F.col("longitude") + F.lit(0.0),
                **star.columns("x_coordinate", "y_coordinate"),
            },
        ),
    )
    return {dim.name: dim for dim in dims}


def incident_fact(detail: DataFrame) -> DataFrame:
    """One row per incident with seven foreign keys and typed flags."""
    carried = {
        **star.columns("id", "case_number", "crime_timestamp"),
        "arrest": safe_cast("arrest", "boolean"),
        "domestic": safe_cast("domestic", "boolean"),
        "updated_on": F.col("updated_timestamp"),
    }
    return star.build_fact(detail, list(dimensions().values()), carried)


def counts_by_key(detail: DataFrame) -> DataFrame:
    """Daily counts at the grain of date key and type key."""
    return star.summarize_by_key(
        detail,
        day="crime_date",
        kind=dimensions()["dim_crime_type"],
        date_key="date_key",
        shown=("primary_type", "crime_category"),
        flags=summary_flags(),
        total="total_crimes",
    )


def daily_summary_by_key(detail: DataFrame) -> DataFrame:
    """The counts with the trailing mean per type key."""
    return summary.rolling_avg_rows(
        counts_by_key(detail), "total_crimes", ["crime_type_key"], "crime_date", "seven_day_rolling_avg"
    )
