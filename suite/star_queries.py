"""Star schema built from the clean detail of the landing rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook import shared_dir
from casebook.operators import star
from casebook.plans import incidents
from casebook.sinks import write_table, write_tables
from casebook.sources import read_table
from suite.clean_queries import as_text, as_text_sql, key_sql
from suite.landing import BOOLEAN, detail_ctes, flag_sql, landing
from suite.registry import query

DAYPART_SQL = (
    "CASE WHEN hour >= 18 THEN 'evening' WHEN hour >= 12 THEN 'afternoon'"
    " WHEN hour >= 6 THEN 'morning' WHEN hour >= 0 THEN 'night' END"
)
TYPE_COLUMNS = ("iucr", "primary_type", "description", "fbi_code", "crime_category")
POINT_COLUMNS = ("block", "latitude", "longitude", "x_coordinate", "y_coordinate")


def detail(spark, sf_dir, dirty=False):
    return incidents.clean_detail(spark, landing(spark, sf_dir, dirty))


_built: dict[tuple, str] = {}


def built(spark, label: str, build, *key) -> str:
    """The folder that ``build`` fills. Built once per session, so that a query's time is its own; ``star_build`` times it."""
    key = (spark.sparkContext.applicationId, label, *key)
    if key not in _built:
        path = shared_dir(spark, label)
        build(path)
        _built[key] = path
    return _built[key]


def stored_detail(spark, sf_dir, dirty=False):
    """The clean detail as a table."""
    path = built(spark, "detail", lambda at: write_table(detail(spark, sf_dir, dirty), at), sf_dir, dirty)
    return read_table(spark, path)


def dimension_sql(key: str, columns: tuple[str, ...], dirty: bool = False) -> str:
    names = ", ".join(columns)
    return f"{detail_ctes(dirty)} SELECT DISTINCT {key_sql(*columns)} AS {key}, {names} FROM detail"


def dimension(name: str, dirty: bool = False):
    def run(spark, sf_dir):
        return star.build_dimension(stored_detail(spark, sf_dir, dirty), incidents.dimensions()[name])

    return run


@query(
    "dim_date",
    f"""{detail_ctes(dirty=True)} SELECT DISTINCT {key_sql('crime_date')} AS date_key, crime_date,
    CAST(year(crime_date) AS INTEGER) AS year, CAST(month(crime_date) AS INTEGER) AS month,
    CAST(day(crime_date) AS INTEGER) AS day, dayname(crime_date) AS weekday FROM detail""",
)
def dim_date(spark, sf_dir):
    return dimension("dim_date", dirty=True)(spark, sf_dir)


@query(
    "dim_time_of_day",
    f"""{detail_ctes(dirty=True)}, minutes AS (
      SELECT CAST(m // 60 AS INTEGER) AS hour, CAST(m % 60 AS INTEGER) AS minute FROM range(1440) r(m)
      UNION SELECT CAST(hour(crime_timestamp) AS INTEGER), CAST(minute(crime_timestamp) AS INTEGER) FROM detail),
    used AS (SELECT CAST(hour(crime_timestamp) AS INTEGER) AS hour, CAST(minute(crime_timestamp) AS INTEGER) AS minute,
      count(*) AS incidents FROM detail GROUP BY 1, 2)
    SELECT {key_sql('minutes.hour', 'minutes.minute')} AS time_of_day_key, minutes.hour, minutes.minute,
      {DAYPART_SQL.replace('hour', 'minutes.hour')} AS daypart, COALESCE(incidents, 0) AS incidents
    FROM minutes LEFT JOIN used ON minutes.hour IS NOT DISTINCT FROM used.hour
      AND minutes.minute IS NOT DISTINCT FROM used.minute""",
)
def dim_time_of_day(spark, sf_dir):
    """All minutes of a day, with the number of incidents that point at each."""
    rows = stored_detail(spark, sf_dir, dirty=True)
    dim = incidents.dimensions()["dim_time_of_day"]
    used = rows.groupBy(dim.key_on_detail()).agg(F.count(F.lit(1)).alias("incidents"))
    members = star.build_dimension(rows, dim).join(used, on=dim.key, how="left")
    return members.withColumn("incidents", F.coalesce("incidents", F.lit(0)))


query("dim_type", dimension_sql("crime_type_key", TYPE_COLUMNS))(dimension("dim_crime_type"))
query("dim_pair", dimension_sql("police_area_key", ("beat", "district"), dirty=True))(
    dimension("dim_police_area", dirty=True)
)
query("dim_pair_civic", dimension_sql("civic_area_key", ("ward", "community_area")))(dimension("dim_civic_area"))
query("dim_single_nullable", dimension_sql("location_type_key", ("location_description",)))(
    dimension("dim_location_type")
)
query("dim_point", dimension_sql("location_point_key", POINT_COLUMNS))(dimension("dim_location_point"))


FOREIGN_KEYS_SQL = ", ".join(
    [
        f"{key_sql('crime_date')} AS date_key",
        f"{key_sql('hour(crime_timestamp)', 'minute(crime_timestamp)')} AS time_of_day_key",
        f"{key_sql(*TYPE_COLUMNS)} AS crime_type_key",
        f"{key_sql('beat', 'district')} AS police_area_key",
        f"{key_sql('ward', 'community_area')} AS civic_area_key",
        f"{key_sql('location_description')} AS location_type_key",
        f"{key_sql(*POINT_COLUMNS)} AS location_point_key",
    ]
)
FACT_SQL = f"""SELECT id, case_number, {as_text_sql('crime_timestamp')} AS crime_timestamp,
    {BOOLEAN('arrest')} AS arrest, {BOOLEAN('domestic')} AS domestic,
    {as_text_sql('updated_timestamp')} AS updated_on, {FOREIGN_KEYS_SQL} FROM detail"""


@query("fact_incident", f"{detail_ctes()} {FACT_SQL}")
def fact_incident(spark, sf_dir):
    fact = incidents.incident_fact(detail(spark, sf_dir))
    return fact.withColumns({c: as_text(F.col(c)) for c in ("crime_timestamp", "updated_on")})


def build(rows, base) -> dict[str, int]:
    """All dimensions, the fact and its daily summary below ``base``; rows written per table."""
    frames = {n: star.build_dimension(rows, d) for n, d in incidents.dimensions().items()}
    frames |= {"fact": incidents.incident_fact(rows), "agg": incidents.daily_summary_by_key(rows)}
    counts = write_tables({f"{base}/{n}": frame for n, frame in frames.items()})
    return {n: counts[f"{base}/{n}"] for n in frames}


def stored_star(spark, sf_dir, names=None, dirty=False, fact="fact"):
    """Fact and dimensions as tables: their sizes are known, so Spark picks each join by size."""
    base = built(spark, "star", lambda at: build(stored_detail(spark, sf_dir, dirty), at), sf_dir, dirty)
    dims = {n: d for n, d in incidents.dimensions().items() if names is None or n in names}
    return read_table(spark, f"{base}/{fact}"), {d.key: read_table(spark, f"{base}/{n}") for n, d in dims.items()}


def members_sql(columns: tuple[str, ...]) -> str:
    return f"SELECT count(*) FROM (SELECT DISTINCT {', '.join(columns)} FROM detail)"


BUILT_SQL = {
    "dim_date": members_sql(("crime_date",)),
    "dim_time_of_day": "SELECT 1440 + CAST(bool_or(crime_timestamp IS NULL) AS INTEGER) FROM detail",
    "dim_crime_type": members_sql(TYPE_COLUMNS),
    "dim_police_area": members_sql(("beat", "district")),
    "dim_civic_area": members_sql(("ward", "community_area")),
    "dim_location_type": members_sql(("location_description",)),
    "dim_location_point": members_sql(POINT_COLUMNS),
    "fact": "SELECT count(*) FROM detail",
    "agg": members_sql(("crime_date", *TYPE_COLUMNS)),
}


@query(
    "star_build",
    f"{detail_ctes(dirty=True)} "
    + " UNION ALL ".join(f"SELECT '{n}' AS table_name, CAST(({sql}) AS BIGINT) AS row_count" for n, sql in BUILT_SQL.items()),
)
def star_build(spark, sf_dir):
    """Cleans the landing rows and writes the whole star anew; rows per table."""
    path = shared_dir(spark, "star_build")
    write_table(detail(spark, sf_dir, dirty=True), f"{path}/detail")
    counts = build(read_table(spark, f"{path}/detail"), path)
    return spark.createDataFrame(list(counts.items()), "table_name STRING, row_count BIGINT")


@query(
    "star_join",
    f"""{detail_ctes()} SELECT id, case_number, crime_date, CAST(hour(crime_timestamp) AS INTEGER) AS hour,
    CAST(minute(crime_timestamp) AS INTEGER) AS minute, iucr, primary_type, description, fbi_code, crime_category,
    beat, district, ward, community_area, location_description, block, latitude, longitude, x_coordinate, y_coordinate,
    {BOOLEAN('arrest')} AS arrest, {BOOLEAN('domestic')} AS domestic FROM detail""",
)
def star_join(spark, sf_dir):
    fact, tables = stored_star(spark, sf_dir)
    return star.denormalize(fact, tables).select(
        "id", "case_number", "crime_date", "hour", "minute", *TYPE_COLUMNS, "beat", "district", "ward",
        "community_area", "location_description", *POINT_COLUMNS, "arrest", "domestic",
    )


@query(
    "star_totals",
    f"""{detail_ctes()}, timed AS (SELECT *, hour(crime_timestamp) AS hour FROM detail)
    SELECT dayname(crime_date) AS weekday, {DAYPART_SQL} AS daypart, district, crime_category,
    count(*) AS total_crimes, count(*) FILTER ({flag_sql('arrest')}) AS total_arrests FROM timed GROUP BY 1, 2, 3, 4""",
)
def star_totals(spark, sf_dir):
    names = ("dim_date", "dim_time_of_day", "dim_police_area", "dim_crime_type")
    fact, tables = stored_star(spark, sf_dir, names)
    measures = {"total_crimes": F.count(F.lit(1)), "total_arrests": F.count_if("arrest")}
    return star.star_totals(fact, tables, ["weekday", "daypart", "district", "crime_category"], measures)


@query(
    "star_totals_large",
    f"""{detail_ctes()} SELECT crime_category, block, latitude, longitude, count(*) AS total_crimes,
    count(*) FILTER ({flag_sql('arrest')}) AS total_arrests FROM detail GROUP BY 1, 2, 3, 4""",
)
def star_totals_large(spark, sf_dir):
    """By an attribute of the one dimension that grows with the data."""
    fact, tables = stored_star(spark, sf_dir, ("dim_crime_type", "dim_location_point"))
    measures = {"total_crimes": F.count(F.lit(1)), "total_arrests": F.count_if("arrest")}
    by = ["crime_category", "block", "latitude", "longitude"]
    return star.star_totals(fact, tables, by, measures, large=["location_point_key"])


@query(
    "star_join_summary",
    f"""{detail_ctes(dirty=True)} SELECT dayname(crime_date) AS weekday, CAST(month(crime_date) AS INTEGER) AS month, iucr,
    count(*) AS total_crimes, count(*) FILTER ({flag_sql('arrest')}) AS total_arrests,
    count(*) FILTER ({flag_sql('domestic')}) AS domestic_crimes FROM detail GROUP BY ALL""",
)
def star_join_summary(spark, sf_dir):
    """The stored daily summary by key, with the dimensions its two keys point at."""
    daily, tables = stored_star(spark, sf_dir, ("dim_date", "dim_crime_type"), dirty=True, fact="agg")
    measures = {name: F.sum(name) for name in incidents.SUMMARY_MEASURES}
    return star.star_totals(daily, tables, ["weekday", "month", "iucr"], measures)


# Members that are taken out of their dimensions, so that incidents refer to what is not there.
LOST_MEMBERS = {
    "date_key": ("crime_date", "crime_date IS NULL OR day(crime_date) = 3"),
    "crime_type_key": (", ".join(TYPE_COLUMNS), "primary_type = 'THEFT'"),
    "police_area_key": ("beat, district", "district IS NULL"),
    "location_type_key": ("location_description", "location_description IS NULL OR location_description = 'ALLEY'"),
}
WHOLE_DIMENSIONS = ("time_of_day_key", "civic_area_key", "location_point_key")


@query(
    "fk_orphans",
    detail_ctes(dirty=True)
    + " UNION ALL ".join(
        f"""SELECT '{key}' AS foreign_key, (SELECT count(*) FROM detail) AS fact_rows,
        (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM detail WHERE {lost})) AS orphan_keys,
        (SELECT count(*) FROM detail WHERE {lost}) AS orphan_rows"""
        for key, (columns, lost) in {**LOST_MEMBERS, **{k: ("id", "false") for k in WHOLE_DIMENSIONS}}.items()
    ),
)
def fk_orphans(spark, sf_dir):
    fact, tables = stored_star(spark, sf_dir, dirty=True)
    lost = {key: tables[key].where(F.expr(f"NOT coalesce({condition}, false)")) for key, (_, condition) in LOST_MEMBERS.items()}
    return star.foreign_key_orphans(fact, tables | lost)


@query(
    "agg_daily_by_key",
    f"""{detail_ctes(dirty=True)}, daily AS (
      SELECT {key_sql('crime_date')} AS date_key, {key_sql(*TYPE_COLUMNS)} AS crime_type_key, crime_date, primary_type,
        crime_category, count(*) AS total_crimes, count(*) FILTER ({flag_sql('arrest')}) AS total_arrests,
        count(*) FILTER ({flag_sql('domestic')}) AS domestic_crimes FROM detail GROUP BY 1, 2, 3, 4, 5)
    SELECT *, avg(total_crimes) OVER (PARTITION BY crime_type_key ORDER BY crime_date NULLS FIRST
      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS seven_day_rolling_avg FROM daily""",
)
def agg_daily_by_key(spark, sf_dir):
    return incidents.daily_summary_by_key(detail(spark, sf_dir, dirty=True))
