"""Typing, de-duplication, lookup, summaries, trailing averages, profiles and refresh."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from casebook.functions import flag, parse_timestamp, parse_timestamp_any, path_token, safe_cast, surrogate_key
from casebook.operators import clean, merge, profile, summary
from casebook.plans import incidents
from casebook.sources import lookup_table
from suite.landing import (
    ANY_TIME,
    BIGINT,
    BOOLEAN,
    DOUBLE,
    INT,
    ISO,
    PATTERN_TIME,
    detail_ctes,
    flag_sql,
    landing,
    landing_sql,
)
from suite.registry import query, table


def as_text(moment):
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSS")


def as_text_sql(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S.%g')"


DIRTY = f"WITH landing AS ({landing_sql(dirty=True)})"


@query(
    "safe_cast",
    f"""{DIRTY} SELECT case_number, {BIGINT('id')} AS id, {INT('year')} AS year, {INT('district')} AS district,
    {INT('ward')} AS ward, CASE WHEN isnan({DOUBLE('latitude')}) THEN NULL ELSE {DOUBLE('latitude')} END AS latitude,
    {DOUBLE('longitude')} AS longitude, {BOOLEAN('arrest')} AS arrest FROM landing""",
)
def safe_cast_all(spark, sf_dir):
    return landing(spark, sf_dir, dirty=True).select(
        "case_number",
        safe_cast("id", "bigint").alias("id"),
        safe_cast("year", "int").alias("year"),
        safe_cast("district", "int").alias("district"),
        safe_cast("ward", "int").alias("ward"),
        F.nanvl(safe_cast("latitude", "double"), F.lit(None)).alias("latitude"),
        safe_cast("longitude", "double").alias("longitude"),
        safe_cast("arrest", "boolean").alias("arrest"),
    )


@query("parse_timestamp", f"{DIRTY} SELECT case_number, {as_text_sql(ISO('date'))} AS moment FROM landing")
def parse_timestamp_one(spark, sf_dir):
    return landing(spark, sf_dir, dirty=True).select("case_number", as_text(parse_timestamp("date")).alias("moment"))


@query("parse_timestamp_multi", f"{DIRTY} SELECT case_number, {as_text_sql(ANY_TIME('date'))} AS moment FROM landing")
def parse_timestamp_multi(spark, sf_dir):
    return landing(spark, sf_dir, dirty=True).select("case_number", as_text(parse_timestamp_any("date")).alias("moment"))


@query(
    "parse_timestamp_strict", f"{DIRTY} SELECT case_number, {as_text_sql(PATTERN_TIME('date'))} AS moment FROM landing"
)
def parse_timestamp_strict(spark, sf_dir):
    moment = parse_timestamp_any("date", free_form=False)
    return landing(spark, sf_dir, dirty=True).select("case_number", as_text(moment).alias("moment"))


@query(
    "safe_path_token",
    "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_.=-]', '_', 'g') AS token FROM pages",
)
def safe_path_token(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", path_token("url").alias("token"))


def key_sql(*columns: str) -> str:
    fields = [f"COALESCE(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns]
    return f"sha256({' || '.join(fields)})"


@query(
    "surrogate_key",
    f"""SELECT doc_id, {key_sql('lang', 'source', 'text')} AS document_key,
    {key_sql("NULLIF(lang, 'en')", 'source')} AS origin_key FROM documents""",
)
def surrogate_keys(spark, sf_dir):
    origin = surrogate_key(F.nullif("lang", F.lit("en")), "source")
    return table(spark, sf_dir, "documents").select(
        "doc_id", surrogate_key("lang", "source", "text").alias("document_key"), origin.alias("origin_key")
    )


@query(
    "filter_valid_key",
    f"{DIRTY} SELECT * FROM (SELECT case_number, {BIGINT('id')} AS id FROM landing) WHERE id IS NOT NULL",
)
def filter_valid_key(spark, sf_dir):
    typed = clean.retype(landing(spark, sf_dir, dirty=True), incidents.CLEAN_TYPES)
    return clean.keep_valid_keys(typed, "id").select("case_number", "id")


@query(
    "dedupe_by_key",
    """SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey,
      l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
)
def dedupe_by_key(spark, sf_dir):
    rows = clean.latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")
    return rows.withColumn("l_shipdate", F.to_date("l_shipdate"))


@query(
    "dedupe_repeated_only",
    """SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC NULLS LAST, l_orderkey, l_partkey,
      l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
)
def dedupe_repeated_only(spark, sf_dir):
    """Every key is repeated many times here, to the point of a few keys in all: a task leaves one row of each."""
    rows = clean.latest_per_key(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_shipdate")
    return rows.withColumn("l_shipdate", F.to_date("l_shipdate"))


EVENT_CATEGORY = {"purchase": "Commerce", "signup": "Commerce", "click": "Engagement", "view": "Engagement"}
EVENT_CATEGORY_SQL = (
    "CASE WHEN event_type IN ('purchase', 'signup') THEN 'Commerce'"
    " WHEN event_type IN ('click', 'view') THEN 'Engagement' ELSE 'Other' END"
)


@query("category_lookup", f"SELECT event_id, event_type, {EVENT_CATEGORY_SQL} AS category FROM events")
def category_lookup(spark, sf_dir):
    lookup = lookup_table(spark, EVENT_CATEGORY, "event_type", "category")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return clean.attach_category(events, lookup, "event_type", "category")


@query(
    "conditional_sums",
    f"""{DIRTY} SELECT primary_type, count(*) AS total_crimes,
    count(*) FILTER ({flag_sql('arrest')}) AS total_arrests,
    count(*) FILTER ({flag_sql('domestic')}) AS domestic_crimes FROM landing GROUP BY primary_type""",
)
def conditional_sums(spark, sf_dir):
    flags = {"total_arrests": flag("arrest"), "domestic_crimes": flag("domestic")}
    return summary.summarize(landing(spark, sf_dir, dirty=True), ["primary_type"], flags, "total_crimes")


@query(
    "clean_detail",
    f"""{detail_ctes(dirty=True)} SELECT id, case_number, primary_type, crime_category, crime_date, district,
    {as_text_sql('crime_timestamp')} AS crime_timestamp, {as_text_sql('updated_timestamp')} AS updated_timestamp
    FROM detail""",
)
def clean_detail(spark, sf_dir):
    detail = incidents.clean_detail(spark, landing(spark, sf_dir, dirty=True))
    return detail.select(
        "id",
        "case_number",
        "primary_type",
        "crime_category",
        "crime_date",
        "district",
        as_text("crime_timestamp").alias("crime_timestamp"),
        as_text("updated_timestamp").alias("updated_timestamp"),
    )


SUMMARY_SQL = f"""SELECT crime_date, primary_type, crime_category, count(*) AS total_crimes,
    count(*) FILTER ({flag_sql('arrest')}) AS total_arrests,
    count(*) FILTER ({flag_sql('domestic')}) AS domestic_crimes FROM detail GROUP BY ALL"""


@query(
    "daily_summary",
    f"""{detail_ctes(dirty=True)}, daily AS ({SUMMARY_SQL})
    SELECT *, avg(total_crimes) OVER (PARTITION BY primary_type ORDER BY crime_date NULLS FIRST
      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS seven_day_rolling_avg FROM daily""",
)
def daily_summary(spark, sf_dir):
    return incidents.daily_summary(incidents.clean_detail(spark, landing(spark, sf_dir, dirty=True)))


# Orders as incidents with gaps between days.
PRIORITY_CATEGORY = {"1-URGENT": "Rush", "2-HIGH": "Rush", "3-MEDIUM": "Standard", "4-NOT SPECIFIED": "Unknown"}
ORDERS_SQL = """SELECT CAST(o_orderdate AS DATE) AS crime_date, o_orderpriority AS primary_type,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Rush' WHEN o_orderpriority = '3-MEDIUM' THEN 'Standard'
      WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Unknown' ELSE 'Other' END AS crime_category,
    count(*) AS total_crimes, count(*) FILTER (o_orderstatus = 'F') AS total_arrests,
    count(*) FILTER (o_orderstatus = 'P') AS domestic_crimes FROM orders GROUP BY ALL"""


def orders_daily(spark, sf_dir):
    """Daily summary of the orders, categorised after the rows are summed."""
    orders = table(spark, sf_dir, "orders")
    flags = {"total_arrests": F.col("o_orderstatus") == "F", "domestic_crimes": F.col("o_orderstatus") == "P"}
    by = [F.to_date("o_orderdate").alias("crime_date"), F.col("o_orderpriority").alias("primary_type")]
    daily = summary.summarize(orders, by, flags, "total_crimes")
    lookup = lookup_table(spark, PRIORITY_CATEGORY, "primary_type", "crime_category")
    return clean.attach_category(daily, lookup, "primary_type", "crime_category")


@query(
    "rolling_avg_rows",
    f"""SELECT *, avg(total_crimes) OVER (PARTITION BY primary_type ORDER BY crime_date NULLS FIRST
    ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS seven_day_rolling_avg FROM ({ORDERS_SQL})""",
)
def rolling_avg_rows(spark, sf_dir):
    return summary.rolling_avg_rows(
        orders_daily(spark, sf_dir), "total_crimes", ["primary_type"], "crime_date", "seven_day_rolling_avg"
    )


@query(
    "rolling_avg_days",
    f"""SELECT *, avg(total_crimes) OVER (PARTITION BY primary_type, crime_category ORDER BY crime_date NULLS FIRST
    RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS seven_day_rolling_avg FROM ({ORDERS_SQL})""",
)
def rolling_avg_days(spark, sf_dir):
    by = ["primary_type", "crime_category"]
    return summary.rolling_avg_days(
        orders_daily(spark, sf_dir), "total_crimes", by, "crime_date", "seven_day_rolling_avg"
    )


LINEITEM_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)
DIRTY_PROFILE = ("id", "case_number", "date", "primary_type", "arrest", "district", "latitude", "location_description")


@query(
    "profile_distinct",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM lineitem" for c in LINEITEM_COLUMNS
    ),
)
def profile_distinct(spark, sf_dir):
    return profile.distinct_profile(table(spark, sf_dir, "lineitem"))


@query(
    "profile_distinct_approx",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count, true AS within_bound FROM lineitem"
        for c in LINEITEM_COLUMNS
    ),
)
def profile_distinct_approx(spark, sf_dir):
    """Sketched counts, held against the exact ones: six standard errors are allowed."""
    lines = table(spark, sf_dir, "lineitem")
    sketched = profile.distinct_profile(lines, approximate=True).withColumnRenamed("distinct_count", "estimate")
    both = profile.distinct_profile(lines).join(sketched, "column_name")
    off = F.abs(F.col("estimate") - F.col("distinct_count")) / F.col("distinct_count")
    return both.select("column_name", "distinct_count", (off <= 6 * 1.04 / 64).alias("within_bound"))


@query(
    "key_candidates",
    f"""{DIRTY}, counted AS ("""
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) FILTER ("{c}" IS NULL) AS null_count,
        count(DISTINCT "{c}") AS distinct_count FROM landing"""
        for c in DIRTY_PROFILE
    )
    + ") SELECT *, CASE WHEN distinct_count = total_rows THEN 'unique key' ELSE 'review' END AS verdict FROM counted",
)
def key_candidates(spark, sf_dir):
    return profile.key_candidates(landing(spark, sf_dir, dirty=True), DIRTY_PROFILE)


KEY_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")


def key_sets_sql(most: int) -> str:
    """All sets of columns, whether each is unique, and those that are and hold no smaller one."""
    sets = [s for size in range(1, most + 1) for s in itertools.combinations(KEY_COLUMNS, size)]
    rows = " UNION ALL ".join(
        f"SELECT {list(s)!r} AS names, {len(s)} AS size, count(*) = (SELECT count(*) FROM lineitem) AS is_key"
        f" FROM (SELECT DISTINCT {', '.join(s)} FROM lineitem)"
        for s in sets
    )
    return f"""WITH sets AS ({rows}), keys AS (SELECT * FROM sets WHERE is_key)
    SELECT array_to_string(names, ',') AS key_columns, CAST(size AS INTEGER) AS size FROM keys k
    WHERE NOT EXISTS (SELECT 1 FROM keys s WHERE s.size < k.size AND list_has_all(k.names, s.names))"""


@query("smallest_keys", key_sets_sql(3))
def smallest_keys(spark, sf_dir):
    keys = profile.smallest_keys(table(spark, sf_dir, "lineitem"), KEY_COLUMNS, most=3)
    return spark.createDataFrame([(",".join(k), len(k)) for k in keys], "key_columns STRING, size INT")


# Every order changes: status P gets a newer version, O a version that is too old, F a new key.
CHANGES = {
    "o_orderkey": "CASE WHEN o_orderstatus = 'F' THEN o_orderkey + 1000000000 ELSE o_orderkey END",
    "o_custkey": "o_custkey",
    "o_orderstatus": "'C'",
    "o_totalprice": "o_totalprice + 1",
    "updated_on": (
        "CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL '10' DAY"
        " ELSE o_orderdate - INTERVAL '10' DAY END"
    ),
}
CHANGES_SQL = ", ".join(f"{text} AS {name}" for name, text in CHANGES.items())


@query(
    "incremental_upsert",
    f"""WITH versions AS (
      SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS updated_on FROM orders
      UNION ALL SELECT {CHANGES_SQL} FROM orders)
    SELECT * REPLACE (CAST(updated_on AS DATE) AS updated_on) FROM versions
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY updated_on DESC NULLS LAST) = 1""",
)
def incremental_upsert(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    base = orders.withColumnRenamed("o_orderdate", "updated_on").drop("o_orderpriority")
    changes = orders.selectExpr(*[f"{text} AS {name}" for name, text in CHANGES.items()])
    merged = merge.upsert_latest(base, changes, ["o_orderkey"], "updated_on")
    return merged.withColumn("updated_on", F.to_date("updated_on"))
