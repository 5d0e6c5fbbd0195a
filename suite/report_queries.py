"""Reports over a daily summary, and the whole pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook import shared_dir
from casebook.operators import quality, reports, summary
from casebook.plans import incidents, pipeline
from casebook.sinks import write_by_month, write_csv
from casebook.sources import read_table
from suite.clean_queries import ORDERS_SQL, SUMMARY_SQL, orders_daily
from suite.landing import CATEGORY, ISO, detail_ctes, expressions, landing, landing_sql
from suite.quality_queries import MAX_ROWS, MIN_ROWS, now
from suite.registry import query, table

DAILY = f"WITH daily AS ({ORDERS_SQL})"
PERIODS_SQL = "(VALUES ('day'), ('week'), ('month'), ('year')) unit(period_unit)"
TYPE = ("primary_type", "crime_category")


def period_sql(measure: str, by: tuple[str, ...] = (), units: str = PERIODS_SQL) -> str:
    names = "".join(f", {c}" for c in by)
    return f"""SELECT period_unit, CAST(date_trunc(period_unit, crime_date) AS DATE) AS period_start{names},
    CAST(sum({measure}) AS BIGINT) AS {measure} FROM daily, {units} GROUP BY ALL"""


def trend_sql(measure: str, by: tuple[str, ...] = (), units: str = PERIODS_SQL) -> str:
    names = "".join(f", {c}" for c in by)
    return f"""{DAILY}, totals AS ({period_sql(measure, by, units)}),
    lagged AS (SELECT *, lag({measure}) OVER (PARTITION BY period_unit{names} ORDER BY period_start NULLS FIRST)
      AS previous FROM totals)
    SELECT *, {measure} - previous AS change, CASE WHEN {measure} > previous THEN 'increasing'
      WHEN {measure} < previous THEN 'decreasing' WHEN {measure} = previous THEN 'unchanged' END AS direction
    FROM lagged"""


def by_sql(measure: str, by: tuple[str, ...], tail: str = "") -> str:
    names = ", ".join(by)
    return f"{DAILY} SELECT {names}, CAST(sum({measure}) AS BIGINT) AS {measure} FROM daily GROUP BY {names} {tail}"


TOP_K = 3


def top_sql(measure: str) -> str:
    return by_sql(measure, TYPE, f"ORDER BY {measure} DESC, primary_type, crime_category LIMIT {TOP_K}")


@query("report_volume_by_period", f"{DAILY} {period_sql('total_crimes')}")
def report_volume_by_period(spark, sf_dir):
    return reports.total_by_period(orders_daily(spark, sf_dir), "crime_date", "total_crimes")


@query("report_top_types", top_sql("total_crimes"))
def report_top_types(spark, sf_dir):
    return reports.top(orders_daily(spark, sf_dir), TYPE, "total_crimes", TOP_K)


MONTHS_SQL = "(VALUES ('month'), ('year')) unit(period_unit)"


@query("report_volume_trend", trend_sql("total_crimes", ("primary_type",), MONTHS_SQL))
def report_volume_trend(spark, sf_dir):
    daily = orders_daily(spark, sf_dir)
    return reports.trend(daily, "crime_date", "total_crimes", ("month", "year"), ["primary_type"])


DAYS_SQL = "(VALUES ('day')) unit(period_unit)"


@query("report_volume_trend_daily", trend_sql("total_crimes", ("primary_type",), DAYS_SQL))
def report_volume_trend_daily(spark, sf_dir):
    return reports.trend(orders_daily(spark, sf_dir), "crime_date", "total_crimes", ("day",), ["primary_type"])


@query(
    "report_category_share",
    f"""{DAILY} SELECT crime_category, CAST(sum(total_crimes) AS BIGINT) AS total_crimes,
    CAST(sum(total_crimes) AS DOUBLE) / (SELECT sum(total_crimes) FROM daily) AS share FROM daily GROUP BY 1""",
)
def report_category_share(spark, sf_dir):
    return reports.share(orders_daily(spark, sf_dir), ["crime_category"], "total_crimes")


@query("report_arrests", by_sql("total_arrests", ("crime_date", *TYPE)))
def report_arrests(spark, sf_dir):
    return reports.total_by(orders_daily(spark, sf_dir), ["crime_date", *TYPE], "total_arrests")


@query("report_top_arrests", top_sql("total_arrests"))
def report_top_arrests(spark, sf_dir):
    return reports.top(orders_daily(spark, sf_dir), TYPE, "total_arrests", TOP_K)


@query("report_arrest_trend", trend_sql("total_arrests"))
def report_arrest_trend(spark, sf_dir):
    return reports.trend(orders_daily(spark, sf_dir), "crime_date", "total_arrests")


@query("report_domestic", by_sql("domestic_crimes", ("crime_date", *TYPE)))
def report_domestic(spark, sf_dir):
    return reports.total_by(orders_daily(spark, sf_dir), ["crime_date", *TYPE], "domestic_crimes")


@query("report_top_domestic", top_sql("domestic_crimes"))
def report_top_domestic(spark, sf_dir):
    return reports.top(orders_daily(spark, sf_dir), TYPE, "domestic_crimes", TOP_K)


@query("report_domestic_trend", trend_sql("domestic_crimes"))
def report_domestic_trend(spark, sf_dir):
    return reports.trend(orders_daily(spark, sf_dir), "crime_date", "domestic_crimes")


@query(
    "rollup_from_summary",
    f"""{DAILY}, monthly AS (
      SELECT CAST(date_trunc('month', crime_date) AS DATE) AS month_start, primary_type,
        CAST(sum(total_crimes) AS BIGINT) AS total_crimes, CAST(sum(total_arrests) AS BIGINT) AS total_arrests,
        CAST(sum(domestic_crimes) AS BIGINT) AS domestic_crimes FROM daily GROUP BY ALL)
    SELECT *, avg(total_crimes) OVER (PARTITION BY primary_type ORDER BY month_start NULLS FIRST
      ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS three_month_rolling_avg FROM monthly""",
)
def rollup_from_summary(spark, sf_dir):
    month = reports.period_start("month", F.col("crime_date")).alias("month_start")
    monthly = summary.resum(orders_daily(spark, sf_dir), [month, "primary_type"], incidents.SUMMARY_MEASURES)
    return summary.rolling_avg_rows(
        monthly, "total_crimes", ["primary_type"], "month_start", "three_month_rolling_avg", size=3
    )


@query(
    "report_filtered",
    f"""{DAILY} SELECT crime_date, CAST(year(crime_date) AS INTEGER) AS year, CAST(month(crime_date) AS INTEGER) AS month,
    primary_type, total_crimes FROM daily WHERE year(crime_date) = 1997 AND month(crime_date) IN (3, 4)
    AND crime_category = 'Rush' AND crime_date >= DATE '1997-03-10'""",
)
def report_filtered(spark, sf_dir):
    path = shared_dir(spark, "by_month")
    write_by_month(orders_daily(spark, sf_dir), path, "crime_date")
    first = F.lit("1997-03-10").cast("date")
    rows = reports.narrow(
        read_table(spark, path), "crime_date", first, year=[1997], month=[3, 4], crime_category=["Rush"]
    )
    return rows.select("crime_date", "year", "month", "primary_type", "total_crimes")


@query(
    "rolling_avg_days_between",
    f"""SELECT * FROM (SELECT *, avg(total_crimes) OVER (PARTITION BY primary_type ORDER BY crime_date NULLS FIRST
    RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS seven_day_rolling_avg FROM ({ORDERS_SQL}))
    WHERE crime_date BETWEEN DATE '1997-03-10' AND DATE '1997-06-30'""",
)
def rolling_avg_days_between(spark, sf_dir):
    first, last = (F.lit(d).cast("date") for d in ("1997-03-10", "1997-06-30"))
    return summary.rolling_avg_days_between(
        orders_daily(spark, sf_dir), "total_crimes", ["primary_type"], "crime_date", "seven_day_rolling_avg", first, last
    )


RUN = quality.Run("manual_run", "2026-01-01", "2026-01-01T00:00:00+00:00", "incidents")


def landed_rows(spark, rows, compression: str = "none") -> str:
    path = shared_dir(spark, "landing")
    write_csv(rows, path, compression)
    return path


def pipeline_summary(spark, sf_dir, dirty: bool, fail_on_error: bool, large_files: bool = False):
    landed = landed_rows(spark, landing(spark, sf_dir, dirty))
    zones = pipeline.Zones(shared_dir(spark, "zones"))
    return pipeline.run_pipeline(spark, landed, zones, RUN, MIN_ROWS, MAX_ROWS, fail_on_error, now(), large_files=large_files)


def pipeline_sql(dirty: bool) -> str:
    return f"""{detail_ctes(dirty)}, daily AS ({SUMMARY_SQL})
    SELECT *, avg(total_crimes) OVER (PARTITION BY primary_type ORDER BY crime_date NULLS FIRST
      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS seven_day_rolling_avg FROM daily"""


@query("pipeline_end_to_end", pipeline_sql(dirty=False))
def pipeline_end_to_end(spark, sf_dir):
    return pipeline_summary(spark, sf_dir, dirty=False, fail_on_error=True)


@query("pipeline_inspection_mode", pipeline_sql(dirty=True))
def pipeline_inspection_mode(spark, sf_dir):
    return pipeline_summary(spark, sf_dir, dirty=True, fail_on_error=False)


@query("pipeline_large_files", pipeline_sql(dirty=False))
def pipeline_large_files(spark, sf_dir):
    return pipeline_summary(spark, sf_dir, dirty=False, fail_on_error=True, large_files=True)


# Later versions of every third incident, outdated ones of others, and new ids.
CHANGED = {
    "id": "CASE event_id % 5 WHEN 0 THEN CAST(event_id + 1000000000 AS STRING) ELSE CAST(event_id AS STRING) END",
    "primary_type": "'ROBBERY'",
    "updated_on": "CASE WHEN event_id % 3 = 0 THEN '2025-12-31T00:00:00.000' ELSE '1990-01-01T00:00:00.000' END",
}


def changes_sql(dialect: str) -> str:
    columns = {**expressions(dialect, dirty=False), **CHANGED}
    names = ", ".join(f"{text} AS `{name}`" for name, text in columns.items())
    return f"SELECT {names} FROM events WHERE event_id % 2 = 0"


def refreshed_sql() -> str:
    changes = changes_sql("duckdb").replace("`", '"')
    union = f"SELECT 0 AS change, * FROM ({landing_sql()}) UNION ALL SELECT 1, * FROM ({changes})"
    return f"""WITH landing AS ({union}), dated AS (SELECT *, {ISO('date')} AS moment, {ISO('updated_on')} AS updated FROM landing),
    newest AS (SELECT * FROM dated QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated DESC, change DESC) = 1),
    daily AS (SELECT CAST(moment AS DATE) AS crime_date, primary_type, count(*) AS total_crimes,
      count(*) FILTER (arrest = 'true') AS total_arrests, count(*) FILTER (domestic = 'true') AS domestic_crimes
      FROM newest GROUP BY 1, 2)
    SELECT crime_date, CAST(year(crime_date) AS INTEGER) AS year, CAST(month(crime_date) AS INTEGER) AS month, primary_type,
      CASE primary_type WHEN 'ROBBERY' THEN 'Property Crime' ELSE {CATEGORY} END AS crime_category,
      total_crimes, total_arrests, domestic_crimes,
      avg(total_crimes) OVER (PARTITION BY primary_type ORDER BY crime_date NULLS FIRST
        ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS seven_day_rolling_avg FROM daily"""


@query("pipeline_refresh", refreshed_sql())
def pipeline_refresh(spark, sf_dir):
    """A full load, then changes landed apart, gated and applied; the refreshed summary by month."""
    zones, target = (pipeline.Zones(shared_dir(spark, name)) for name in ("zones", "refreshed"))
    pipeline.run_pipeline(spark, landed_rows(spark, landing(spark, sf_dir)), zones, RUN, MIN_ROWS, MAX_ROWS, True, now())
    columns = {**expressions("spark", dirty=False), **CHANGED}
    events = table(spark, sf_dir, "events").where("event_id % 2 = 0")
    changes = events.selectExpr(*[f"{text} AS `{name}`" for name, text in columns.items()])
    pipeline.refresh(spark, zones, landed_rows(spark, changes), target, RUN, MIN_ROWS, MAX_ROWS, True, now())
    return read_table(spark, target.by_month)
