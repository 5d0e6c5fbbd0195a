"""Sources and sinks: what is written comes back whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook import shared_dir
from casebook.functions import column_or_null
from casebook.operators import quality
from casebook.sinks import (
    append_partitioned,
    read_clustered,
    replace_partitions,
    write_by_month,
    write_clustered,
    write_csv,
    write_lines,
    write_single_csv,
    write_table,
)
from casebook.sources import extract_range, read_table, scan_landing, scan_large, with_lineage
from suite.landing import landing
from suite.quality_queries import RUN, records_sql, suite_for
from suite.registry import query, table


@query(
    "scan_csv_multiline",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents",
)
def scan_csv_multiline(spark, sf_dir):
    path = shared_dir(spark, "documents_csv")
    write_csv(table(spark, sf_dir, "documents"), path)
    return scan_landing(spark, path)


@query(
    "scan_csv_large",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents",
)
def scan_csv_large(spark, sf_dir):
    path = shared_dir(spark, "documents_csv")
    write_csv(table(spark, sf_dir, "documents"), path)
    return scan_large(spark, path, source_file=False)


@query(
    "scan_csv_layouts",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 3 < 2 THEN lang END AS lang, text FROM documents",
)
def scan_csv_layouts(spark, sf_dir):
    """Files whose columns stand in another order, or are not all there, are united by name."""
    docs = table(spark, sf_dir, "documents")
    path = shared_dir(spark, "documents_layouts")
    layouts = (("doc_id", "text", "lang"), ("lang", "doc_id", "text"), ("text", "doc_id"))
    for number, names in enumerate(layouts):
        write_csv(docs.where(F.col("doc_id") % 3 == number).select(*names), f"{path}/{number}")
    return scan_landing(spark, [f"{path}/{n}" for n in range(len(layouts))])


EXTRACT = ("1996-01-01 00:00:00", "1996-12-31 23:59:59")


@query(
    "extract_date_range",
    f"""SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '{EXTRACT[0]}' AND TIMESTAMP '{EXTRACT[1]}'""",
)
def extract_date_range(spark, sf_dir):
    first, last = (F.lit(t).cast("timestamp_ntz") for t in EXTRACT)
    rows = extract_range(table(spark, sf_dir, "orders"), "o_orderdate", first, last)
    return rows.select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("o_orderdate"))


@query(
    "extract_clustered",
    f"""SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '{EXTRACT[0]}' AND TIMESTAMP '{EXTRACT[1]}'""",
)
def extract_clustered(spark, sf_dir):
    """The same extract from a table laid out by ranges of the date: files of other years are not read."""
    path = shared_dir(spark, "clustered")
    write_clustered(table(spark, sf_dir, "orders"), path, "o_orderdate", rows_per_file=10_000)
    first, last = (F.lit(t).cast("timestamp_ntz") for t in EXTRACT)
    rows = read_clustered(spark, path, "o_orderdate", first, last)
    return rows.select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("o_orderdate"))


@query("scan_parquet", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_discount >= 0.05")
def scan_parquet(spark, sf_dir):
    rows = read_table(spark, f"{sf_dir}/lineitem.parquet")
    return rows.filter(F.col("l_discount") >= 0.05).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "contract_columns",
    """SELECT check_name, status, severity, observed_value FROM (
      SELECT 'required_columns_exist' AS check_name, 'FAIL' AS status, 'critical' AS severity,
        'id,case_number,date,primary_type,arrest,domestic,year' AS observed_value
      UNION ALL
      SELECT 'row_count_between_expected_range', CASE WHEN count(*) BETWEEN 1 AND 1000000000 THEN 'PASS' ELSE 'FAIL' END,
        'critical', CAST(count(*) AS VARCHAR) FROM events)""",
)
def contract_columns(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return quality.assess(events, suite_for(events), RUN).select("check_name", "status", "severity", "observed_value")


@query(
    "add_metadata",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, DATE '2026-01-01' AS loaded_on,
    'csv' AS file_kind FROM customer""",
)
def add_metadata(spark, sf_dir):
    path = shared_dir(spark, "customer_csv")
    write_csv(table(spark, sf_dir, "customer"), path)
    loaded_at = F.to_timestamp(F.lit("2026-01-01 00:00:00"))
    rows = with_lineage(scan_landing(spark, path, source_file=True), loaded_at)
    return rows.select(
        "c_custkey",
        "c_mktsegment",
        F.to_date("ingestion_timestamp").alias("loaded_on"),
        F.regexp_extract("source_file", r"\.([a-z]+)$", 1).alias("file_kind"),
    )


@query(
    "optional_column",
    "SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS nation, CAST(NULL AS VARCHAR) AS latitude FROM customer",
)
def optional_column(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.select(
        "c_custkey",
        column_or_null(customer, "c_nationkey").alias("nation"),
        column_or_null(customer, "latitude").alias("latitude"),
    )


@query(
    "sink_parquet_overwrite",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def sink_parquet_overwrite(spark, sf_dir):
    path = shared_dir(spark, "overwritten")
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    write_table(orders.withColumn("o_totalprice", F.lit(0.0)), path)
    write_table(orders, path)
    return read_table(spark, path)


@query("sink_csv_single", records_sql(dirty=True))
def sink_csv_single(spark, sf_dir):
    raw = landing(spark, sf_dir, dirty=True)
    path = shared_dir(spark, "results_csv")
    write_single_csv(quality.assess(raw, suite_for(raw), RUN), path, order_by="check_no")
    return scan_landing(spark, path)


@query(
    "sink_partitioned_append",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS logical_date, run_id, event_type, count(*) * copies AS rows_seen
    FROM events, (VALUES ('first', 1), ('second', 2)) run(run_id, copies)
    GROUP BY CAST(ts AS DATE), run_id, event_type, copies""",
)
def sink_partitioned_append(spark, sf_dir):
    path = shared_dir(spark, "history")
    rows = table(spark, sf_dir, "events").select(F.to_date("ts").cast("string").alias("logical_date"), "event_type")
    for run_id in ("first", "second", "second"):
        append_partitioned(rows.withColumn("run_id", F.lit(run_id)), path, ["logical_date"])
    stored = read_table(spark, path, "logical_date STRING, event_type STRING, run_id STRING")
    return stored.groupBy("logical_date", "run_id", "event_type").agg(F.count(F.lit(1)).alias("rows_seen"))


@query(
    "sink_partitioned_replace",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS logical_date, run_id, event_type, count(*) AS rows_seen
    FROM events, (VALUES ('first'), ('second')) run(run_id) GROUP BY ALL""",
)
def sink_partitioned_replace(spark, sf_dir):
    path = shared_dir(spark, "history")
    rows = table(spark, sf_dir, "events").select(F.to_date("ts").cast("string").alias("logical_date"), "event_type")
    for run_id in ("first", "second", "second"):
        replace_partitions(rows.withColumn("run_id", F.lit(run_id)), path, ["logical_date", "run_id"])
    stored = read_table(spark, path, "logical_date STRING, event_type STRING, run_id STRING")
    return stored.groupBy("logical_date", "run_id", "event_type").agg(F.count(F.lit(1)).alias("rows_seen"))


@query(
    "sink_year_month",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
    FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) BETWEEN 3 AND 5""",
)
def sink_year_month(spark, sf_dir):
    path = shared_dir(spark, "by_month")
    write_by_month(table(spark, sf_dir, "orders"), path, "o_orderdate")
    stored = read_table(spark, path)
    return stored.filter((F.col("year") == 1997) & F.col("month").between(3, 5)).select("o_orderkey", "year", "month")


COUNTED = ("events", "lineitem", "orders")
COUNTS_SQL = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED)


@query("write_row_count", COUNTS_SQL)
def write_row_count(spark, sf_dir):
    rows = [(t, write_table(table(spark, sf_dir, t), shared_dir(spark, t))) for t in COUNTED]
    return spark.createDataFrame(rows, "table_name STRING, row_count BIGINT")


@query("row_count", COUNTS_SQL)
def row_count(spark, sf_dir):
    counts = [table(spark, sf_dir, t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for t in COUNTED]
    merged = counts[0]
    for one in counts[1:]:
        merged = merged.unionByName(one)
    return merged


REPORT_SQL = f"""
WITH records AS ({records_sql(dirty=True)})
SELECT line FROM (VALUES ('# Raw Data Quality Report'), (''), ('Run ID: {RUN.run_id}'), (''),
  ('Logical Date: {RUN.logical_date}'), (''), ('Run Timestamp: {RUN.run_timestamp}'), (''),
  ('Dataset: {RUN.dataset_name}'), (''), ('Layer: {RUN.layer_name}'), (''), (''),
  ('| Check | Status | Severity | Observed Value | Rule |'), ('|---|---|---|---:|---|')) fixed(line)
UNION ALL SELECT 'Total Rows: ' || observed_value FROM records WHERE check_name = 'row_count_between_expected_range'
UNION ALL SELECT '| ' || check_name || ' | ' || status || ' | ' || severity || ' | ' || observed_value || ' | ' || rule || ' |'
FROM records"""


@query("dq_report_markdown", REPORT_SQL)
def dq_report_markdown(spark, sf_dir):
    raw = landing(spark, sf_dir, dirty=True)
    stored = shared_dir(spark, "records")
    write_table(quality.assess(raw, suite_for(raw), RUN), stored)
    path = shared_dir(spark, "report")
    write_lines(quality.report_lines(read_table(spark, stored), RUN), path)
    return spark.read.text(path).select(F.col("value").alias("line"))
