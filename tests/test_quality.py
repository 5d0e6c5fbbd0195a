from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casebook.operators import quality
from casebook.plans import incidents
from tests.helpers import EDGE_ROWS, edge_rows, plan_of, text_frame

RUN = quality.Run("r1", "2026-01-01", "2026-01-01T00:00:00+00:00", "incidents")

EXPECTED = {
    "required_columns_exist": ("PASS", "critical", "none"),
    "row_count_between_expected_range": ("PASS", "critical", "17"),
    "null_id_count": ("FAIL", "critical", "2"),
    "invalid_id_count": ("FAIL", "critical", "3"),
    "duplicate_id_group_count": ("FAIL", "critical", "1"),
    "duplicate_record_count": ("FAIL", "critical", "2"),
    "null_date_count": ("FAIL", "critical", "1"),
    "invalid_date_count": ("FAIL", "critical", "1"),
    "future_date_count": ("FAIL", "critical", "1"),
    "null_primary_type_count": ("FAIL", "critical", "2"),
    "invalid_latitude_count": ("WARN", "warning", "2"),
    "invalid_longitude_count": ("WARN", "warning", "1"),
}


def assess(df, low=1, high=100):
    now = F.to_timestamp(F.lit("2026-01-01 00:00:00"))
    return quality.assess(df, incidents.quality_suite(df, low, high, now), RUN)


def found(results):
    return {r.check_name: (r.status, r.severity, r.observed_value) for r in results.orderBy("check_no").collect()}


def test_edge_rows(spark):
    result = found(assess(edge_rows(spark)))
    assert result == EXPECTED
    assert list(result) == list(EXPECTED)


def test_result_has_the_eleven_string_columns(spark):
    results = assess(edge_rows(spark)).drop("check_no")
    assert results.columns == list(quality.RESULT_COLUMNS)
    assert {t for _, t in results.dtypes} == {"string"}
    row = results.first()
    assert (row.run_id, row.logical_date, row.dataset_name, row.layer_name) == ("r1", "2026-01-01", "incidents", "raw")


@pytest.mark.parametrize(("low", "high", "status"), [(17, 17, "PASS"), (17, 99, "PASS"), (18, 99, "FAIL"), (1, 16, "FAIL")])
def test_row_count_bounds_are_inclusive(spark, low, high, status):
    assert found(assess(edge_rows(spark), low, high))["row_count_between_expected_range"][0] == status


def test_empty_input(spark):
    result = found(assess(edge_rows(spark, []), 1, 10))
    assert result["row_count_between_expected_range"] == ("FAIL", "critical", "0")
    assert result["duplicate_record_count"] == ("PASS", "critical", "0")


def test_missing_columns_give_two_records(spark):
    df = edge_rows(spark).withColumnRenamed("id", "ID").drop("year", "arrest")
    result = found(assess(df))
    assert result == {
        "required_columns_exist": ("FAIL", "critical", "id,arrest,year"),
        "row_count_between_expected_range": ("PASS", "critical", "17"),
    }


def test_coordinates_are_optional(spark):
    result = found(assess(edge_rows(spark).drop("latitude", "longitude")))
    assert result["invalid_latitude_count"] == ("PASS", "warning", "0")


def test_every_row_is_null_invalid_or_valid(spark):
    df = edge_rows(spark)
    result = found(assess(df))
    valid = df.filter(F.col("id").try_cast("bigint").isNotNull()).count()
    assert int(result["null_id_count"][2]) + int(result["invalid_id_count"][2]) + valid == len(EDGE_ROWS)


def test_blocking_leaves_warnings_out(spark):
    names = {r.check_name for r in quality.blocking(assess(edge_rows(spark))).collect()}
    assert names == {n for n, (status, _, _) in EXPECTED.items() if status == "FAIL"}


def test_two_scans_and_no_row_shuffle(spark, run_dir):
    edge_rows(spark).write.parquet(run_dir + "/raw")
    plan = plan_of(assess(spark.read.parquet(run_dir + "/raw")))
    assert plan.count("FileScan parquet") == 2
    # the row checks exchange one partial row per task, the key check the keys only
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<id:string>" in plan
    assert "Join" not in plan
    for unused in ("block", "description", "location_description"):
        assert unused + ":string" not in plan


def test_duplicates_count_rows_beyond_the_first(spark):
    df = text_frame(spark, ["k"], [("a",)] * 4 + [("b",)] * 2 + [("c",), (None,), (None,)])
    row = quality.count_duplicates(df, "k").first()
    assert (row.duplicate_groups, row.duplicate_rows) == (2, 4)


def report(spark, results, short=False):
    lines = quality.report_lines(results, RUN, short).orderBy("line_no").collect()
    return [r.line for r in lines]


def test_report_lines(spark):
    lines = report(spark, assess(edge_rows(spark)))
    assert lines[:14] == [
        "# Raw Data Quality Report",
        "",
        "Run ID: r1",
        "",
        "Logical Date: 2026-01-01",
        "",
        "Run Timestamp: 2026-01-01T00:00:00+00:00",
        "",
        "Dataset: incidents",
        "",
        "Layer: raw",
        "",
        "Total Rows: 17",
        "",
    ]
    assert lines[14:18] == [
        "| Check | Status | Severity | Observed Value | Rule |",
        "|---|---|---|---:|---|",
        "| required_columns_exist | PASS | critical | none | All required columns must exist |",
        "| row_count_between_expected_range | PASS | critical | 17 | Row count must be between 1 and 100 |",
    ]
    assert len(lines) == 28


def test_short_report(spark):
    lines = report(spark, assess(edge_rows(spark).drop("id")), short=True)
    assert len([line for line in lines if line]) == 5
    assert lines[-1] == "Critical failure: missing required columns."


ids = st.one_of(st.none(), st.sampled_from(["", "  ", "\t", "x", "1.0", " 7 ", "+7", "7", "007", "12", "99999999999999999999"]))
days = st.one_of(st.none(), st.sampled_from(["", " ", "junk", "2024-01-01 10:00:00", "2999-01-01T00:00:00.000", "2024-02-30"]))
kinds = st.sampled_from([None, "", "   ", "THEFT", "theft"])
latitudes = st.sampled_from([None, "", " ", "41", "42.1", "42.2", "40.9", "NaN", "x", "-Infinity", "41.5d"])


def brute_force(rows):
    """The checks over plain Python rows."""
    blank = lambda v: v is None or v.strip(" ") == ""

    def number(v):
        digits = v.strip().lstrip("+-")
        return int(v) if digits.isdigit() and abs(int(v)) < 2**63 else None

    readable = {"2024-01-01 10:00:00": False, "2999-01-01T00:00:00.000": True}
    inside = {"41", "42.1", "41.5d"}
    keys = Counter(number(r[0]) for r in rows if not blank(r[0]) and number(r[0]) is not None)
    return {
        "null_id_count": sum(blank(r[0]) for r in rows),
        "invalid_id_count": sum(not blank(r[0]) and number(r[0]) is None for r in rows),
        "duplicate_id_group_count": sum(n > 1 for n in keys.values()),
        "duplicate_record_count": sum(n - 1 for n in keys.values()),
        "null_date_count": sum(blank(r[1]) for r in rows),
        "invalid_date_count": sum(not blank(r[1]) and r[1] not in readable for r in rows),
        "future_date_count": sum(readable.get(r[1], False) for r in rows),
        "null_primary_type_count": sum(blank(r[2]) for r in rows),
        "invalid_latitude_count": sum(not blank(r[3]) and r[3] not in inside for r in rows),
    }


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(ids, days, kinds, latitudes), min_size=30, max_size=150))
def test_checks_against_brute_force(spark, rows):
    columns = {n: pa.array([r[i] for r in rows], pa.string()) for i, n in enumerate(["id", "date", "primary_type", "latitude"])}
    columns |= {n: pa.array(["v"] * len(rows)) for n in ("case_number", "arrest", "domestic", "year")}
    result = found(assess(spark.createDataFrame(pa.table(columns)), 1, 1000))
    expected = brute_force(rows)
    assert {name: int(result[name][2]) for name in expected} == expected
    assert {name for name in expected if result[name][0] == "PASS"} == {n for n, v in expected.items() if v == 0}
