from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from casebook.operators import clean, merge, profile, summary
from casebook.plans import incidents
from casebook.sources import lookup_table
from tests.helpers import edge_rows, final_plan_of, plan_of, text_frame

JAN = dt.date(2024, 1, 1)
SUMMARY = {
    (None, "ARSON", "Other", 1, 0, 0),
    (None, "NARCOTICS", "Drug Crime", 1, 0, 0),
    (JAN, "BATTERY", "Violent Crime", 1, 1, 1),
    (JAN, "THEFT", "Property Crime", 1, 1, 0),
    (dt.date(2024, 1, 2), None, "Other", 1, 0, 0),
    (dt.date(2024, 1, 2), "  ", "Other", 1, 0, 0),
    (dt.date(2024, 1, 2), "THEFT", "Property Crime", 2, 1, 0),
    (dt.date(2024, 1, 2), "theft", "Other", 1, 1, 0),
    (dt.date(2999, 1, 1), "THEFT", "Property Crime", 1, 0, 0),
}


def test_clean_detail(spark):
    detail = incidents.clean_detail(spark, edge_rows(spark))
    rows = {r.id: r for r in detail.withColumn("updated", F.col("updated_timestamp").cast("timestamp_ntz")).collect()}
    assert sorted(rows) == [1, 2, 8, 9, 10, 11, 12, 13, 14, 15]
    assert rows[2].arrest == "true"
    assert rows[8].district is None and rows[8].crime_date == dt.date(2024, 1, 2)
    assert (rows[1].district, rows[2].district) == (1, 12)
    assert rows[9].crime_date is None and rows[10].crime_date is None
    assert rows[1].updated == dt.datetime(2024, 2, 1)
    assert detail.columns[0] == "primary_type"
    types = dict(detail.dtypes)
    assert [types[c] for c in ("id", "year", "latitude", "crime_timestamp", "crime_date")] == [
        "bigint", "int", "double", "timestamp", "date",
    ]


def test_daily_summary(spark):
    daily = incidents.daily_summary(incidents.clean_detail(spark, edge_rows(spark)))
    rows = daily.collect()
    assert {tuple(r)[:6] for r in rows} == SUMMARY
    assert daily.columns == [
        "crime_date", "primary_type", "crime_category", "total_crimes", "total_arrests", "domestic_crimes",
        "seven_day_rolling_avg",
    ]
    assert sum(r.total_crimes for r in rows) == 10


VERSIONS = [("a", i, f"v{i % 7}") for i in range(500)] + [("b", 1, "x"), ("b", 1, "w"), ("c", None, "n"), ("c", 0, "m")]


def test_latest_per_key_breaks_ties(spark):
    df = spark.createDataFrame(VERSIONS, "k STRING, u INT, v STRING")
    expected = {("a", 499, "v2"), ("b", 1, "w"), ("c", 0, "m")}
    for parts in (1, 7):
        assert {tuple(r) for r in clean.latest_per_key(df.repartition(parts), ["k"], "u").collect()} == expected


def test_repeated_key_is_reduced_before_the_shuffle(spark):
    plan = plan_of(clean.latest_per_key(spark.range(10).selectExpr("id % 3 AS k", "id AS u"), ["k"], "u"))
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_hot_key_sends_one_row_per_task(spark):
    """A third of all rows share one id; each map task may pass on only one of them."""
    rows = 30_000
    df = spark.range(0, rows, 1, 6).selectExpr("if(id % 3 = 0, -1, id) AS k", "id AS u", "cast(id AS string) AS v")
    found = clean.latest_per_key(df, ["k"], "u")
    assert found.count() == rows - rows // 3 + 1
    assert found.filter("k = -1").first().u == rows - 3


def test_category_is_an_exact_match(spark):
    lookup = lookup_table(spark, {"THEFT": "Property"}, "t", "c")
    df = text_frame(spark, ["x", "t"], [("1", "THEFT"), ("2", "theft"), ("3", None), ("4", "THEFT ")])
    result = clean.attach_category(df, lookup, "t", "c")
    assert result.columns == ["t", "x", "c"]
    assert {(r.x, r.c) for r in result.collect()} == {("1", "Property"), ("2", "Other"), ("3", "Other"), ("4", "Other")}


def test_lookup_is_broadcast_by_size_not_by_hint(spark, run_dir):
    spark.range(1000).selectExpr("cast(id % 9 AS string) AS t").write.parquet(run_dir + "/t")
    df = spark.read.parquet(run_dir + "/t")
    joined = lambda: clean.attach_category(df, lookup_table(spark, {"1": "one"}, "t", "c"), "t", "c")
    assert "BroadcastHashJoin" in plan_of(joined())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        assert "SortMergeJoin" in plan_of(joined())
        assert joined().filter("c = 'one'").count() == 111
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_rolling_frames(spark):
    rows = [(dt.date(2024, 1, 1 + 3 * i), "A", i + 1) for i in range(6)]
    df = spark.createDataFrame(rows, "d DATE, t STRING, n BIGINT")
    by_rows = summary.rolling_avg_rows(df, "n", ["t"], "d", "a").orderBy("d").collect()
    by_days = summary.rolling_avg_days(df, "n", ["t"], "d", "a").orderBy("d").collect()
    assert [r.a for r in by_rows] == [1.0, 1.5, 2.0, 2.5, 3.0, 3.5]
    assert [r.a for r in by_days] == [1.0, 1.5, 2.0, 3.0, 4.0, 5.0]


def test_null_date_takes_a_place_in_the_row_frame(spark):
    rows = [(None, "A", 100)] + [(dt.date(2024, 1, 1 + i), "A", 1) for i in range(7)]
    df = spark.createDataFrame(rows, "d DATE, t STRING, n BIGINT")
    by_rows = {r.d: r.a for r in summary.rolling_avg_rows(df, "n", ["t"], "d", "a").collect()}
    by_days = {r.d: r.a for r in summary.rolling_avg_days(df, "n", ["t"], "d", "a").collect()}
    assert by_rows[dt.date(2024, 1, 6)] == pytest.approx(106 / 7)
    assert by_rows[dt.date(2024, 1, 7)] == 1.0
    assert by_days[dt.date(2024, 1, 6)] == 1.0 and by_days[None] == 100.0


def brute_force_merge(base, changes):
    best = {}
    for k, u, v in changes:
        if k not in best or (-u, v) < (-best[k][0], best[k][1]):
            best[k] = (u, v)
    merged = {k: (u, v) for k, u, v in base}
    for k, (u, v) in best.items():
        if k not in merged or u >= merged[k][0]:
            merged[k] = (u, v)
    return Counter((k, u, v) for k, (u, v) in merged.items())


def test_upsert_against_brute_force(spark):
    base = [(k, k % 10, "base") for k in range(200)]
    changes = [(k * 3 % 260, k % 13, f"c{k}") for k in range(150)] + [(7, 50, "hot")] * 60
    schema = "k BIGINT, u BIGINT, v STRING"
    b, c = spark.createDataFrame(base, schema), spark.createDataFrame(changes, schema)
    expected = brute_force_merge(base, changes)
    once = merge.upsert_latest(b, c, ["k"], "u")
    assert Counter(tuple(r) for r in once.collect()) == expected
    again = merge.upsert_latest(spark.createDataFrame(once.collect(), schema), c, ["k"], "u")
    assert Counter(tuple(r) for r in again.collect()) == expected


def test_upsert_with_no_changes_keeps_the_base(spark):
    schema = "k BIGINT, u BIGINT, v STRING"
    base = spark.createDataFrame([(1, None, "a"), (2, 5, "b")], schema)
    same = merge.upsert_latest(base, spark.createDataFrame([], schema), ["k"], "u")
    assert sorted(tuple(r) for r in same.collect()) == sorted(tuple(r) for r in base.collect())
    dated = merge.upsert_latest(base, spark.createDataFrame([(1, 1, "n"), (2, None, "n")], schema), ["k"], "u")
    assert sorted(tuple(r) for r in dated.collect()) == [(1, 1, "n"), (2, 5, "b")]


def test_small_change_set_leaves_the_base_in_place(spark, run_dir):
    spark.range(5000).selectExpr("id AS k", "1 AS u", "repeat('x', 50) AS v").write.parquet(run_dir + "/base")
    spark.range(20).selectExpr("id * 7 AS k", "2 AS u", "'y' AS v").write.parquet(run_dir + "/changes")
    merged = merge.upsert_latest(
        spark.read.parquet(run_dir + "/base"), spark.read.parquet(run_dir + "/changes"), ["k"], "u"
    )
    assert merged.filter("v = 'y'").count() == 20 and merged.count() == 5000
    plan = final_plan_of(merged)
    plan = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_profiles(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 AS seven", "if(id = 3, NULL, id) AS gap", "1 AS one")
    exact = [tuple(r) for r in profile.distinct_profile(df).collect()]
    assert exact == [("one", 1), ("seven", 7), ("gap", 4999), ("id", 5000)]
    for name, count in (tuple(r) for r in profile.distinct_profile(df, approximate=True).collect()):
        assert count == pytest.approx(dict(exact)[name], rel=0.06)
    verdicts = {r.column_name: (r.null_count, r.verdict) for r in profile.key_candidates(df).collect()}
    assert verdicts == {
        "id": (0, "unique key"), "seven": (0, "review"), "gap": (1, "review"), "one": (0, "review"),
    }


def test_summary_combines_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS t", "id > 3 AS f")
    plan = plan_of(summary.summarize(df, ["t"], {"flagged": F.col("f")}, "n"))
    assert "partial_count" in plan[plan.index("Exchange") :]
