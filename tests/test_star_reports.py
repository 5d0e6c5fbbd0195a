from __future__ import annotations

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from casebook.operators import profile, reports, star, summary
from casebook.plans import incidents
from casebook.sinks import write_by_month
from casebook.sources import read_table
from tests.helpers import EDGE_ROWS, edge_rows, plan_of


@pytest.fixture
def detail(spark):
    return incidents.clean_detail(spark, edge_rows(spark))


def test_dimensions_are_unique_on_key_and_keep_null_members(spark, detail):
    for dim in incidents.dimensions().values():
        built = star.build_dimension(detail, dim)
        assert built.count() == built.select(dim.key).distinct().count()
        assert built.filter(F.col(dim.key).isNull()).count() == 0
    area = star.build_dimension(detail, incidents.dimensions()["dim_police_area"])
    assert area.filter("district IS NULL").count() == 1


def test_time_of_day_has_every_minute(spark, detail):
    dim = incidents.dimensions()["dim_time_of_day"]
    times = star.build_dimension(detail, dim)
    assert times.filter("hour IS NOT NULL").count() == 1440
    assert times.filter("hour IS NULL").count() == 1  # two incidents without a readable date
    dated = star.build_dimension(detail.filter("crime_timestamp IS NOT NULL"), dim)
    assert dated.count() == 1440


def test_fact_needs_no_shuffle_beyond_the_detail(spark, detail, run_dir):
    detail.write.parquet(run_dir + "/t")
    plan = plan_of(incidents.incident_fact(spark.read.parquet(run_dir + "/t")))
    assert "Exchange" not in plan and "Join" not in plan and "Window" not in plan


def test_fact_and_dimensions_fit(spark, detail):
    fact = incidents.incident_fact(detail)
    dims = {d.key: star.build_dimension(detail, d) for d in incidents.dimensions().values()}
    assert fact.count() == 10
    assert len(fact.columns) == 13
    orphans = star.foreign_key_orphans(fact, dims).collect()
    assert {(r.foreign_key, r.fact_rows, r.orphan_keys, r.orphan_rows) for r in orphans} == {
        (key, 10, 0, 0) for key in dims
    }
    assert star.denormalize(fact, dims).count() == 10


@contextlib.contextmanager
def settings(spark, **values):
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {n: spark.conf.get(n) for n in names}  # only settings that have a value
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_hot_member_of_a_large_dimension_is_split(spark, run_dir):
    """A third of the fact points at one member of a dimension too large to broadcast."""
    rows = 60_000
    spark.range(0, rows, 1, 16).selectExpr(
        "id", "sha2(cast(if(id % 3 = 0, 0, id) AS string), 256) AS k", "repeat(uuid(), 4) AS payload"
    ).write.parquet(run_dir + "/fact")
    spark.range(rows).selectExpr("sha2(cast(id AS string), 256) AS k", "id AS member").write.parquet(run_dir + "/dim")
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="64KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="256KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__coalescePartitions__enabled="false",
    ):
        wide = star.denormalize(read_table(spark, run_dir + "/fact"), {"k": read_table(spark, run_dir + "/dim")})
        found = wide.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(wide)
    assert len(found) == rows
    assert sum(r.member == 0 for r in found) == rows // 3


def stored_star(spark, detail, path):
    detail.write.parquet(path + "/detail")
    detail = read_table(spark, path + "/detail")
    incidents.incident_fact(detail).write.parquet(path + "/fact")
    dims = {}
    for dim in incidents.dimensions().values():
        star.build_dimension(detail, dim).write.parquet(f"{path}/{dim.name}")
        dims[dim.key] = read_table(spark, f"{path}/{dim.name}")
    return read_table(spark, path + "/fact"), dims


def test_totals_over_small_dimensions_shuffle_sums_only(spark, detail, run_dir):
    fact, dims = stored_star(spark, detail, run_dir)
    used = {k: dims[k] for k in ("date_key", "crime_type_key")}
    plan = plan_of(star.star_totals(fact, used, ["weekday", "crime_category"], {"n": F.count(F.lit(1))}))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("BroadcastHashJoin") == 2
    assert "partial_count" in plan[plan.index("Exchange hashpartitioning") : plan.index("BroadcastHashJoin")]
    assert "ReadSchema: struct<date_key:string,weekday:string>" in plan


def test_hot_member_of_a_large_dimension_is_summed_before_the_join(spark, detail, run_dir):
    fact, dims = stored_star(spark, detail, run_dir)
    used = {k: dims[k] for k in ("crime_type_key", "location_point_key")}
    by, count = ["crime_category", "latitude"], {"n": F.count(F.lit(1))}
    totals = star.star_totals(fact, used, by, count, large=["location_point_key"])
    plan = plan_of(totals)
    assert "HashAggregate(keys=[crime_category" in plan[plan.index("Join [location_point_key") :]
    together = star.star_totals(fact, used, by, count)
    assert sorted(map(str, totals.select("latitude", "n").collect())) == sorted(
        map(str, together.select("latitude", "n").collect())
    )


def test_negative_zero_and_nan_coordinates_find_their_member(spark):
    rows = [list(EDGE_ROWS[0]) for _ in range(4)]
    for i, (row, latitude) in enumerate(zip(rows, ("-0.0", "0.0", "NaN", "nan"), strict=True)):
        row[0], row[6] = str(i), latitude
    detail = incidents.clean_detail(spark, edge_rows(spark, [tuple(r) for r in rows]))
    dim = incidents.dimensions()["dim_location_point"]
    fact = incidents.incident_fact(detail)
    orphans = star.foreign_key_orphans(fact, {dim.key: star.build_dimension(detail, dim)}).first()
    assert (orphans.fact_rows, orphans.orphan_rows) == (4, 0)


def test_orphans_are_counted(spark, detail):
    fact = incidents.incident_fact(detail)
    dims = {d.key: star.build_dimension(detail, d) for d in incidents.dimensions().values()}
    dims["crime_type_key"] = dims["crime_type_key"].filter("primary_type <> 'THEFT'")
    broken = {r.foreign_key: (r.orphan_keys, r.orphan_rows) for r in star.foreign_key_orphans(fact, dims).collect()}
    # THEFT on four incidents, and the NULL type is filtered as well
    assert broken["crime_type_key"] == (2, 5)
    assert broken["date_key"] == (0, 0)


def test_summary_from_fact_equals_summary_from_detail(spark, detail):
    fact = incidents.incident_fact(detail)
    dims = incidents.dimensions()
    used = {dims[n].key: star.build_dimension(detail, dims[n]) for n in ("dim_date", "dim_crime_type")}
    measures = {
        "total_crimes": F.count(F.lit(1)),
        "total_arrests": F.count_if("arrest"),
        "domestic_crimes": F.count_if("domestic"),
    }
    from_fact = star.star_totals(fact, used, incidents.SUMMARY_GRAIN, measures)
    from_detail = incidents.daily_summary(detail).drop("seven_day_rolling_avg")
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(key, from_fact.select(*from_detail.columns).collect())) == sorted(map(key, from_detail.collect()))


def test_key_grain_sums_to_the_detail(spark, detail, run_dir):
    detail.write.parquet(run_dir + "/t")
    by_key = incidents.daily_summary_by_key(spark.read.parquet(run_dir + "/t"))
    assert by_key.columns == [
        "date_key", "crime_type_key", "crime_date", "primary_type", "crime_category", "total_crimes", "total_arrests",
        "domestic_crimes", "seven_day_rolling_avg",
    ]
    assert by_key.agg(F.sum("total_crimes")).first()[0] == 10
    # grouped on natural columns; rows are not hashed before that
    plan = plan_of(by_key)
    grouped = plan[plan.index("HashAggregate(keys=[crime_date") :]
    assert "partial_count" in grouped and "sha2" not in grouped


DAILY = [
    (dt.date(2024, 1, 1), "A", "X", 5),
    (dt.date(2024, 1, 2), "A", "X", 3),
    (dt.date(2024, 1, 8), "A", "X", 3),
    (dt.date(2024, 2, 1), "B", "Y", 9),
    (dt.date(2023, 12, 31), "C", "Y", 3),
]


@pytest.fixture
def daily(spark):
    return spark.createDataFrame(DAILY, "d DATE, t STRING, c STRING, n BIGINT")


def test_totals_by_period(daily):
    found = {(r.period_unit, r.period_start): r.n for r in reports.total_by_period(daily, "d", "n").collect()}
    assert found[("week", dt.date(2024, 1, 1))] == 8  # weeks start on Monday
    assert found[("week", dt.date(2023, 12, 25))] == 3
    assert found[("month", dt.date(2024, 1, 1))] == 11
    assert found[("year", dt.date(2024, 1, 1))] == 20
    for unit in reports.PERIODS:
        assert sum(n for (u, _), n in found.items() if u == unit) == 23


def test_filters_reach_the_scan(spark, daily, run_dir):
    write_by_month(daily, run_dir + "/m", "d")
    first = F.lit("2024-01-02").cast("date")
    rows = reports.narrow(read_table(spark, run_dir + "/m"), "d", first, year=[2024], month=[1], c=["X"])
    assert sorted(r.n for r in rows.collect()) == [3, 3]
    plan = plan_of(rows)
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "GreaterThanOrEqual(d,2024-01-02)" in plan and "EqualTo(c,X)" in plan


def test_rolling_range_equals_the_trimmed_whole(spark, run_dir):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=2 * i), "AB"[i % 2], i) for i in range(60)]
    spark.createDataFrame(rows, "d DATE, t STRING, n BIGINT").write.parquet(run_dir + "/t")
    df = read_table(spark, run_dir + "/t")
    first, last = (F.lit(x).cast("date") for x in ("2024-02-01", "2024-03-01"))
    whole = summary.rolling_avg_days(df, "n", ["t"], "d", "a").filter(F.col("d").between(first, last))
    part = summary.rolling_avg_days_between(df, "n", ["t"], "d", "a", first, last)
    assert sorted(map(str, part.collect())) == sorted(map(str, whole.collect()))
    assert "GreaterThanOrEqual(d,2024-01-26)" in plan_of(part)


def test_trend(daily):
    rows = reports.trend(daily, "d", "n", ["day"], ["t"]).filter("t = 'A'").orderBy("period_start").collect()
    assert [(r.previous, r.change, r.direction) for r in rows] == [
        (None, None, None), (5, -2, "decreasing"), (3, 0, "unchanged"),
    ]


def test_top_breaks_ties_by_name(daily):
    assert [(r.t, r.n) for r in reports.top(daily, ["t"], "n", 2).collect()] == [("A", 11), ("B", 9)]
    tied = daily.filter("t <> 'B'").withColumn("n", F.lit(1)).filter("d <> DATE '2024-01-02' AND d <> DATE '2024-01-08'")
    assert [r.t for r in reports.top(tied, ["t"], "n", 1).collect()] == ["A"]
    assert "TakeOrderedAndProject" in plan_of(reports.top(daily, ["t"], "n", 2))


def test_shares_add_up(daily):
    rows = {r.c: r.share for r in reports.share(daily, ["c"], "n").collect()}
    assert rows == {"X": 11 / 23, "Y": 12 / 23}


def test_no_fact_is_lost_when_a_member_is_missing(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id INT, k STRING")
    dim = spark.createDataFrame([("a", "x")], "k STRING, name STRING")
    assert {(r.id, r.name) for r in star.denormalize(fact, {"k": dim}).collect()} == {(1, "x"), (2, None), (3, None)}
    totals = star.star_totals(fact, {"k": dim}, ["name"], {"n": F.count(F.lit(1))})
    assert {(r.name, r.n) for r in totals.collect()} == {("x", 1), (None, 2)}
    large = star.star_totals(fact, {"k": dim}, ["name"], {"n": F.count(F.lit(1))}, large=["k"])
    assert {(r.name, r.n) for r in large.collect()} == {("x", 1), (None, 2)}


def test_shares_use_no_single_partition_window(daily):
    plan = plan_of(reports.share(daily, ["c"], "n"))
    assert "Window" not in plan


def test_possible_keys_are_found_by_sketches(spark):
    df = spark.range(20_000).selectExpr("id", "id % 19000 AS near", "id % 100 AS few", "nullif(id, 5) AS gap", "cast(id AS string) AS text")
    assert set(profile.possible_keys(df)) >= {"id", "text"}
    assert not {"few", "gap"} & set(profile.possible_keys(df))
