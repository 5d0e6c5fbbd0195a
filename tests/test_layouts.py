"""History compaction, clustered layouts, stored sketches and composite keys."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from casebook.operators import profile
from casebook.plans import history, pipeline
from casebook.sinks import Draft, read_clustered, write_clustered, write_table
from tests.helpers import edge_rows, plan_of

NOW = "2026-01-01 00:00:00"


def checked(spark, zones, date, run_id):
    run = pipeline.new_run("incidents", run_id, date)
    pipeline.check_quality(spark, zones, run, 1, 100, False, F.to_timestamp(F.lit(NOW)))


def records(spark, zones):
    return sorted(map(tuple, pipeline.read_history(spark, zones).collect()))


def test_history_is_compacted_without_a_gap(spark, run_dir, monkeypatch):
    zones = pipeline.Zones(run_dir)
    assert history.compact(spark, zones, "2030-01-01") == 0
    write_table(edge_rows(spark), zones.raw)
    for date, run_id in (("2026-01-01", "run 1/a"), ("2026-01-01", "b=%"), ("2026-01-02", "run 1/a"), ("2026-01-03", "late")):
        checked(spark, zones, date, run_id)
    before, reader = records(spark, zones), pipeline.read_history(spark, zones)
    assert len(before) == 48

    def stopped(self):
        raise RuntimeError("lost")

    monkeypatch.setattr(Draft, "commit", stopped)
    with pytest.raises(RuntimeError):
        history.compact(spark, zones, "2026-01-03")
    monkeypatch.undo()
    assert records(spark, zones) == before
    assert history.compact(spark, zones, "2026-01-03") == 36
    assert records(spark, zones) == before
    assert sorted(map(tuple, reader.collect())) == before  # one that began before the swap
    assert len(history.vacuum(spark, zones)) == 3
    assert records(spark, zones) == before
    assert history.compact(spark, zones, "2026-01-03") == 0
    files = [f for f in pipeline.read_history(spark, zones).inputFiles() if "closed" in f]
    assert len(files) == 1


def test_a_closed_run_may_be_repeated(spark, run_dir):
    zones = pipeline.Zones(run_dir)
    write_table(edge_rows(spark), zones.raw)
    for run_id in ("a", "b"):
        checked(spark, zones, "2026-01-01", run_id)
    history.compact(spark, zones, "2026-02-01")
    write_table(edge_rows(spark).limit(3), zones.raw)
    checked(spark, zones, "2026-01-01", "a")
    found = pipeline.read_history(spark, zones)
    assert found.count() == 24
    counts = {r.run_id: r.observed_value for r in found.where("check_name = 'row_count_between_expected_range'").collect()}
    assert counts == {"a": "3", "b": "17"}
    assert history.compact(spark, zones, "2026-02-01") == 12
    history.vacuum(spark, zones)
    after = pipeline.read_history(spark, zones).where("check_name = 'row_count_between_expected_range'")
    assert {r.run_id: r.observed_value for r in after.collect()} == counts


def test_clustered_extract_reads_few_files(spark, run_dir):
    rng = random.Random(1)
    rows = [(i, rng.randrange(1000) if i % 50 else None, "x" * rng.randrange(5)) for i in range(4000)] + [(9000 + i, 500, "hot") for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, at int, v string")
    assert write_clustered(df, run_dir + "/a b", "at", rows_per_file=300) == 6000

    def extract(first, last):
        return read_clustered(spark, run_dir + "/a b", "at", F.lit(first), F.lit(last))

    for first, last in ((100, 180), (500, 500), (990, 2000), (2000, 3000), (-5, 2000)):
        found = extract(first, last)
        assert sorted(r.id for r in found.collect()) == sorted(i for i, at, _ in rows if at is not None and first <= at <= last)
    everything = spark.read.parquet(run_dir + "/a b")
    assert everything.count() == 6000 and everything.columns == ["id", "at", "v"]
    assert len(extract(100, 180).inputFiles()) < len(everything.inputFiles()) / 4
    assert len(extract(500, 500).inputFiles()) > 3  # the hot value lies in several files
    assert "PushedFilters: [IsNotNull(at), GreaterThanOrEqual(at,100)" in plan_of(extract(100, 180))
    assert write_clustered(df.where("id < 10").withColumn("at", F.lit(150)), run_dir + "/a b", "at", mode="append") == 10
    assert extract(150, 150).where("id < 10").count() >= 10
    assert spark.read.parquet(run_dir + "/a b").count() == 6010


def test_files_without_a_range_are_read(spark, run_dir):
    df = spark.range(100).withColumn("at", F.col("id"))
    write_clustered(df, run_dir + "/t", "at", rows_per_file=10)
    df.where("id = 7").write.mode("append").parquet(run_dir + "/t")
    assert read_clustered(spark, run_dir + "/t", "at", F.lit(7), F.lit(7)).count() == 2


def test_sketches_of_days_merge(spark):
    rng = random.Random(4)
    rows = [(f"2024-01-{1 + i % 9:02d}", str(rng.randrange(3000)), i % 7 if i % 10 else None, float(i % 3) * -1) for i in range(9000)]
    df = spark.createDataFrame(rows, "day string, a string, b int, c double").withColumn("day", F.to_date("day"))
    sketches = profile.column_sketches(df, F.col("day"), ["a", "b", "c"])
    assert sketches.count() == 27
    merged = {r.column_name: r for r in profile.merged_profile(sketches).collect()}
    # the same whatever the grouping: days first, halves first
    halves = sketches.groupBy("column_name", (F.dayofmonth("day") > 4).alias("late")).agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.hll_union_agg("sketch").alias("sketch")
    )
    again = {r.column_name: r for r in profile.merged_profile(halves).collect()}
    assert merged == again
    assert (merged["b"].total_rows, merged["b"].null_count, merged["b"].distinct_count) == (9000, 900, 7)
    assert merged["c"].distinct_count == 3
    exact = len({r[1] for r in rows})
    assert merged["a"].distinct_count == pytest.approx(exact, rel=6 * 1.04 / 64)
    some = profile.merged_profile(sketches.where("day <= '2024-01-03'"))
    assert {r.column_name: r.total_rows for r in some.collect()} == {"a": 3000, "b": 3000, "c": 3000}


def test_smallest_keys(spark):
    rows = [(i, i // 4, i % 4, i % 40, None if i == 3 else i, i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g long, p long, m long, holes long, two long")
    assert profile.smallest_keys(df) == [("id",), ("g", "p"), ("g", "m")]
    assert profile.smallest_keys(df, ["p", "two", "m"]) == []
    assert profile.smallest_keys(df, ["g", "p", "m"], most=1) == []
    assert profile.smallest_keys(df.limit(0), ["g"]) == [("g",)]


def test_uniqueness_moves_hashes_not_values(spark, monkeypatch):
    rows = [(i, i // 2, i if i < 19_999 else 0) for i in range(20_000)]
    df = spark.createDataFrame(rows, "id long, pairs long, once long")
    looked, repeats = [], profile._repeats
    monkeypatch.setattr(profile, "_repeats", lambda some, names: looked.append(some.count()) or repeats(some, names))
    assert not profile._unique(df, ["pairs"])
    assert len(looked) == 1 and looked[0] < 1_000  # a slice tells
    looked.clear()
    assert profile._unique(df, ["id"])
    assert len(looked) == 1 and looked[0] < 1_000  # and of a key, no more values are moved
    assert not profile._unique(df, ["once"])
    assert max(looked) < 1_000


def test_uniqueness_never_rests_on_hashes(spark, monkeypatch):
    df = spark.range(300).selectExpr("id AS a", "id DIV 2 AS b")
    for few, hashed in ((100, F.lit(1).cast("long")), (2, F.pmod(F.col("k0"), F.lit(7)) * 64 + 1)):
        monkeypatch.setattr(profile, "SHOWN", few)
        monkeypatch.setattr(profile.F, "xxhash64", lambda *_, hashed=hashed: hashed)
        assert profile._unique(df, ["a"])
        assert not profile._unique(df, ["b"])
        assert profile._unique(df, ["a", "b"])
