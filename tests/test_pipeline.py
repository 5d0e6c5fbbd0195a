from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from casebook import __main__ as runner
from casebook.operators import quality
from casebook.plans import incidents, pipeline
from casebook.sinks import write_csv, write_table
from casebook.sources import MissingColumnsError, read_table, scan_landing
from tests.helpers import EDGE_ROWS, edge_rows, plan_of

NOW = "2026-01-01 00:00:00"


def now():
    return F.to_timestamp(F.lit(NOW))


def run_of(run_id="run 1/a"):
    return pipeline.new_run("incidents", run_id, "2026-01-01")


def good(spark):
    return edge_rows(spark).filter("id IN ('1', '15')")


@pytest.fixture
def zones(run_dir):
    return pipeline.Zones(run_dir + "/zones")


def land(spark, df, run_dir):
    write_csv(df, run_dir + "/landing")
    return run_dir + "/landing"


def report_text(zones):
    part = next(f for f in os.listdir(zones.report) if f.endswith(".txt"))
    with open(f"{zones.report}/{part}") as f:
        return f.read().splitlines()


def test_good_rows_pass_the_gate(spark, run_dir, zones):
    daily = pipeline.run_pipeline(spark, land(spark, good(spark), run_dir), zones, run_of(), 1, 10, now=now())
    assert daily.agg(F.sum("total_crimes")).first()[0] == 2
    # one warning for the coordinate, no failure
    history = pipeline.read_history(spark, zones)
    assert history.filter("status = 'WARN'").count() == 1
    assert history.count() == 12
    assert dict(history.dtypes)["logical_date"] == "string"


def test_gate_stops_after_writing_the_results(spark, run_dir, zones):
    landing = land(spark, edge_rows(spark), run_dir)
    with pytest.raises(pipeline.QualityError) as stopped:
        pipeline.run_pipeline(spark, landing, zones, run_of(), 1, 100, now=now())
    assert stopped.value.failed[:2] == ["null_id_count", "invalid_id_count"]
    assert "invalid_latitude_count" not in stopped.value.failed
    assert pipeline.read_history(spark, zones).count() == 12
    current = scan_landing(spark, zones.current("run 1/a"))
    assert current.columns == list(quality.RESULT_COLUMNS)
    assert [r.check_name for r in current.collect()][:2] == ["required_columns_exist", "row_count_between_expected_range"]
    assert "Total Rows: 17" in report_text(zones)
    assert not os.path.exists(zones.detail)


def test_rows_are_shuffled_once_for_the_detail(spark, run_dir, zones):
    write_table(edge_rows(spark), zones.raw)
    plan = plan_of(incidents.clean_detail(spark, read_table(spark, zones.raw)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")  # before the shuffle and after it


def test_a_run_leaves_no_intermediate_folder(spark, run_dir, zones, monkeypatch):
    made = []
    monkeypatch.setattr("casebook.session.shared_dir", lambda *a: made.append(a))
    before = set(os.listdir(tempfile.gettempdir()))
    pipeline.run_pipeline(spark, land(spark, good(spark), run_dir), zones, run_of(), 1, 10, now=now())
    pipeline.refresh(spark, zones, run_dir + "/landing", pipeline.Zones(run_dir + "/next"), run_of(), 1, 10, now=now())
    assert not made
    assert not [f for f in set(os.listdir(tempfile.gettempdir())) - before if f.startswith("casebook")]


def test_inspection_mode_goes_on(spark, run_dir, zones):
    landing = land(spark, edge_rows(spark), run_dir)
    daily = pipeline.run_pipeline(spark, landing, zones, run_of(), 1, 100, fail_on_error=False, now=now())
    assert daily.agg(F.sum("total_crimes")).first()[0] == 10
    assert read_table(spark, zones.by_month).count() == daily.count()


def test_running_again_gives_the_same_tables(spark, run_dir, zones):
    landing = land(spark, edge_rows(spark), run_dir)
    seen = []
    for _ in range(2):
        daily = pipeline.run_pipeline(spark, landing, zones, run_of(), 1, 100, fail_on_error=False, now=now())
        detail = read_table(spark, zones.detail).drop("ingestion_timestamp")
        seen.append([sorted(map(str, table.collect())) for table in (daily, detail)])
        assert pipeline.read_history(spark, zones).count() == 12
    assert seen[0] == seen[1]
    pipeline.check_quality(spark, zones, run_of("second"), 1, 100, fail_on_error=False, now=now())
    assert pipeline.read_history(spark, zones).count() == 24


def test_history_can_keep_every_attempt(spark, run_dir, zones):
    pipeline.ingest(spark, land(spark, good(spark), run_dir), zones)
    for _ in range(2):
        pipeline.check_quality(spark, zones, run_of(), 1, 10, now=now(), keep_every_attempt=True)
    assert pipeline.read_history(spark, zones).count() == 24
    pipeline.check_quality(spark, zones, run_of("other"), 1, 10, now=now())
    assert pipeline.read_history(spark, zones).count() == 36
    pipeline.check_quality(spark, zones, run_of(), 1, 10, now=now())
    assert pipeline.read_history(spark, zones).count() == 24


def test_missing_columns_stop_the_ingest_before_any_write(spark, run_dir, zones):
    landing = land(spark, good(spark).drop("arrest", "year"), run_dir)
    with pytest.raises(MissingColumnsError, match="arrest, year"):
        pipeline.ingest(spark, landing, zones)
    assert not os.path.exists(zones.raw)


def test_missing_columns_in_raw_always_stop_the_check(spark, run_dir, zones):
    write_table(good(spark).drop("arrest"), zones.raw)
    with pytest.raises(MissingColumnsError):
        pipeline.check_quality(spark, zones, run_of(), 1, 10, fail_on_error=False, now=now())
    assert pipeline.read_history(spark, zones).count() == 2
    assert report_text(zones)[-1] == "Critical failure: missing required columns."


def test_raw_zone_is_text_with_lineage(spark, run_dir, zones):
    assert pipeline.ingest(spark, land(spark, edge_rows(spark), run_dir), zones) == 17
    types = dict(read_table(spark, zones.raw).dtypes)
    assert types.pop("ingestion_timestamp") == "timestamp"
    assert set(types.values()) == {"string"} and "source_file" in types


def test_refresh_keeps_the_latest_version(spark, run_dir, zones):
    pipeline.ingest(spark, land(spark, edge_rows(spark), run_dir), zones)
    pipeline.transform(spark, zones)
    base = list(EDGE_ROWS[0])
    newer, older, fresh = (list(base) for _ in range(3))
    newer[2], newer[-1] = "ROBBERY", "2024-02-02T00:00:00.000"
    older[0], older[2], older[-1] = "2", "ROBBERY", "2024-02-02T00:00:00.000"  # id 2 was updated in March
    fresh[0] = "99"
    write_csv(edge_rows(spark, [tuple(r) for r in (newer, older, fresh, fresh)]), run_dir + "/changes")
    target = pipeline.Zones(run_dir + "/next")
    with pytest.raises(pipeline.QualityError) as stopped:  # id 99 comes twice
        pipeline.refresh(spark, zones, run_dir + "/changes", target, run_of(), now=now())
    assert stopped.value.failed == ["duplicate_id_group_count", "duplicate_record_count"]
    for _ in range(2):
        counts = pipeline.refresh(spark, zones, run_dir + "/changes", target, run_of(), fail_on_error=False, now=now())
        assert counts["detail"] == counts["fact_crime_incident"] == 11
        assert read_table(spark, target.by_month).agg(F.sum("total_crimes")).first()[0] == 11
        assert pipeline.read_history(spark, target).count() == 14  # the twelve of a load, and two on versions
        assert not os.path.exists(target.raw)
        rows = {r.id: r for r in read_table(spark, target.detail).collect()}
        assert (rows[1].primary_type, rows[1].crime_category) == ("ROBBERY", "Property Crime")
        assert rows[2].primary_type == "BATTERY" and rows[99].primary_type == "THEFT"
    assert read_table(spark, zones.detail).count() == 10


def contents(root):
    return {os.path.join(at, f): os.path.getmtime(os.path.join(at, f)) for at, _, files in os.walk(root) for f in files}


def test_refresh_never_touches_its_source(spark, run_dir, zones):
    pipeline.ingest(spark, land(spark, good(spark), run_dir), zones)
    pipeline.transform(spark, zones)
    before = contents(zones.root)
    for root in (zones.root, zones.root + "/", zones.root + "/raw", run_dir):
        with pytest.raises(ValueError, match="apart"):
            pipeline.refresh(spark, zones, run_dir + "/landing", pipeline.Zones(root), run_of(), now=now())
    write_csv(edge_rows(spark).drop("year"), run_dir + "/short")
    write_csv(edge_rows(spark), run_dir + "/bad")
    with pytest.raises(MissingColumnsError):
        pipeline.refresh(spark, zones, run_dir + "/short", pipeline.Zones(run_dir + "/next"), run_of(), now=now())
    with pytest.raises(pipeline.QualityError):
        pipeline.refresh(spark, zones, run_dir + "/bad", pipeline.Zones(run_dir + "/next"), run_of(), now=now())
    assert contents(zones.root) == before


def test_every_landing_file_must_keep_the_contract(spark, run_dir, zones):
    write_csv(good(spark), run_dir + "/a")
    write_csv(good(spark).drop("arrest"), run_dir + "/b")
    with pytest.raises(MissingColumnsError, match="arrest in .*/b/"):
        pipeline.ingest(spark, [run_dir + "/a", run_dir + "/b"], zones)


def test_large_files_land_the_same_rows(spark, run_dir, zones):
    landing = land(spark, edge_rows(spark), run_dir)
    other = pipeline.Zones(run_dir + "/other")
    assert pipeline.ingest(spark, landing, zones) == pipeline.ingest(spark, landing, other, large_files=True) == 17
    a, b = (read_table(spark, z.raw).drop("ingestion_timestamp") for z in (zones, other))
    assert a.columns == b.columns
    assert sorted(map(str, a.drop("source_file").collect())) == sorted(map(str, b.drop("source_file").collect()))


def test_star_tables(spark, run_dir, zones):
    pipeline.ingest(spark, land(spark, edge_rows(spark), run_dir), zones)
    assert pipeline.transform(spark, zones)["detail"] == 10
    rows = pipeline.build_star(spark, zones)
    assert rows["fact_crime_incident"] == 10
    assert rows["dim_time_of_day"] == 1441
    assert rows["dim_date"] == 4
    assert len(rows) == 9


def test_steps_as_jobs(spark, run_dir, monkeypatch):
    root, landing = run_dir + "/root", land(spark, good(spark), run_dir)
    monkeypatch.setenv("RAW_MIN_ROWS", "1")
    monkeypatch.setenv("RAW_MAX_ROWS", "10")
    runner.main(["ingest", "--root", root, "--landing", landing])
    runner.main(["quality", "--root", root, "--run-id", "r9"])
    runner.main(["transform", "--root", root])
    runner.main(["star", "--root", root])
    runner.main(["refresh", "--root", root, "--landing", landing, "--target", root + "-next", "--large-files"])
    assert read_table(spark, pipeline.Zones(root + "-next").daily).count() == 2
    with pytest.raises(SystemExit):
        runner.main(["refresh", "--root", root, "--landing", landing])
    zones = pipeline.Zones(root)
    assert {r.run_id for r in pipeline.read_history(spark, zones).collect()} == {"r9"}
    assert read_table(spark, zones.daily).count() == 2
    with pytest.raises(pipeline.QualityError):
        runner.main(["quality", "--root", root, "--min-rows", "5"])
    runner.main(["quality", "--root", root, "--min-rows", "5", "--fail-on-error", "false"])
