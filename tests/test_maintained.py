from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from casebook.operators import maintain, merge, star
from casebook.plans import incidents, maintained, pipeline
from casebook.sinks import ConcurrentWriteError, Draft, VersionedTables, write_csv, write_table
from casebook.sources import read_table
from tests.helpers import edge_rows, plan_of

MONTHS = ("2023-12", "2024-01", "2024-02", "2024-05")
NOW = "2026-01-01 00:00:00"


def moment(rng, months=MONTHS):
    return f"{rng.choice(months)}-{rng.randrange(1, 13):02d}T{rng.randrange(24):02d}:15:00.000"


def a_row(rng, id_, months=MONTHS):
    when = rng.choice([moment(rng, months)] * 9 + [None, "not a date"])
    kind = rng.choice(["THEFT", "THEFT", "BATTERY", "ARSON", None])
    flags = rng.choice(["true", "false"]), rng.choice(["true", "false", None])
    return (str(id_), when, kind, *flags, rng.choice(["001", "002", None]), rng.choice(["41.5", "-0.0", None]), "-87.5", moment(rng, ("2024-06", "2024-07")))


def cleaned(spark, rows):
    return incidents.clean_detail(spark, edge_rows(spark, rows))


def created(spark, run_dir, rows):
    zones = pipeline.Zones(run_dir + "/zones")
    write_table(cleaned(spark, rows), zones.detail)
    return zones, maintained.create(spark, zones)


def applied(spark, zones, rows):
    write_table(cleaned(spark, rows), zones.changes)
    return maintained.apply(spark, zones, read_table(spark, zones.changes))


def bag(df, *left_out):
    names = sorted(set(df.columns) - set(left_out))
    return sorted((str(tuple(r)) for r in df.select(*names).collect()))


def test_refreshes_equal_a_rebuild(spark, run_dir):
    rng = random.Random(7)
    rows = [a_row(rng, i) for i in range(60)]
    zones, counts = created(spark, run_dir, rows)
    assert counts["detail"] == counts["fact_crime_incident"] == 60
    rebuilt = f"{run_dir}/rebuilt0"
    write_table(cleaned(spark, rows), rebuilt)
    for step in range(3):
        changes = [a_row(rng, i, rng.choice([MONTHS, MONTHS[1:2]])) for i in rng.sample(range(90), 25)]
        changes += [rows[i] for i in range(3)]
        applied(spark, zones, changes)
        merged = merge.upsert_latest(read_table(spark, rebuilt), cleaned(spark, changes), ["id"], "updated_timestamp")
        rebuilt = f"{run_dir}/rebuilt{step + 1}"
        write_table(merged, rebuilt)
    detail = read_table(spark, rebuilt)
    read = lambda name: maintained.read(spark, zones, name)
    assert bag(read("detail")) == bag(detail)
    assert bag(read("fact_crime_incident")) == bag(incidents.incident_fact(detail))
    assert bag(read("daily_summary")) == bag(incidents.daily_summary(detail))
    assert bag(read("agg_daily_crime_summary")) == bag(incidents.daily_summary_by_key(detail))
    keys = maintained._latest(read("keys"))
    assert bag(keys) == bag(detail.select("id", F.coalesce(F.date_format("crime_date", "yyyy-MM"), F.lit("none")).alias("month")))
    dims = incidents.dimensions()
    for name, dim in dims.items():
        members = read(name)
        assert members.select(dim.key).distinct().count() == members.count()
        assert set(bag(star.build_dimension(detail, dim))) <= set(bag(members))
    maintained.sweep(spark, zones)
    for name, dim in dims.items():
        assert bag(read(name)) == bag(star.build_dimension(detail, dim)) or name == "dim_time_of_day"
    assert maintained.sweep(spark, zones) == {}


def test_untouched_months_are_neither_read_nor_written(spark, run_dir, monkeypatch):
    rng = random.Random(1)
    rows = [(str(i), f"{MONTHS[i % 4]}-05T10:00:00.000", "THEFT", "true", "false", "001", "41.5", "-87.5", "2024-06-01T00:00:00.000") for i in range(40)]
    zones, _ = created(spark, run_dir, rows)
    before = maintained.tables(spark, zones)
    seen = []
    read = VersionedTables.read

    def watched(self, name, parts=None):
        df = read(self, name, parts)
        seen.append((name, df))
        return df

    monkeypatch.setattr(VersionedTables, "read", watched)
    id_ = 4 * rng.randrange(9) + 1  # of January; it moves to February
    change = (str(id_), "2024-02-07T10:00:00.000", "ARSON", "true", "false", "001", "41.5", "-87.5", "2024-07-01T00:00:00.000")
    assert applied(spark, zones, [change])["updated_changes"] == 1
    monkeypatch.undo()
    for name, df in seen:
        if name in ("detail", "fact_crime_incident"):
            months = {f.split("part=")[1].split("/")[0] for f in df.inputFiles()}
            assert months <= {"2024-01", "2024-02"}
            assert "2024-05" not in plan_of(df)
    after = maintained.tables(spark, zones)
    for name in ("detail", "fact_crime_incident"):
        changed = {m for m in before.parts(name) if before.tables[name].parts[m] != after.tables[name].parts[m]}
        assert changed == {"2024-01", "2024-02"}
    # the averages of thefts after the touched days differ in May, those of December do not
    changed = {m for m in before.parts("daily_summary") if before.tables["daily_summary"].parts[m] != after.tables["daily_summary"].parts[m]}
    assert changed == {"2024-01", "2024-02", "2024-05"}
    assert len(after.tables["dim_crime_type"].parts) == 2 and len(after.tables["dim_police_area"].parts) == 1


def test_only_new_members_are_written(spark, run_dir):
    rng = random.Random(3)
    zones, _ = created(spark, run_dir, [a_row(rng, i) for i in range(30)])
    fresh = ("100", "2025-03-03T10:00:00.000", "KIDNAPPING", "true", "false", "001", "41.5", "-87.5", "2025-04-01T00:00:00.000")
    counts = applied(spark, zones, [fresh])
    assert (counts["dim_crime_type"], counts["dim_date"], counts["dim_time_of_day"], counts["dim_civic_area"]) == (1, 1, 0, 0)
    assert (counts["inserted_changes"], counts["updated_changes"]) == (1, 0)
    again = applied(spark, zones, [fresh])
    assert again["repeated_changes"] == 1 and "detail" not in again
    older = fresh[:2] + ("ARSON",) + fresh[3:-1] + ("2025-03-01T00:00:00.000",)
    assert applied(spark, zones, [older])["stale_changes"] == 1
    assert maintained.read(spark, zones, "detail").where("id = 100").first().primary_type == "KIDNAPPING"


def test_a_failure_before_the_swap_leaves_the_old_version(spark, run_dir, monkeypatch):
    rng = random.Random(5)
    zones, _ = created(spark, run_dir, [a_row(rng, i) for i in range(30)])
    names = list(maintained.tables(spark, zones).tables)
    old = {name: bag(maintained.read(spark, zones, name)) for name in names}
    changes = [a_row(rng, i) for i in range(20, 50)]

    def stopped(self):
        raise RuntimeError("lost")

    for where in ("commit", "append"):
        monkeypatch.setattr(Draft, where, stopped if where == "commit" else lambda self, name, df: stopped(self))
        with pytest.raises(RuntimeError, match="lost"):
            applied(spark, zones, changes)
        monkeypatch.undo()
        assert {name: bag(maintained.read(spark, zones, name)) for name in names} == old
    reader = maintained.tables(spark, zones)
    counts = applied(spark, zones, changes)
    assert counts["inserted_changes"] == 20
    assert {name: bag(reader.read(name)) for name in names} == old  # a reader goes on with the version it has
    assert maintained.read(spark, zones, "detail").count() == 50
    new = {name: bag(maintained.read(spark, zones, name)) for name in names}
    assert {name: bag(maintained.read(spark, zones, name, version=1)) for name in names} == old
    removed = maintained.tables(spark, zones).vacuum()
    assert removed and maintained.tables(spark, zones).versions() == [2]
    assert {name: bag(maintained.read(spark, zones, name)) for name in names} == new
    assert sorted(os.listdir(zones.maintained)) == sorted([*names, "manifests"])
    assert maintained.tables(spark, zones).vacuum() == []


def test_a_second_writer_cannot_commit(spark, run_dir):
    df = spark.range(3).withColumn("part", F.lit("a"))
    first, second = (VersionedTables(spark, run_dir).begin() for _ in range(2))
    first.replace_parts("t", df)
    second.replace_parts("t", df)
    first.commit()
    with pytest.raises(ConcurrentWriteError):
        second.commit()
    held = VersionedTables(spark, run_dir)
    assert (held.version, held.read("t").count(), held.parts("t")) == (1, 3, ["a"])


def test_parts_may_vanish_and_tables_may_be_empty(spark, run_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, part string")
    draft = VersionedTables(spark, run_dir).begin()
    draft.replace_parts("t", df)
    draft.append("u", df.limit(0))
    held = draft.commit()
    assert held.read("u").columns == ["id", "part"] and held.read("u").count() == 0
    draft = held.begin()
    draft.replace_parts("t", df.where("id = 2"), ["a", "b"])
    held = draft.commit()
    assert (held.parts("t"), [r.id for r in held.read("t").collect()], held.read("t", ["a"]).count()) == (["b"], [2], 0)


def test_keys_are_merged(spark, run_dir, monkeypatch):
    monkeypatch.setattr(maintained, "KEY_PARTS", 2)
    rng = random.Random(9)
    zones, _ = created(spark, run_dir, [a_row(rng, i) for i in range(10)])
    for step in range(4):
        applied(spark, zones, [a_row(rng, i) for i in range(10 + step, 13 + step)])
        assert len(maintained.tables(spark, zones).tables["keys"].parts) <= 2
    detail = maintained.read(spark, zones, "detail")
    expected = detail.select("id", F.coalesce(F.date_format("crime_date", "yyyy-MM"), F.lit("none")).alias("month"))
    assert bag(maintained._latest(maintained.read(spark, zones, "keys"))) == bag(expected)
    maintained.tables(spark, zones).vacuum()
    assert maintained.read(spark, zones, "keys").count() == detail.count()


def test_several_versions_of_an_id_pass_the_gate(spark, run_dir):
    base = ("1", "2024-01-05T10:00:00.000", "THEFT", "true", "false", "001", "41.5", "-87.5", "2024-06-01T00:00:00.000")
    zones, _ = created(spark, run_dir, [base])
    run = pipeline.new_run("incidents", "r", "2026-01-01")
    versions = [(*base[:2], kind, *base[3:-1], f"2024-0{month}-01T00:00:00.000") for kind, month in (("ARSON", 7), ("BATTERY", 9), ("ROBBERY", 8))]
    write_csv(edge_rows(spark, versions), run_dir + "/changes")
    now = F.to_timestamp(F.lit(NOW))
    counts = maintained.refresh(spark, zones, run_dir + "/changes", run, now=now)
    assert (counts["updated_changes"], counts["detail"]) == (1, 1)
    assert maintained.read(spark, zones, "detail").first().primary_type == "BATTERY"
    records = {r.check_name: (r.status, r.observed_value) for r in pipeline.read_history(spark, zones).collect()}
    assert len(records) == 14
    assert records["versioned_id_count"] == ("WARN", "1") and records["superseded_version_count"] == ("WARN", "2")
    assert records["duplicate_id_group_count"] == ("PASS", "0")
    write_csv(edge_rows(spark, [versions[0], versions[0], versions[1]]), run_dir + "/twice")
    with pytest.raises(pipeline.QualityError) as stopped:
        maintained.refresh(spark, zones, run_dir + "/twice", run, now=now)
    assert stopped.value.failed == ["duplicate_id_group_count", "duplicate_record_count"]


def test_words_choose_the_same_rows_as_joins(spark):
    ids = [-(2**63), -65, -64, -1, 0, 1, 62, 63, 64, 127, 1_000_000_000, 2**63 - 1]
    df = spark.createDataFrame([(i, str(i)) for i in [*ids, *ids[:3], 2, 65, None]], "id long, word string")
    wanted = spark.createDataFrame([(i,) for i in [*ids[::2], ids[0], 3]], "id long")
    words = maintain.id_words(wanted, "id")
    assert words.count() == wanted.select(F.floor(F.col("id") / 64)).distinct().count()
    for among, how in ((True, "left_semi"), (False, "left_anti")):
        found = maintain.chosen(df, "id", words, among)
        assert found.columns == df.columns
        assert bag(found) == bag(df.join(wanted, "id", how))
    assert "Exchange hashpartitioning" not in plan_of(maintain.chosen(df, "id", words.localCheckpoint(), False))


@pytest.mark.parametrize("most", [0, maintain.MOST_WORDS])
def test_rows_that_stay_are_not_shuffled(spark, run_dir, monkeypatch, most):
    rng = random.Random(11)
    zones, _ = created(spark, run_dir, [a_row(rng, i) for i in range(80)])
    before = maintained.read(spark, zones, "detail").localCheckpoint()
    changes = [a_row(rng, i, MONTHS[:2]) for i in rng.sample(range(120), 30)]
    merged = merge.upsert_latest(before, cleaned(spark, changes), ["id"], "updated_timestamp").localCheckpoint()
    plans, replace = {}, Draft.replace_parts

    def spied(self, name, df, touched=None, **more):
        plans[name] = plan_of(df) if more.get("laid_out") else "Exchange"
        return replace(self, name, df, touched, **more)

    monkeypatch.setattr(maintain, "MOST_WORDS", most)
    monkeypatch.setattr(Draft, "replace_parts", spied)
    applied(spark, zones, changes)
    assert "Exchange" not in plans["fact_crime_incident"]
    if most:
        kept = plans["detail"].partition("Union")[2].partition("REBALANCE")[0] or plans["detail"]
        assert "Exchange hashpartitioning" not in kept.partition("BroadcastExchange")[0]
    else:
        assert plans["detail"] == "Exchange"
    assert bag(maintained.read(spark, zones, "detail")) == bag(merged)
    assert bag(maintained.read(spark, zones, "fact_crime_incident")) == bag(incidents.incident_fact(merged))


def test_detail_is_gathered_only_where_files_would_be_small(spark, run_dir, monkeypatch):
    rng = random.Random(3)
    write_table(cleaned(spark, [a_row(rng, i) for i in range(60)]), run_dir + "/detail")
    detail = read_table(spark, run_dir + "/detail")
    assert not maintained._fills_files(detail)
    assert not maintained._fills_files(detail.limit(0))
    monkeypatch.setattr(maintained, "ROWS_PER_FILE", 1)
    assert maintained._fills_files(detail)


def test_each_refresh_query_builds_its_store(spark, monkeypatch):
    from suite import refresh_queries

    built = []
    monkeypatch.setattr(refresh_queries, "refresh_all", lambda spark, sf_dir, root: built.append(root))
    for _ in range(2):
        refresh_queries.refreshed(spark, "anywhere")
    assert len(set(built)) == 2
