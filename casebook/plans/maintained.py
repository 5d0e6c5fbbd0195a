"""Detail, summaries and star schema kept up month by month.

The tables lie in parts by month and are versioned (``casebook.sinks.versions``). A refresh reads and writes the months
that its changes touch, and shares the others with the version before; the new version is seen at once, when all its
tables are written. What a failed refresh leaves behind is written over when it is run again.

* ``keys`` tells the month of every id, so that the old versions of changed ids are found without scanning the detail.
  It is sorted by id, read for the range of changed ids only, and grows by one sorted part per refresh until
  ``KEY_PARTS`` of them are merged.
* Detail and fact: rows of changed ids are replaced in the months that they leave and enter. Rows that stay are written
  by the tasks that read them, and the fact is taken from the detail's new files, month by month: neither is shuffled.
* Summaries: old versions are taken out of the counts, new ones put in; trailing averages are taken anew for the types
  that changed, and months whose averages changed by that are written as well.
* ``column_sketches`` has a mergeable sketch of each profiled column and day, so that ``profile_of`` reads no detail; those
  of touched months are taken anew.
* Dimensions: members that are new are added, in a part of their own. A member whose last incident is changed stays,
  until ``sweep`` removes members that no incident refers to.

All results are those of a full rebuild from the same rows, but for members that wait for ``sweep``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.operators import maintain, profile, quality, star, summary
from casebook.plans import incidents, pipeline
from casebook.sinks import PART, Draft, VersionedTables, write_table
from casebook.sources import read_table

DETAIL, FACT, DAILY, BY_KEY, KEYS = "detail", "fact_crime_incident", "daily_summary", "agg_daily_crime_summary", "keys"
SKETCHES = "column_sketches"
PROFILED = (
    "case_number",
    "block",
    "iucr",
    "primary_type",
    "description",
    "location_description",
    "beat",
    "district",
    "ward",
    "community_area",
    "crime_category",
)
KEY_PARTS = 16
ROWS_PER_FILE = 100_000
LINEAGE = ("ingestion_timestamp", "source_file")
AVERAGE = "seven_day_rolling_avg"
KEY_GRAIN = ("date_key", "crime_type_key", *incidents.SUMMARY_GRAIN)

# Per summary: its grain, and the group whose days the averages follow.
SUMMARIES = {DAILY: (incidents.SUMMARY_GRAIN, "primary_type"), BY_KEY: (KEY_GRAIN, "crime_type_key")}


def tables(spark: SparkSession, zones: pipeline.Zones, version: int | None = None) -> VersionedTables:
    return VersionedTables(spark, zones.maintained, version)


def read(spark: SparkSession, zones: pipeline.Zones, name: str, version: int | None = None) -> DataFrame:
    return tables(spark, zones, version).read(name)


def read_daily(spark: SparkSession, zones: pipeline.Zones) -> DataFrame:
    """The daily summary with year and month, as ``write_by_month`` lays it out."""
    return read(spark, zones, DAILY).withColumns({"year": F.year("crime_date"), "month": F.month("crime_date")})


def _by_month(df: DataFrame, moment: str) -> DataFrame:
    return df.withColumn(PART, maintain.month_of(F.col(moment)))


def _counts(name: str, rows: DataFrame) -> DataFrame:
    """Counts of one summary without averages."""
    if name == BY_KEY:
        return incidents.counts_by_key(rows)
    return summary.summarize(rows, incidents.SUMMARY_GRAIN, incidents.summary_flags(), "total_crimes")


def _by_id(keys: DataFrame) -> DataFrame:
    return keys.repartitionByRange("id").sortWithinPartitions("id")


def create(spark: SparkSession, zones: pipeline.Zones) -> dict[str, int]:
    """The first version (or a rebuilt one), from the stored detail. Returns rows per table."""
    detail = read_table(spark, zones.detail)
    draft = tables(spark, zones).begin()
    draft.replace_parts(DETAIL, _by_month(detail, "crime_date"), laid_out=_fills_files(detail))
    placed = detail.select("id", maintain.month_of(F.col("crime_date")).alias("month"), F.lit(draft.version).alias("since"))
    draft.replace(KEYS, _by_id(placed))
    draft.replace_parts(FACT, _fact(draft, draft.tables[DETAIL].parts), laid_out=True)
    for name, build in ((DAILY, incidents.daily_summary), (BY_KEY, incidents.daily_summary_by_key)):
        draft.replace_parts(name, _by_month(build(detail), "crime_date"))
    for name, dim in incidents.dimensions().items():
        draft.replace(name, star.build_dimension(detail, dim))
    draft.replace_parts(SKETCHES, _sketches(draft.read(DETAIL, draft.tables[DETAIL].parts)))
    draft.commit()
    return draft.rows


def _fills_files(detail: DataFrame) -> bool:
    """Whether a task's rows of a month fill a file on the whole, so that months need not be gathered. Reads the dates alone."""
    held = detail.select(F.spark_partition_id().alias("task"), maintain.month_of(F.col("crime_date")).alias("month"))
    files, rows = held.groupBy("task", "month").count().agg(F.count(F.lit(1)), F.sum("count")).first()
    return files > 0 and rows >= files * ROWS_PER_FILE


def _fact(draft: Draft, months: Iterable[str]) -> DataFrame:
    """The fact of some months, from the draft's detail: a projection of files that hold a month each."""
    return _by_month(incidents.incident_fact(draft.read(DETAIL, months)), "crime_timestamp")


def _sketches(detail: DataFrame) -> DataFrame:
    return _by_month(profile.column_sketches(detail, F.col("crime_date"), PROFILED), "day")


def profile_of(spark: SparkSession, zones: pipeline.Zones, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows, NULLs and estimated distinct values per profiled column, of all days or of those from ``first`` to ``last``."""
    held = tables(spark, zones)
    if first is None or last is None:
        return profile.merged_profile(held.read(SKETCHES))
    months = [m for m in held.parts(SKETCHES) if first[:7] <= m <= last[:7]]
    days = F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return profile.merged_profile(held.read(SKETCHES, months).where(days))


def _months(df: DataFrame, *names: str) -> list[str]:
    """The distinct months in the named columns: no more than the calendar has."""
    months = F.explode(F.array_distinct(F.array(*names)))
    return sorted(r[0] for r in df.select(months.alias("m")).where("m is not null").distinct().collect())


def _latest(keys: DataFrame) -> DataFrame:
    return keys.groupBy("id").agg(F.max_by("month", "since").alias("month"))


def _words(spark: SparkSession, draft: Draft, name: str, ids: DataFrame) -> DataFrame | None:
    """The ids as stored words, or None if they are too many to be broadcast."""
    path = draft.path(name)
    few = write_table(maintain.id_words(ids, "id"), path) <= maintain.MOST_WORDS
    return read_table(spark, path) if few else None


def outcome(spark: SparkSession, held: VersionedTables, changes: DataFrame, draft: Draft | None = None) -> DataFrame:
    """What each of the changes, one row per id, does to the detail. Reads keys in their range, and the months that hold them.

    With a draft, the known ids are kept beside it, and of the detail only rows with such ids are shuffled.
    """
    low, high = changes.agg(F.min("id"), F.max("id")).first()
    ids = changes.select("id")
    known = _latest(maintain.in_range(held.read(KEYS), "id", low, high).join(ids, "id", "left_semi"))
    if draft is not None:
        path = draft.path("known")
        write_table(known, path)
        known = read_table(spark, path)
    months = _months(known, "month")
    base = maintain.in_range(held.read(DETAIL, months), "id", low, high)
    words = None if draft is None else _words(spark, draft, "known_words", known)
    old = base.join(ids, "id", "left_semi") if words is None else maintain.chosen(base, "id", words, True)
    found = maintain.outcome_of(changes.select(*base.columns), old, "id", "updated_timestamp", LINEAGE)
    return found.withColumns(
        {"old_month": F.when(F.col("old").isNotNull(), maintain.month_of(F.col("old.crime_date"))), "new_month": maintain.month_of(F.col("new.crime_date"))}
    )


def apply(spark: SparkSession, zones: pipeline.Zones, changes: DataFrame) -> dict[str, int]:
    """Applies clean, stored changes, one row per id. Returns how many did what, and rows written per table."""
    held = tables(spark, zones)
    draft = held.begin()
    path = draft.path("outcome")
    all_ = outcome(spark, held, changes, draft)
    # versions that change nothing are counted only
    takes_part = F.col("outcome").isin("inserted", "updated")
    write_table(all_.withColumns({c: F.when(takes_part, F.col(c)) for c in ("old", "new")}), path)
    found = read_table(spark, path)
    counts = {f"{r[0]}_changes": r[1] for r in found.groupBy("outcome").count().collect()}
    applied = found.where(F.col("outcome").isin("inserted", "updated"))
    months = _months(applied, "old_month", "new_month")
    if not months:
        return {n: 0 for n in ("inserted_changes", "updated_changes")} | counts
    added = applied.select("new.*")
    removed = applied.where("old is not null").select("old.*")
    _replace_detail(spark, held, draft, added, removed.select("id"), months)
    draft.replace_parts(SKETCHES, _sketches(draft.read(DETAIL, months)), months)
    draft.replace_parts(FACT, _fact(draft, months), months, laid_out=True)
    for name, (grain, kind) in SUMMARIES.items():
        _refresh_summary(spark, held, draft, name, added, removed, grain, kind)
    for name, dim in incidents.dimensions().items():
        members = star.build_dimension(added, dim)
        draft.append(name, maintain.new_members(members, held.read(name), dim.key))
    moved = applied.where(~F.col("old_month").eqNullSafe(F.col("new_month")))
    draft.append(KEYS, _by_id(moved.select("id", F.col("new_month").alias("month"), F.lit(draft.version).alias("since"))))
    _merge_keys(spark, held, draft)
    draft.commit()
    return {"inserted_changes": 0, "updated_changes": 0} | counts | draft.rows


def _replace_detail(spark: SparkSession, held: VersionedTables, draft: Draft, added: DataFrame, gone: DataFrame, months: Sequence[str]) -> None:
    stored, words = held.read(DETAIL, months), _words(spark, draft, "gone_words", gone)
    if words is None:
        kept = stored.join(gone, "id", "left_anti").select(*added.columns)
        draft.replace_parts(DETAIL, _by_month(kept.unionByName(added), "crime_date"), months)
        return
    # what stays lies in files of a month each; only new rows are gathered
    kept = maintain.chosen(stored, "id", words, False).select(*added.columns)
    fresh = _by_month(added, "crime_date").hint("rebalance", PART)
    draft.replace_parts(DETAIL, _by_month(kept, "crime_date").unionByName(fresh), months, laid_out=True)


def _refresh_summary(
    spark: SparkSession, held: VersionedTables, draft: Draft, name: str, added: DataFrame, removed: DataFrame, grain: Sequence[str], kind: str
) -> None:
    measures = incidents.SUMMARY_MEASURES
    path, groups_path = draft.path(f"{name}_delta"), draft.path(f"{name}_groups")
    write_table(maintain.summary_delta(_counts(name, added), _counts(name, removed), grain, measures), path)
    delta = read_table(spark, path)
    stored = held.read(name)
    groups = maintain.updated_groups(stored, delta, grain, measures, kind, "crime_date", AVERAGE)
    write_table(_by_month(groups, "crime_date"), groups_path)
    groups = read_table(spark, groups_path)
    month = maintain.month_of(F.col("crime_date"))
    touched = sorted({*_months(delta.select(month.alias("m")), "m"), *_months(groups.where("changed"), PART)})
    # a group's rows are read and summed anew in all months, but only touched months are written
    others = maintain.other_groups(held.read(name, touched), delta, kind).select(*[f.name for f in held.schema(name).fields])
    mine = groups.where(F.col(PART).isin(touched)).select(*others.columns)
    draft.replace_parts(name, _by_month(others.unionByName(mine), "crime_date"), touched)


def _merge_keys(spark: SparkSession, held: VersionedTables, draft: Draft) -> None:
    parts = draft.tables[KEYS].parts
    if len(parts) <= KEY_PARTS:
        return
    all_ = spark.read.schema(held.schema(KEYS)).parquet(*[f"{held.root}/{f}" for f in parts.values()])
    merged = _latest(all_).withColumn("since", F.lit(draft.version))
    # beside the part that this draft has just written and that is read here
    folder = f"{KEYS}_merged/v{draft.version:08d}"
    write_table(_by_id(merged.select("id", "month", "since")), f"{held.root}/{folder}")
    draft.tables[KEYS] = type(draft.tables[KEYS])(draft.tables[KEYS].schema, {f"{draft.version:08d}": folder})


def refresh(
    spark: SparkSession,
    zones: pipeline.Zones,
    landing: str | Sequence[str],
    run: quality.Run,
    min_rows: int = 1,
    max_rows: int = incidents.MAX_RAW_ROWS,
    fail_on_error: bool = True,
    now: Column | None = None,
    category_of_type: Mapping[str, str] = incidents.CATEGORY_OF_TYPE,
    large_files: bool = False,
) -> dict[str, int]:
    """Lands changes in their own zone, checks them, and applies the latest version of each id."""
    pipeline.ingest(spark, landing, zones, large_files=large_files, raw=zones.raw_changes)
    pipeline.check_quality(spark, zones, run, min_rows, max_rows, fail_on_error, now, raw=zones.raw_changes, suite_of=incidents.changes_suite)
    changes = incidents.clean_detail(spark, read_table(spark, zones.raw_changes), category_of_type)
    write_table(changes, zones.changes)
    return apply(spark, zones, read_table(spark, zones.changes))


def sweep(spark: SparkSession, zones: pipeline.Zones) -> dict[str, int]:
    """Removes members that no incident refers to; returns the members left of each dimension that is written anew.

    One pass over the fact's keys, each combined before its shuffle. Members that exist unobserved are kept.
    """
    held = tables(spark, zones)
    draft = held.begin()
    fact = held.read(FACT)
    for name, dim in incidents.dimensions().items():
        members = held.read(name)
        used = fact.select(dim.key).distinct()
        if dim.members is not None:
            always = dim.members(members).select(*dim.natural)
            used = used.union(star.keyed(always, dim).select(dim.key)).distinct()
        if not members.join(used, dim.key, "left_anti").isEmpty():
            draft.replace(name, members.join(used, dim.key, "left_semi").select(*members.columns))
    if draft.rows:
        draft.commit()
    return draft.rows
