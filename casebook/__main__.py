"""``python -m casebook <step> --root ...``: one step of the pipeline as a batch job."""

from __future__ import annotations

import argparse
import os

from casebook.plans import history, incidents, maintained, pipeline
from casebook.session import build_session, shuffle_settings

# The variables that set the defaults of the gate.
MIN_ROWS_VARIABLE, MAX_ROWS_VARIABLE, FAIL_VARIABLE = "RAW_MIN_ROWS", "RAW_MAX_ROWS", "FAIL_ON_DQ_ERROR"

STEPS = ("ingest", "quality", "transform", "star", "pipeline", "refresh", "maintain", "update", "sweep", "compact")


def is_yes(text: str) -> bool:
    return text.strip().lower() == "true"


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="casebook")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--root", required=True, help="folder of all zones")
    parser.add_argument("--landing", nargs="*", help="landing CSV files or folders")
    parser.add_argument("--dataset", default="incidents")
    parser.add_argument("--run-id", default="manual_run")
    parser.add_argument("--logical-date", help="defaults to today in UTC")
    parser.add_argument("--target", help="root of the refreshed tables, apart from --root")
    parser.add_argument("--min-rows", type=int, help="fewest rows that pass the gate; of the changes in a refresh or update, 1 by default")
    parser.add_argument("--max-rows", type=int, default=int(os.getenv(MAX_ROWS_VARIABLE, incidents.MAX_RAW_ROWS)))
    parser.add_argument("--fail-on-error", type=is_yes, default=is_yes(os.getenv(FAIL_VARIABLE, "true")), help="true or false")
    parser.add_argument("--keep-versions", type=int, default=2, help="versions of the maintained tables that a sweep leaves to readers")
    parser.add_argument("--large-files", action="store_true", help="read each landing file with many tasks")
    parser.add_argument("--shuffle-gb", type=float, help="expected shuffle size, sets partition counts")
    parser.add_argument("--cores", type=int, default=8, help="executor cores, used with --shuffle-gb")
    args = parser.parse_args(argv)
    if args.step == "refresh" and not args.target:
        parser.error("refresh needs --target")
    if args.step in ("ingest", "pipeline", "refresh", "update") and not args.landing:
        parser.error(f"{args.step} needs --landing")
    if args.min_rows is None:
        args.min_rows = 1 if args.step in ("refresh", "update") else int(os.getenv(MIN_ROWS_VARIABLE, incidents.MIN_RAW_ROWS))
    return args


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    conf = shuffle_settings(int(args.shuffle_gb * 10**9), args.cores) if args.shuffle_gb else None
    spark = build_session(f"casebook-{args.step}", conf=conf)
    zones = pipeline.Zones(args.root, args.dataset)
    run = pipeline.new_run(args.dataset, args.run_id, args.logical_date)
    gate = {"min_rows": args.min_rows, "max_rows": args.max_rows, "fail_on_error": args.fail_on_error}
    if args.step == "ingest":
        print("rows loaded:", pipeline.ingest(spark, args.landing, zones, large_files=args.large_files))
    elif args.step == "quality":
        pipeline.check_quality(spark, zones, run, **gate).orderBy("check_no").show(100, truncate=False)
    elif args.step == "transform":
        print("rows written:", pipeline.transform(spark, zones))
    elif args.step == "star":
        print("rows written:", pipeline.build_star(spark, zones))
    elif args.step == "refresh":
        target = pipeline.Zones(args.target, args.dataset)
        print("rows written:", pipeline.refresh(spark, zones, args.landing, target, run, large_files=args.large_files, **gate))
    elif args.step == "maintain":
        print("rows written:", maintained.create(spark, zones))
    elif args.step == "update":
        print("rows written:", maintained.refresh(spark, zones, args.landing, run, large_files=args.large_files, **gate))
    elif args.step == "sweep":
        print("members left:", maintained.sweep(spark, zones))
        print("folders removed:", len(maintained.tables(spark, zones).vacuum(args.keep_versions)))
    elif args.step == "compact":
        print("records compacted:", history.compact(spark, zones, run.logical_date))
        print("folders removed:", len(history.vacuum(spark, zones)))
    else:
        daily = pipeline.run_pipeline(spark, args.landing, zones, run, large_files=args.large_files, **gate)
        print("daily summary rows:", daily.count())


if __name__ == "__main__":
    main()
