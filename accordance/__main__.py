"""Run one job, or all jobs, of a jobs table: ``spark-submit ... run_accordance.py hive jobs``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from accordance.model import Status
from accordance.operators.report import run_rollup
from accordance.plans.runner import AUDIT_TABLE, RESULTS_TABLE, run_job, run_suite
from accordance.sources.jobs import load_job
from accordance.sources.readers import read


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="accordance", description=__doc__)
    parser.add_argument("jobs_type", help="source type of the jobs table, e.g. hive or jdbc")
    parser.add_argument("jobs_location", help="its path or name")
    parser.add_argument("job_name", nargs="?", help="all jobs if left out")
    parser.add_argument("--run-id")
    parser.add_argument("--resume", action="store_true", help="go on with the run of this id, after its ended checks")
    parser.add_argument("--side-by-side", type=int, default=1, help="jobs that run at a time")
    parser.add_argument("--results-type", default="hive")
    parser.add_argument("--results-location", default=RESULTS_TABLE)
    parser.add_argument("--audit-table", default=AUDIT_TABLE)
    parser.add_argument("--report-table")
    parser.add_argument(
        "--option",
        action="append",
        default=[],
        metavar="TYPE.NAME=VALUE",
        help="reader option for a source type, e.g. jdbc.url=...",
    )
    return parser.parse_args(argv)


def reader_options(given: list[str]) -> dict[str, dict[str, str]]:
    options: dict[str, dict[str, str]] = {}
    for text in given:
        name, _, value = text.partition("=")
        source_type, _, option = name.partition(".")
        options.setdefault(source_type.lower(), {})[option] = value
    return options


def main(argv: list[str] | None = None) -> str:
    """The status of the run, which is also printed."""
    args = arguments(argv)
    # Jobs, sources and results of type hive are tables of the metastore.
    builder = SparkSession.builder.appName(f"accordance {args.job_name or ''}")
    spark = SparkSession.getActiveSession() or builder.enableHiveSupport().getOrCreate()
    options = reader_options(args.option)
    jobs = read(spark, args.jobs_type, args.jobs_location, options=options.get(args.jobs_type))
    where = dict(
        run_id=args.run_id,
        results_type=args.results_type,
        results_location=args.results_location,
        audit_table=args.audit_table,
        report_table=args.report_table,
        reader_options=options,
        resume=args.resume,
    )
    if args.job_name:
        results = run_job(spark, load_job(jobs, args.job_name), **where).check_results
    else:
        results = run_suite(spark, jobs, side_by_side=args.side_by_side, **where)
    for row in results.collect():  # a row for each check
        print(*row, sep=" | ")
    worst = {row["status"] for row in run_rollup(results).select("status").distinct().collect()}
    status = max(worst, key=Status.BY_SEVERITY.index, default=Status.SUCCESS)
    print(status)
    return status


def exit_code(status: str) -> int:
    """0 if all agrees, 2 with a warning, else 1."""
    return {Status.SUCCESS: 0, Status.WARNING: 2}.get(status, 1)


if __name__ == "__main__":
    raise SystemExit(exit_code(main()))
