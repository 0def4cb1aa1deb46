"""Runs the checks of a job and stores what they find."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accordance.model import CHECK_RESULT_SCHEMA, LINES, STORE, ConfigError, Job, Kind, Status
from accordance.operators.align import one_sided_columns, real_names
from accordance.operators.cells import NOT_UNIQUE, cell_diff, keys_not_unique, odd_keys
from accordance.operators.checks import record_count, schema_drift
from accordance.operators.keys import key_diff, missing_keys
from accordance.operators.report import preview, run_report, stratified_preview, tag_results
from accordance.operators.rows import digest_diff, only_counts
from accordance.operators.rules import SOURCE_VIEW, TARGET_VIEW, rule_violations
from accordance.plans.workspace import local_rows, new_folder, remove_folder, rows_of_digests, stage, stage_row_diff
from accordance.sinks.audit import append_audit, audit_events
from accordance.sinks.results import (
    cell_results,
    check_target_type,
    commit_results,
    key_results,
    malformed_results,
    row_results,
    violation_results,
)
from accordance.sources.jobs import finished_checks, normalize_jobs
from accordance.sources.readers import lines_kind, malformed_lines, of_several_lines, read

#: Keys with several rows that every task can hold.
FEW_KEYS = 50_000

# The tables written to unless others are named.
RESULTS_TABLE, AUDIT_TABLE = "recon_results", "recon_audit_log"


@dataclass
class Outcome:
    """What one check found; ``differences`` is staged and has the common result columns."""

    status: str
    message: str
    source_count: int | None = None
    target_count: int | None = None
    source_only: int | None = None
    target_only: int | None = None
    mismatch_ratio: float | None = None
    found: int = 0
    differences: DataFrame | None = None
    preview: DataFrame | None = None
    warnings: list[str] = field(default_factory=list)


@dataclass
class Run:
    """The result of one job: small tables, and a preview per check that found something."""

    run_id: str
    check_results: DataFrame
    report: DataFrame
    events: DataFrame
    previews: dict[str, DataFrame]


class _Sides:
    """The two sides of a job and the relations its checks share, each made once."""

    def __init__(self, spark: SparkSession, job: Job, options: dict[str, dict[str, str]]):
        self.spark, self.job, self.options = spark, job, options
        self.folder = new_folder(spark, "job")

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        return stage(df, name, self.folder)

    def _options(self, side: str, kind: str) -> dict[str, str]:
        return {**self.options.get((kind or "").lower(), {}), **self.job.options_of(side)}

    def _read(self, side: str, kind: str, location: str | None, query: str | None) -> DataFrame:
        return read(self.spark, kind, location, query, options=self._options(side, kind))

    def malformed(self, side: str) -> DataFrame | None:
        """The stored lines of a text side that are no rows, None if it is no text."""
        job = self.job
        kind, location = {
            "source": (job.source_type, job.source_location),
            "target": (job.target_type, job.target_location),
        }[side]
        if lines_kind(kind, location) is None or of_several_lines(self._options(side, kind)):
            return None
        lines = malformed_lines(self.spark, kind, location, options=self._options(side, kind))
        return self.stage(lines, f"{side}_lines")

    @cached_property
    def source(self) -> DataFrame:
        job = self.job
        return self._read("source", job.source_type, job.source_location, job.source_query)

    @cached_property
    def target(self) -> DataFrame:
        job = self.job
        return self._read("target", job.target_type, job.target_location, job.target_query)

    @cached_property
    def views(self) -> dict[str, DataFrame]:
        views = {SOURCE_VIEW: self.source}
        if self.job.target_type:
            views[TARGET_VIEW] = self.target
        return views

    @cached_property
    def digests_plan(self) -> DataFrame:
        return digest_diff(self.source, self.target, self.job.mapping)

    @cached_property
    def digests(self) -> DataFrame:
        """The digests of rows that differ, which say how many do."""
        return self.stage(self.digests_plan, "digests")

    @cached_property
    def rows(self) -> DataFrame:
        return self.stage(rows_of_digests(self.source, self.target, self.job.mapping, self.digests), "rows")

    @cached_property
    def only(self) -> tuple[int, int]:
        counts = self.digests.agg(*only_counts()).first()
        return counts["source_only"], counts["target_only"]

    @property
    def shares_keys(self) -> bool:
        return {"s2t", "missing_extra_records"} <= set(self.job.check_names)

    @cached_property
    def odd_keys(self) -> DataFrame:
        """Keys that are missing or not unique, for both checks that ask."""
        job = self.job
        return self.stage(odd_keys(self.source, self.target, job.mapping, job.keys), "odd_keys")

    @cached_property
    def one_sided(self) -> str | None:
        """What a comparison of whole rows leaves out, if anything."""
        only_source, only_target = one_sided_columns(self.source, self.target, self.job.mapping)
        return _left_out(only_source, only_target)

    @cached_property
    def counts(self) -> tuple[int, int]:
        counts = record_count(self.source, self.target).first()
        return counts["source_count"], counts["target_count"]


def _s2t(sides: _Sides) -> Callable[[], Outcome]:
    job = sides.job
    arguments = sides.source, sides.target, job.mapping, job.keys
    duplicates = keys_not_unique(*arguments)

    def run() -> Outcome:
        # A look at the key columns alone settles how the rows have to be compared.
        if sides.shares_keys:
            stored = sides.odd_keys.where(NOT_UNIQUE)
        else:
            stored = sides.stage(duplicates, "duplicates")
        n = stored.limit(FEW_KEYS + 1).count()
        how = {"duplicates": stored, "few_duplicates": n <= FEW_KEYS} if n else {"unique_keys": True}
        cells = sides.stage(cell_diff(*arguments, **how), "cells")
        found = cells.agg(
            F.count("*").alias("n"),
            F.count_if(F.col("kind") == Kind.MISSING_IN_TARGET).alias("source_only"),
            F.count_if(F.col("kind") == Kind.MISSING_IN_SOURCE).alias("target_only"),
        ).first()
        keys = [name for name, _ in job.keys]
        return Outcome(
            _status(found["n"]),
            f"{found['n']} differing cells and missing keys"
            if found["n"]
            else "all keys and cells agree",
            source_only=found["source_only"],
            target_only=found["target_only"],
            found=found["n"],
            differences=cell_results(cells, cells.columns[: len(keys)]),
            preview=stratified_preview(cells, 10, by=[*cells.columns[: len(keys)], "column_name"]),
        )

    return run


def _row_outcome(rows: Callable[[], DataFrame], only: tuple[int, int], agree: str) -> Outcome:
    source_only, target_only = only
    found = source_only + target_only
    if not found:  # the digests agree: no row has to be looked at
        return Outcome(Status.SUCCESS, agree, source_only=0, target_only=0)
    results = row_results(rows())
    return Outcome(
        Status.FAILURE,
        f"{source_only} rows only in the source, {target_only} only in the target",
        source_only=source_only,
        target_only=target_only,
        found=found,
        differences=results,
        preview=preview(results, 20),
    )


def _source_to_target(sides: _Sides) -> Callable[[], Outcome]:
    left_out = sides.one_sided
    sides.digests_plan  # noqa: B018 - raises for wrong columns before any job runs

    def run() -> Outcome:
        outcome = _row_outcome(lambda: sides.rows, sides.only, "source and target hold the same rows")
        if left_out:
            outcome.warnings.append(left_out)
        return outcome

    return run


def _left_out(only_source: list[str], only_target: list[str]) -> str | None:
    if not (only_source or only_target):
        return None
    return (
        f"columns differ: only in the source {only_source}, only in the target {only_target};"
        " the common columns were compared"
    )


def _failed_by(left_out: str | None, outcome: Outcome) -> Outcome:
    """Columns that were not compared make the check fail: its result says nothing of them."""
    if left_out:
        outcome.status = Status.FAILURE
        outcome.warnings.append(left_out)
    return outcome


def _business_rule(sides: _Sides) -> Callable[[], Outcome]:
    result = rule_violations(sides.views, sides.job.rule_sql)
    own_names = real_names(result, [name for name, _ in sides.job.mapping])
    named = [pair for pair, own in zip(sides.job.mapping, own_names) if own]
    digest_diff(result, sides.target, named)
    left_out = _left_out(*one_sided_columns(result, sides.target, named))

    def run() -> Outcome:
        # A rule may give other rows each time it is run, so its result is stored.
        rows, digests = stage_row_diff(sides.stage(result, "rule"), sides.target, named, sides.folder)
        only = tuple(digests.agg(*only_counts()).first())
        return _failed_by(left_out, _row_outcome(lambda: rows, only, "the rule gives the target's rows"))

    return run


def _sql(sides: _Sides) -> Callable[[], Outcome]:
    plan = violation_results(rule_violations(sides.views, sides.job.rule_sql))

    def run() -> Outcome:
        rows = sides.stage(plan, "violations")
        found = rows.count()
        message = f"{found} rows violate the rule" if found else "no row violates the rule"
        return Outcome(
            _status(found), message, found=found, differences=rows, preview=preview(rows)
        )

    return run


def _record_count(sides: _Sides) -> Callable[[], Outcome]:
    record_count(sides.source, sides.target)

    def run() -> Outcome:
        source, target = sides.counts
        message = (
            f"both sides have {source} rows"
            if source == target
            else f"the source has {source} rows, the target {target}"
        )
        return Outcome(
            _status(source != target), message, source_count=source, target_count=target
        )

    return run


def _missing_extra(sides: _Sides) -> Callable[[], Outcome]:
    plan = key_diff(sides.source, sides.target, sides.job.keys)

    def run() -> Outcome:
        keys = missing_keys(sides.odd_keys, sides.job.keys) if sides.shares_keys else sides.stage(plan, "keys")
        in_target, in_source = keys.agg(
            F.count_if(F.col("kind") == Kind.MISSING_IN_TARGET),
            F.count_if(F.col("kind") == Kind.MISSING_IN_SOURCE),
        ).first()
        found = in_target + in_source
        return Outcome(
            _status(found),
            f"{in_target} keys missing in the target, {in_source} in the source"
            if found
            else "all keys are on both sides",
            source_only=in_target,
            target_only=in_source,
            found=found,
            differences=key_results(keys),
            preview=preview(key_results(keys), 20),
        )

    return run


def _threshold(sides: _Sides) -> Callable[[], Outcome]:
    sides.digests_plan  # noqa: B018 - raises for wrong columns before any job runs
    limit = sides.job.threshold or 0.0
    left_out = sides.one_sided

    def run() -> Outcome:
        (source_only, target_only), (source, target) = sides.only, sides.counts
        ratio = (source_only + target_only) / max(source + target, 1)
        outcome = Outcome(
            Status.SUCCESS if ratio <= limit else Status.FAILURE,
            f"{source_only} of {source} source rows and {target_only} of {target} target rows"
            f" differ, the limit is {limit}",
            source_count=source,
            target_count=target,
            source_only=source_only,
            target_only=target_only,
            mismatch_ratio=ratio,
        )
        return _failed_by(left_out, outcome)

    return run


def _schema_drift(sides: _Sides) -> Callable[[], Outcome]:
    plan = schema_drift(sides.source, sides.target, sides.job.mapping)

    def run() -> Outcome:
        drift = sides.stage(plan, "drift")
        found = drift.count()
        message = f"{found} columns drifted" if found else "names and types agree"
        return Outcome(
            Status.WARNING if found else Status.SUCCESS,
            message,
            found=found,
            preview=preview(drift, 20),
        )

    return run


_RUNNERS = {
    "s2t": _s2t,
    "sql": _sql,
    "source_to_target": _source_to_target,
    "business_rule": _business_rule,
    "record_count": _record_count,
    "missing_extra_records": _missing_extra,
    "threshold": _threshold,
    "schema_drift": _schema_drift,
}


class _Journal:
    """The events of a run, written as they come if the job wants an audit."""

    def __init__(self, spark: SparkSession, job: Job, run_id: str, table: str):
        self.spark, self.job, self.run_id, self.table = spark, job, run_id, table
        self.events: list[tuple] = []
        self.last = datetime.min.replace(tzinfo=timezone.utc)

    def log(self, *told: tuple[str, str, str]) -> None:
        """(check, status, message), written together."""
        for name, status, message in told:
            # No two events have one time, so that their order can be read back.
            self.last = max(datetime.now(timezone.utc), self.last + timedelta(microseconds=1))
            self.events.append((self.job.job_name, self.run_id, name, status, message, self.last))
        if _yes(self.job.write_audit):
            append_audit(audit_events(self.spark, self.events[-len(told) :]), self.table)


def run_job(
    spark: SparkSession,
    job: Job,
    run_id: str | None = None,
    results_type: str = "hive",
    results_location: str = RESULTS_TABLE,
    audit_table: str = AUDIT_TABLE,
    report_table: str | None = None,
    reader_options: dict[str, dict[str, str]] | None = None,
    resume: bool = False,
) -> Run:
    """Run the checks of one job in listed order.

    A wrong job raises ``ConfigError`` before any data is read.  Trouble with the data makes
    that check an ERROR and does not stop the next one.  If the job says so, audit events are written as
    checks start and end, and the difference rows of each check when it ends; the report if a table is named for it.

    ``resume`` goes on with the run of this ``run_id``: checks that its audit knows as ended, and stored, are
    reported as they ended then and not run again.  Counts are not in the audit and stay null.
    """
    job.validate()
    check_target_type(results_type)
    if resume and not (run_id and _yes(job.write_audit)):
        raise ConfigError(f"{job.job_name}: only a run with a run_id and an audit can be resumed")
    ended = {}
    if resume and spark.catalog.tableExists(audit_table):
        ended = finished_checks(spark.table(audit_table), job.job_name, run_id)
    run_id = run_id or uuid.uuid4().hex
    sides = _Sides(spark, job, reader_options or {})
    planned = [(name, _plan(name, sides)) for name in job.check_names]
    journal = _Journal(spark, job, run_id, audit_table)
    results, previews = [], {}

    def report_of(name: str, outcome: Outcome) -> None:
        counts = outcome.source_count, outcome.target_count, outcome.source_only, outcome.target_only
        results.append((job.job_name, run_id, name, outcome.status, *counts, outcome.mismatch_ratio, outcome.message))

    def store(name: str, outcome: Outcome, start: int) -> None:
        """The check's rows in place of those of its earlier runs; trouble is a result of its own."""
        if not _yes(job.write_results):
            return
        try:
            rows = None
            if outcome.differences is not None and outcome.found:
                rows = tag_results(
                    outcome.differences, job.job_name, name, outcome.status, start, _now_ms(),
                    outcome.source_count, record_count=outcome.found,
                ).withColumn("run_id", F.lit(run_id))
            commit_results(rows, results_type, results_location, job.job_name, name, run_id)
        except Exception as error:  # noqa: BLE001 - the findings stay, with the trouble
            told = Outcome(Status.ERROR, f"{name}: {_message(error)}")
            journal.log((STORE, told.status, told.message))
            report_of(STORE, told)

    def run_check(name: str, plan: Callable[[], Outcome]) -> None:
        start = _now_ms()
        journal.log((name, Status.STARTED, f"started {name}"))
        try:
            outcome = plan()
            for warning in outcome.warnings:
                outcome.message += f"; {warning}"
                if outcome.status == Status.SUCCESS:
                    outcome.status = Status.WARNING
            if outcome.found and outcome.preview is not None:
                previews[name] = local_rows(outcome.preview)
            if name != LINES and wrong_lines:
                outcome.status = Status.ERROR
                outcome.message += f"; {wrong_lines}"
        except Exception as error:  # noqa: BLE001 - a check's trouble is its result
            outcome = Outcome(Status.ERROR, _message(error))
        report_of(name, outcome)
        # What broke off leaves the rows of the check's last complete run in force.
        if outcome.differences is not None or outcome.status != Status.ERROR:
            store(name, outcome, start)
        warnings = [(name, Status.WARNING, warning) for warning in outcome.warnings]
        journal.log(*warnings, (name, outcome.status, outcome.message))

    wrong_lines = ""
    try:
        todo = [(name, plan) for name, plan in planned if name not in ended]
        if todo:
            lines = _look_at_lines(sides)
            if lines is not None:
                run_check(LINES, lambda: lines)
                wrong_lines = lines.message
        for name, plan in planned:
            if name in ended:
                report_of(name, Outcome(*ended[name]))
            else:
                run_check(name, plan)
    finally:
        remove_folder(spark, sides.folder)

    check_results = spark.createDataFrame(results, CHECK_RESULT_SCHEMA)
    flags = spark.createDataFrame(
        [(job.job_name, job.notify_on_success, job.notify_on_failure)],
        "job_name string, notify_on_success string, notify_on_failure string",
    )
    report = run_report(check_results, flags)
    if report_table:
        report.coalesce(1).write.mode("append").saveAsTable(report_table)
    return Run(run_id, check_results, report, audit_events(spark, journal.events), previews)


def _look_at_lines(sides: _Sides) -> Outcome | None:
    """The lines of text sides that are no rows, as an ERROR; None if there are none.

    A side that can't be read at all is left to the checks, which say so.
    """
    found, counts = [], {}
    for side in ("source", "target"):
        if side == "target" and not sides.job.target_type:
            continue
        try:
            lines = sides.malformed(side)
        except Exception:  # noqa: BLE001 - each check that reads the side reports it
            continue
        if lines is not None and (n := lines.count()):
            counts[side] = n
            found.append(malformed_results(lines, side))
    if not found:
        return None
    rows = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    told = " and ".join(f"{n} malformed lines in the {side}" for side, n in counts.items())
    return Outcome(
        Status.ERROR, told, source_only=counts.get("source", 0), target_only=counts.get("target", 0),
        found=sum(counts.values()), differences=rows, preview=preview(rows, 20),
    )


def run_suite(
    spark: SparkSession, jobs: DataFrame, run_id: str | None = None, side_by_side: int = 1, **options
) -> DataFrame:
    """Run all jobs of a jobs table: one row per job and check.

    All jobs are validated before the first one runs, and no name may be listed twice.  A job whose columns turn
    out to be wrong gets ERROR rows and does not stop the others.

    With ``side_by_side`` above one, as many jobs run at a time, each in a session of its own with the settings of this one
    and in a scheduler pool of its own, so that views of one name do not meet.  Temporary views of this session are not there.
    """
    run_id = run_id or uuid.uuid4().hex
    check_target_type(options.get("results_type", "hive"))
    todo = [Job.from_row(row).validate() for row in normalize_jobs(jobs).collect()]
    twice = sorted(name for name, n in Counter(job.job_name for job in todo).items() if n > 1)
    if twice:
        raise ConfigError(f"jobs configured more than once: {', '.join(map(repr, twice))}")
    todo.sort(key=lambda j: j.job_name)

    def results_of(job: Job) -> list:
        own = spark if side_by_side <= 1 else _session_like(spark)
        if own is not spark:
            own.sparkContext.setLocalProperty("spark.scheduler.pool", job.job_name)
        try:
            return run_job(own, job, run_id, **options).check_results.collect()
        except ConfigError as error:
            return [
                (job.job_name, run_id, name, Status.ERROR, *[None] * 5, str(error))
                for name in job.check_names
            ]

    if side_by_side <= 1:
        results = [row for job in todo for row in results_of(job)]
    else:
        with ThreadPoolExecutor(side_by_side) as pool:
            results = [row for rows in pool.map(results_of, todo) for row in rows]
    return spark.createDataFrame(results, CHECK_RESULT_SCHEMA)


def _session_like(spark: SparkSession) -> SparkSession:
    """A new session with the runtime settings of this one."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return own


def _plan(name: str, sides: _Sides) -> Callable[[], Outcome]:
    """Build a check; what cannot be read or analyzed fails when the check is run."""
    try:
        return _RUNNERS[name](sides)
    except ConfigError:
        raise
    except Exception as error:  # noqa: BLE001 - reported as the check's result
        failure = error

        def fail() -> Outcome:
            raise failure

        return fail


def _status(found) -> str:
    return Status.FAILURE if found else Status.SUCCESS


def _yes(flag: str | None) -> bool:
    return (flag or "").strip().upper() == "Y"


def _now_ms() -> int:
    return int(datetime.now(timezone.utc).timestamp() * 1000)


def _message(error: Exception) -> str:
    return str(error).strip() or type(error).__name__
