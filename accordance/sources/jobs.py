"""The jobs table and the audit table, read as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordance.model import JOBS_SCHEMA, STORE, ConfigError, Job, Status


def job_lookup(jobs: DataFrame, job_name: str) -> DataFrame:
    """The rows of one job; the name is a value in a predicate, never query text."""
    return jobs.where(F.col("job_name") == F.lit(job_name))


def load_job(jobs: DataFrame, job_name: str) -> Job:
    rows = job_lookup(normalize_jobs(jobs), job_name).take(2)
    if not rows:
        raise ConfigError(f"no configuration found for job {job_name!r}")
    if len(rows) > 1:
        raise ConfigError(f"job {job_name!r} is configured more than once")
    return Job.from_row(rows[0])


def audit_for_run(audit: DataFrame, run_id: str) -> DataFrame:
    """The audit events of one run."""
    return audit.where(F.col("run_id") == F.lit(run_id))


def finished_checks(audit: DataFrame, job_name: str, run_id: str) -> dict[str, tuple[str, str]]:
    """Status and message of the checks of a run that came to an end other than an ERROR, and were stored.

    A check that was only started, or started again since, has not ended.
    """
    events = audit_for_run(audit, run_id).where(F.col("job_name").eqNullSafe(F.lit(job_name)))
    ended: dict[str, tuple[str, str]] = {}
    unstored = set()
    for e in events.orderBy("event_ts").collect():  # a few events for each check of one run
        name = e["recon_type"]
        if name == STORE:  # told before the check's own end
            unstored.add(e["message"].partition(":")[0])
        elif e["status"] == Status.STARTED:
            unstored.discard(name)
            ended.pop(name, None)
        elif e["status"] == Status.ERROR or name in unstored:
            ended.pop(name, None)
        else:
            ended[name] = e["status"], e["message"]
    return ended


def normalize_jobs(jobs: DataFrame) -> DataFrame:
    """A jobs table of any of the three known layouts, in the library's own.

    Known are the library's layout, the flat one with ``recon_type`` and ``sql_query``, and
    the one in camel case with ``reconTypes``.  Columns with no meaning here are left out.
    """
    have = {c.lower() for c in jobs.columns}
    if "recontypes" in have:
        hive_source = F.lower("sourceType") == "hive"
        hive_target = F.lower("targetType") == "hive"
        columns = {
            "job_name": F.col("jobName"),
            "source_type": F.when(
                F.col("sourceQuery").isNotNull(), F.lit("query")
            ).otherwise(F.col("sourceType")),
            "source_location": F.when(
                hive_source, F.col("sourceTable")
            ).otherwise(F.coalesce("sourcePath", "sourceTable")),
            "source_query": F.col("sourceQuery"),
            "target_type": F.col("targetType"),
            "target_location": F.when(
                hive_target, F.col("targetTable")
            ).otherwise(F.coalesce("targetPath", "targetTable")),
            "checks": F.col("reconTypes"),
            "column_mapping": F.col("columnMapping"),
            "key_mapping": F.col("primaryKeyMapping"),
            "threshold": F.col("threshold"),
            "rule_sql": F.col("businessRuleSQL"),
            "notify_on_success": F.col("notifyOnSuccess"),
            "notify_on_failure": F.col("notifyOnFailure"),
            "write_results": F.col("writeToHiveFlag"),
            # Events are stored only if both flags are set.
            "write_audit": F.when(
                F.col("writeToHiveFlag") == "Y", F.col("auditFlag")
            ).otherwise(F.lit("N")),
        }
    elif "recon_type" in have:
        columns = {
            **{
                name: F.col(name)
                for name in (
                    "job_name",
                    "source_type",
                    "source_location",
                    "target_type",
                    "target_location",
                    "column_mapping",
                    "key_mapping",
                    "notify_on_success",
                    "notify_on_failure",
                )
            },
            "checks": F.lower("recon_type"),
            "rule_sql": F.col("sql_query"),
            "write_results": F.lit("Y"),
        }
    else:
        columns = {name: F.col(name) for name in JOBS_SCHEMA.names if name in have}
    return jobs.select(
        *[
            columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in JOBS_SCHEMA
        ]
    )
