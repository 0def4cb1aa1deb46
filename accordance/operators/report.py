"""Tags, previews and roll-ups of results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accordance.functions.expressions import epoch_second, quoted
from accordance.model import Status


def tag_results(
    df: DataFrame,
    job_name: str,
    recon_type: str,
    status: str,
    start_ms: int,
    end_ms: int,
    source_count: int | None = None,
    record_count: int | None = None,
) -> DataFrame:
    """Difference rows marked with the job they come from.

    ``record_count`` is the number of difference rows; it is counted by a scalar subquery
    unless given.  ``mismatch_count`` is one for each row.
    """
    if record_count is None:
        total = df.agg(F.count("*")).scalar()
    else:
        total = F.lit(record_count).cast("bigint")
    return df.select(
        "*",
        F.lit(job_name).alias("job_name"),
        F.lit(recon_type).alias("recon_type"),
        F.lit(status).alias("status"),
        epoch_second(start_ms).alias("start_time"),
        epoch_second(end_ms).alias("end_time"),
        F.lit((end_ms - start_ms) // 1000).cast("bigint").alias("total_time_taken_for_execution"),
        total.alias("record_count"),
        F.lit(1).alias("mismatch_count"),
        F.lit(source_count).cast("bigint").alias("source_count"),
    )


def preview(df: DataFrame, n: int = 10, by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows by the given columns, then by all others: the same on each run."""
    first = by or []
    order = [*first, *[c for c in df.columns if c not in first]]
    return df.orderBy(*[F.asc_nulls_first(quoted(c)) for c in order]).limit(n)


def stratified_preview(
    df: DataFrame, n: int = 3, of: tuple[str, ...] = ("column_name", "kind"), by: list[str] | None = None
) -> DataFrame:
    """The first ``n`` rows of each combination of the columns ``of``, so that a frequent one hides no rare one.

    Each task sends on at most ``n`` rows of each combination.
    """
    first = by or []
    order = [F.asc_nulls_first(quoted(c)) for c in [*first, *[c for c in df.columns if c not in first]]]
    place = F.row_number().over(Window.partitionBy(*map(quoted, of)).orderBy(*order))
    ranked = df.select(F.struct("*").alias("row"), *[F.col(quoted(c)) for c in df.columns], place.alias("__place"))
    return ranked.where(F.col("__place") <= n).select("row.*").orderBy(*order)


def cell_summary(cells: DataFrame) -> DataFrame:
    """Lines and joined rows per column and kind of a cell comparison."""
    return cells.groupBy("column_name", "kind").agg(
        F.count("*").alias("cells"), F.sum("joined_rows").alias("joined_rows")
    )


def severity(status: Column) -> Column:
    """The status as a number that rises with severity; unknown statuses rank as errors."""
    worst = len(Status.BY_SEVERITY) - 1
    ranks = enumerate(Status.BY_SEVERITY)
    return reduce(lambda c, r: c.when(status == r[1], r[0]), ranks, F).otherwise(worst)


def _status_of(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in Status.BY_SEVERITY]), rank + 1)


def run_rollup(events: DataFrame) -> DataFrame:
    """One row per run: ``job_name, run_id, status, events, failures, errors``.

    The status is the worst of the run's events: ERROR, then FAILURE, WARNING and SUCCESS.
    """
    status = F.col("status")
    return (
        events.groupBy("job_name", "run_id")
        .agg(
            F.max(severity(status)).alias("rank"),
            F.count("*").alias("events"),
            F.count_if(status == Status.FAILURE).alias("failures"),
            F.count_if(status == Status.ERROR).alias("errors"),
        )
        .select("job_name", "run_id", _status_of(F.col("rank")).alias("status"),
                "events", "failures", "errors")
    )


def run_report(check_results: DataFrame, jobs: DataFrame) -> DataFrame:
    """One row per check, with the status of its run and whether to notify.

    ``should_notify`` holds if the run succeeded and the job asks for success notes, or it
    did not and the job asks for failure notes.
    """
    runs = run_rollup(check_results).select(
        "job_name", "run_id", F.col("status").alias("run_status")
    )
    flags = jobs.groupBy("job_name").agg(  # a job that is listed twice asks as either row does
        F.max(F.upper("notify_on_success") == "Y").alias("__on_success"),
        F.max(F.upper("notify_on_failure") == "Y").alias("__on_failure"),
    )
    succeeded = F.col("run_status") == Status.SUCCESS
    should_notify = F.coalesce(
        F.when(succeeded, F.col("__on_success")).otherwise(F.col("__on_failure")), F.lit(False)
    )
    # Runs and flags have one row per run and job; the wide side of both joins is the checks.
    flags = flags.withColumnRenamed("job_name", "__job")
    runs = runs.join(flags, F.col("job_name").eqNullSafe(F.col("__job")), "left").drop("__job")
    runs = runs.withColumnsRenamed({"job_name": "__job", "run_id": "__run"})
    same = F.col("job_name").eqNullSafe(F.col("__job")) & F.col("run_id").eqNullSafe(F.col("__run"))
    return (
        check_results.join(runs, same)
        .drop("__job", "__run")
        .withColumn("should_notify", should_notify)
        .drop("__on_success", "__on_failure")
    )
