"""Tells whether two tables agree and, where they do not, exactly how.

Every check is a lazy function from DataFrames to a DataFrame, built from Spark's own
expressions.  Only ``accordance.plans`` and ``accordance.sinks`` run actions.
"""

from accordance.model import CHECKS, ConfigError, Job, Kind, Status, parse_keys, parse_mapping
from accordance.operators.align import (
    align_source_to_target,
    align_target_to_source,
    align_types,
    key_projection,
)
from accordance.operators.cells import cell_diff, mismatch_details
from accordance.operators.checks import (
    missing_extra,
    record_count,
    s2t_cells,
    s2t_rows,
    schema_drift,
    threshold,
)
from accordance.operators.keys import duplicate_keys, key_diff
from accordance.operators.report import (
    cell_summary,
    preview,
    run_report,
    run_rollup,
    stratified_preview,
    tag_results,
)
from accordance.operators.rows import diff_summary, digest_diff, row_diff
from accordance.operators.rules import rule_violations, rule_vs_target
from accordance.operators.summaries import partition_summary, rows_of_partitions, summary_diff
from accordance.plans.runner import run_job, run_suite
from accordance.plans.workspace import stage_row_diff
from accordance.sinks.results import read_results
from accordance.sources.readers import malformed_lines, read

__all__ = [
    "CHECKS",
    "ConfigError",
    "Job",
    "Kind",
    "Status",
    "align_source_to_target",
    "align_target_to_source",
    "align_types",
    "cell_diff",
    "cell_summary",
    "diff_summary",
    "digest_diff",
    "duplicate_keys",
    "key_diff",
    "key_projection",
    "malformed_lines",
    "mismatch_details",
    "missing_extra",
    "parse_keys",
    "parse_mapping",
    "partition_summary",
    "preview",
    "read",
    "read_results",
    "record_count",
    "row_diff",
    "rows_of_partitions",
    "rule_violations",
    "rule_vs_target",
    "run_job",
    "run_report",
    "run_rollup",
    "run_suite",
    "s2t_cells",
    "s2t_rows",
    "schema_drift",
    "stage_row_diff",
    "stratified_preview",
    "summary_diff",
    "tag_results",
    "threshold",
]
