"""Names and records shared by all checks: kinds, statuses, mappings and jobs."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

from pyspark.sql import types as T

Pairs = list[tuple[str, str]]


class ConfigError(ValueError):
    """The job or the mapping is wrong; raised before any Spark job runs."""


#: The rows of check results that tell that differences could not be stored, and that a text file has wrong lines.
STORE, LINES = "store_results", "malformed_lines"


class Kind:
    """What is wrong with a cell, a key or a row."""

    VALUE = "value"
    NULL_VS_VALUE = "null_vs_value"
    UNCASTABLE = "uncastable"
    MISSING_IN_TARGET = "missing_in_target"
    MISSING_IN_SOURCE = "missing_in_source"
    SOURCE_ONLY = "source_only"
    TARGET_ONLY = "target_only"
    VIOLATION = "violation"
    MALFORMED = "malformed"


class Status:
    STARTED = "STARTED"
    SUCCESS = "SUCCESS"
    WARNING = "WARNING"
    FAILURE = "FAILURE"
    ERROR = "ERROR"

    # Rising severity; a run has the worst status of its events.
    BY_SEVERITY = (STARTED, SUCCESS, WARNING, FAILURE, ERROR)


# The check names a job row may list.
CHECKS = (
    "s2t",
    "sql",
    "source_to_target",
    "business_rule",
    "record_count",
    "missing_extra_records",
    "threshold",
    "schema_drift",
)


def parse_mapping(text: str | None) -> Pairs:
    """``a:b,c:d`` as ordered pairs; null or blank text is the empty mapping."""
    pairs: Pairs = []
    for piece in _pieces(text):
        source, colon, target = (part.strip() for part in piece.partition(":"))
        if not (source and colon and target) or ":" in target:
            raise ConfigError(f"expected source:target in the mapping, found {piece!r}")
        pairs.append((source, target))
    check_pairs(pairs)
    return pairs


def parse_keys(text: str | None, mapping: Pairs | None = None) -> Pairs:
    """Key pairs; a bare name takes its partner from the mapping, else from itself."""
    partner = {source.lower(): target for source, target in mapping or []}
    pairs: Pairs = []
    for piece in _pieces(text):
        own = (piece, partner.get(piece.lower(), piece))
        pairs += parse_mapping(piece) if ":" in piece else [own]
    check_pairs(pairs)
    return pairs


def check_pairs(pairs: Pairs) -> None:
    for side, names in zip(("source", "target"), zip(*pairs)):
        plain = [name.lower() for name in names]
        twice = sorted({name for name in names if plain.count(name.lower()) > 1})
        if twice:
            raise ConfigError(f"{side} columns named more than once: {', '.join(twice)}")


def _pieces(text: str | None) -> list[str]:
    if text is None or not text.strip():
        return []
    return [piece.strip() for piece in text.split(",")]


@dataclass(frozen=True)
class Job:
    """One row of the jobs table."""

    job_name: str
    source_type: str
    source_location: str | None = None
    source_query: str | None = None
    target_type: str | None = None
    target_location: str | None = None
    target_query: str | None = None
    checks: str = ""
    column_mapping: str | None = None
    key_mapping: str | None = None
    threshold: float | None = None
    rule_sql: str | None = None
    notify_on_success: str | None = "N"
    notify_on_failure: str | None = "N"
    write_results: str | None = "N"
    write_audit: str | None = "N"
    source_options: str | None = None
    target_options: str | None = None

    @classmethod
    def from_row(cls, row) -> Job:
        given = row.asDict()
        return cls(**{f.name: given[f.name] for f in fields(cls) if f.name in given})

    @property
    def check_names(self) -> list[str]:
        return [name.lower() for name in _pieces(self.checks)]

    @property
    def mapping(self) -> Pairs:
        return parse_mapping(self.column_mapping)

    @property
    def keys(self) -> Pairs:
        return parse_keys(self.key_mapping, self.mapping)

    def options_of(self, side: str) -> dict[str, str]:
        """The reader options of a side, a JSON object of texts."""
        text = self.source_options if side == "source" else self.target_options
        try:
            options = json.loads(text) if (text or "").strip() else {}
        except ValueError as error:
            raise ConfigError(f"{self.job_name}: the {side} options are no JSON: {error}") from None
        if not isinstance(options, dict):
            raise ConfigError(f"{self.job_name}: the {side} options are no JSON object: {text}")
        return {name: str(value) for name, value in options.items()}

    def validate(self) -> Job:
        """Raise for anything that can be seen to be wrong without reading data."""
        self.options_of("source"), self.options_of("target")
        names = self.check_names
        unknown = [name for name in names if name not in CHECKS]
        if unknown or not names:
            raise ConfigError(f"{self.job_name}: unknown checks {unknown}, know {list(CHECKS)}")
        if len(set(names)) < len(names):
            raise ConfigError(f"{self.job_name}: a check is listed twice: {self.checks}")
        needs_target = [name for name in names if name != "sql"]
        if needs_target and not self.target_type:
            raise ConfigError(f"{self.job_name}: {needs_target} need a target")
        if {"s2t", "missing_extra_records"} & set(names) and not self.keys:
            raise ConfigError(f"{self.job_name}: key_mapping is empty")
        if "s2t" in names and not self.mapping:
            raise ConfigError(f"{self.job_name}: column_mapping is empty")
        if {"sql", "business_rule"} & set(names) and not (self.rule_sql or "").strip():
            raise ConfigError(f"{self.job_name}: rule_sql is empty")
        return self


JOBS_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.DoubleType() if f.name == "threshold" else T.StringType())
        for f in fields(Job)
    ]
)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("recon_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
    ]
)

CHECK_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("recon_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("source_count", T.LongType()),
        T.StructField("target_count", T.LongType()),
        T.StructField("source_only", T.LongType()),
        T.StructField("target_only", T.LongType()),
        T.StructField("mismatch_ratio", T.DoubleType()),
        T.StructField("message", T.StringType()),
    ]
)
