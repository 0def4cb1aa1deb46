"""The audit table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from accordance.model import AUDIT_SCHEMA


def audit_events(spark: SparkSession, events: list[tuple]) -> DataFrame:
    """The events of one run, a handful of rows, as one partition."""
    return spark.createDataFrame(events, AUDIT_SCHEMA).coalesce(1)


def append_audit(events: DataFrame, table: str) -> None:
    """All events of a run in one append."""
    events.select(AUDIT_SCHEMA.names).write.mode("append").saveAsTable(table)
