"""Business rules written in SQL."""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from accordance.model import ConfigError, Pairs
from accordance.operators.rows import row_diff

SOURCE_VIEW, TARGET_VIEW = "source_view", "target_view"
#: The views of a rule are there while it is analyzed, for one rule at a time.
_ANALYSIS = threading.RLock()


def rule_violations(views: dict[str, DataFrame], sql: str) -> DataFrame:
    """The rows a rule returns; each of them is a violation."""
    if not (sql or "").strip():
        raise ConfigError("the rule has no SQL")
    if not views:
        raise ConfigError("the rule has no views to read")
    spark = next(iter(views.values())).sparkSession
    query = sql.strip().removesuffix(";")
    with _ANALYSIS, _registered(spark, views):
        # As a subquery, only a query is accepted.
        return spark.sql(f"SELECT * FROM (\n{query}\n)")


def rule_vs_target(
    views: dict[str, DataFrame], sql: str, target: DataFrame, mapping: Pairs | None = None
) -> DataFrame:
    """Where the result of a rule and the expected table differ, as whole rows."""
    return row_diff(rule_violations(views, sql), target, mapping)


@contextmanager
def _registered(spark: SparkSession, views: dict[str, DataFrame]):
    """Temporary views while a query is analyzed; earlier views of the names come back."""
    earlier = {
        name: spark.table(name)
        for name in views
        # The name as the pattern: the catalog isn't listed.
        if any(t.isTemporary and t.name == name.lower() for t in spark.catalog.listTables(pattern=name))
    }
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        yield
    finally:
        for name in views:
            spark.catalog.dropTempView(name)
        for name, df in earlier.items():
            df.createOrReplaceTempView(name)
