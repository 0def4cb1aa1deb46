"""Keys that are missing on one side, and keys that are not unique."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordance.functions.expressions import quoted
from accordance.model import Kind, Pairs
from accordance.operators.align import (
    IN_SOURCE,
    IN_TARGET,
    align_types,
    both_sides,
    comparable_columns,
    free_names,
    key_projection,
)


def key_counts(source: DataFrame, target: DataFrame, keys: Pairs) -> DataFrame:
    """Each distinct key with its rows on both sides: ``<keys>, src_n, tgt_n``.

    Reads the key columns only.  A null key is a key like any other.
    """
    sides = key_projection(source, target, keys)
    left, right = align_types(
        comparable_columns(sides.source), comparable_columns(sides.target), marker="uncastable_key"
    )
    return (
        both_sides(left, right)
        .groupBy(*[quoted(c) for c in left.columns])
        .agg(F.sum(IN_SOURCE).alias("src_n"), F.sum(IN_TARGET).alias("tgt_n"))
    )


def key_diff(source: DataFrame, target: DataFrame, keys: Pairs) -> DataFrame:
    """Distinct keys found on one side only: ``<keys>, kind``."""
    one_sided = key_counts(source, target, keys).where("src_n = 0 OR tgt_n = 0")
    kind = F.when(F.col("tgt_n") == 0, Kind.MISSING_IN_TARGET).otherwise(Kind.MISSING_IN_SOURCE)
    return one_sided.withColumn("kind", kind).drop("src_n", "tgt_n")


def missing_keys(totals: DataFrame, keys: Pairs) -> DataFrame:
    """The same from stored ``odd_keys``, which are named as in the source."""
    names = free_names([t for _, t in keys])
    marker = [c for c in totals.columns if c == "uncastable_key"]
    kind = f"if(tgt_total = 0, '{Kind.MISSING_IN_TARGET}', '{Kind.MISSING_IN_SOURCE}') AS kind"
    own = [f"{quoted(c)} AS {quoted(n)}" for c, n in zip(totals.columns, names)]
    return totals.where("src_total = 0 OR tgt_total = 0").selectExpr(*own, *marker, kind)


def duplicate_keys(source: DataFrame, target: DataFrame, keys: Pairs) -> DataFrame:
    """Keys with more than one row on a side: ``<keys>, src_n, tgt_n, joined_rows``.

    ``joined_rows`` is the number of rows a join on the keys would give for the key.
    """
    return (
        key_counts(source, target, keys)
        .where("src_n > 1 OR tgt_n > 1")
        .withColumn("joined_rows", F.col("src_n") * F.col("tgt_n"))
    )
