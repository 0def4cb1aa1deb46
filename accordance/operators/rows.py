"""Whole rows compared as multisets, in one shuffle of rows or of their digests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordance.functions.expressions import digest, digestible, quoted
from accordance.model import Pairs
from accordance.operators.align import (
    DIGEST,
    IN_SOURCE,
    IN_TARGET,
    align_types,
    both_sides,
    comparable_columns,
    shared_sides,
    types_of,
)

_COUNTS = (f"sum({IN_SOURCE}) AS src_n", f"sum({IN_TARGET}) AS tgt_n")


def _both(source: DataFrame, target: DataFrame, mapping: Pairs | None) -> tuple[DataFrame, list[str]]:
    """The rows of both sides, of equal types and marked by side, and their columns."""
    sides = shared_sides(source, target, mapping)
    left, right = align_types(comparable_columns(sides.source), comparable_columns(sides.target))
    return both_sides(left, right), left.columns


def row_counts(source: DataFrame, target: DataFrame, mapping: Pairs | None = None) -> DataFrame:
    """Each distinct row with its copies on both sides: ``<columns>, src_n, tgt_n``.

    One aggregation over the union of both sides.  Copies are counted before the shuffle,
    which spreads rows by all their columns, so no repeated row or key makes a hot task.
    """
    rows, names = _both(source, target, mapping)
    return rows.groupBy(*map(quoted, names)).agg(*map(F.expr, _COUNTS))


def digest_counts(source: DataFrame, target: DataFrame, mapping: Pairs | None = None) -> DataFrame:
    """Each distinct row, given by 128 bits, with its copies on both sides: ``__digest, src_n, tgt_n``.

    As ``row_counts``, but digests are shuffled, however wide the tables are.
    """
    rows = _digested(*_both(source, target, mapping))
    return rows.groupBy(DIGEST).agg(*map(F.expr, _COUNTS))


def _digested(rows: DataFrame, names: list[str]) -> DataFrame:
    types = types_of(rows.selectExpr(*map(quoted, names)))
    if digestible(types):
        return rows.selectExpr("*", f"{digest(types)} AS {DIGEST}")
    # Texts that are equal by a collation are no equal bytes; such rows stand for themselves.
    return rows.selectExpr("*", f"struct({', '.join(map(quoted, names))}) AS {DIGEST}")


def digest_diff(source: DataFrame, target: DataFrame, mapping: Pairs | None = None) -> DataFrame:
    """The digests of the rows whose number of copies differs: ``__digest, src_n, tgt_n``."""
    return digest_counts(source, target, mapping).where("src_n <> tgt_n")


def row_diff(
    source: DataFrame,
    target: DataFrame,
    mapping: Pairs | None = None,
    digests: DataFrame | None = None,
) -> DataFrame:
    """The rows whose number of copies differs: ``<columns>, src_n, tgt_n``.

    ``digests`` is a stored result of ``digest_diff`` for the same arguments, small enough for every task.  The sides are
    then read once more for the rows of these digests only, so that of nearly equal tables next to nothing is shuffled.
    """
    if digests is None:
        return row_counts(source, target, mapping).where("src_n <> tgt_n")
    rows, names = _both(source, target, mapping)
    columns = [*map(quoted, names), "src_n", "tgt_n"]
    return _digested(rows, names).join(F.broadcast(digests), DIGEST).selectExpr(*columns).distinct()


def only_counts(prefix: str = ""):
    """How many rows are in excess on each side, as two aggregates."""
    src, tgt = F.col(f"{prefix}src_n"), F.col(f"{prefix}tgt_n")
    zero = F.lit(0).cast("bigint")
    return (
        F.coalesce(F.sum(F.greatest(src - tgt, zero)), zero).alias("source_only"),
        F.coalesce(F.sum(F.greatest(tgt - src, zero)), zero).alias("target_only"),
    )


def diff_summary(source: DataFrame, target: DataFrame, mapping: Pairs | None = None) -> DataFrame:
    """One row: ``source_count, target_count, source_only, target_only``, from digests alone."""
    zero = F.lit(0).cast("bigint")
    return digest_counts(source, target, mapping).agg(
        F.coalesce(F.sum("src_n"), zero).alias("source_count"),
        F.coalesce(F.sum("tgt_n"), zero).alias("target_count"),
        *only_counts(),
    )
