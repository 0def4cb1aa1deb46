"""Sums of digests for each partition of a table, kept from run to run.

A partition is told by its row count and the sums of its rows' digests, which do not depend on the order or the files of the rows.  A
later run looks at the names, sizes and times of the files first and reads only partitions whose files have changed; of the others the
stored sums hold.  Two tables differ in the partitions whose sums differ, and only those have to be compared row by row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordance.functions.expressions import digest, digestible, quoted
from accordance.model import ConfigError, Kind
from accordance.operators.align import comparable_columns, free_names, require_columns, types_of

_FILES, _ROWS, _HIGH, _LOW = "files", "n_rows", "high", "low"
_SUMS = (_FILES, _ROWS, _HIGH, _LOW)
#: Exact, and additive at any size.
_SUM = "coalesce(sum(CAST({} AS DECIMAL(20,0))), 0)"


def partition_summary(df: DataFrame, by: list[str], before: DataFrame | None = None) -> DataFrame:
    """One row for each partition: ``<by>, files, n_rows, high, low``.

    ``df`` is read from files that are partitioned by the columns ``by``, under its own or other names.  ``before`` is a stored
    summary of an earlier state: what it says of partitions whose files are the same is taken over, and those partitions are not
    read.  Rows are digested by their columns in the order of names, so tables of equal names and types have equal sums.
    """
    require_columns(df, by, "the table")
    if set(map(str.lower, by)) & set(_SUMS) or free_names(by) != list(by):
        raise ConfigError(f"partition columns {by} have names that summaries use")
    keys = [F.col(quoted(c)) for c in by]
    # Hidden columns of file sources: no data is read for them.
    file = "xxhash64(_metadata.file_path, _metadata.file_size, _metadata.file_modification_time)"
    files = df.selectExpr(*map(quoted, by), f"{file} AS file").distinct()
    files = files.groupBy(*keys).agg(F.expr(_SUM.format("file")).alias(_FILES))
    if before is None:
        return files.join(_sums(df, by).alias("n"), _same(files, by, "n"), "inner").select(
            *[files[quoted(c)] for c in by], _FILES, _ROWS, _HIGH, _LOW
        )
    own = before.select(*keys, *_SUMS)
    known = _matched(own, files, [*by, _FILES], "left_semi")
    stale = _matched(files, own, [*by, _FILES], "left_anti")
    fresh = _sums(rows_of_partitions(df, stale, by), by)
    found = stale.join(fresh.alias("n"), _same(stale, by, "n"), "inner")
    found = found.select(*[stale[quoted(c)] for c in by], _FILES, _ROWS, _HIGH, _LOW)
    return known.unionByName(found)


def summary_diff(source: DataFrame, target: DataFrame, by: list[str]) -> DataFrame:
    """The partitions that differ, by the summaries of both sides: ``<by>, kind, src_n, tgt_n`` with their rows."""
    left, right = (df.select(*map(quoted, by), _ROWS, _HIGH, _LOW) for df in (source, target))
    both = left.selectExpr("*", "1 AS side").unionByName(right.selectExpr("*", "2 AS side"))
    sums = [f"sum(if(side = {n}, {c}, 0)) AS {c}{n}" for n in (1, 2) for c in (_ROWS, _HIGH, _LOW)]
    there = [f"max(side = {n}) AS there{n}" for n in (1, 2)]
    found = both.groupBy(*map(quoted, by)).agg(*map(F.expr, [*sums, *there]))
    differs = " OR ".join(f"NOT ({c}1 <=> {c}2)" for c in (_ROWS, _HIGH, _LOW))
    kind = (
        f"CASE WHEN NOT there2 THEN '{Kind.MISSING_IN_TARGET}' WHEN NOT there1 THEN '{Kind.MISSING_IN_SOURCE}'"
        f" ELSE '{Kind.VALUE}' END AS kind"
    )
    return found.where(f"{differs} OR NOT (there1 AND there2)").selectExpr(
        *map(quoted, by), kind, f"{_ROWS}1 AS src_n", f"{_ROWS}2 AS tgt_n"
    )


def rows_of_partitions(df: DataFrame, partitions: DataFrame, by: list[str]) -> DataFrame:
    """The rows of the given partitions; Spark reads no others."""
    some = partitions.select(*map(quoted, by)).distinct()
    full = reduce(lambda a, b: a & b, [F.col(quoted(c)).isNotNull() for c in by])
    # Plain equality lets Spark prune partitions at run time; those of null are told apart by their nulls.  The list is no longer
    # than the one of all partitions that the driver holds to plan any scan.  Spark prunes only by a side with a comparison on
    # it, so one that always holds is there.
    listed = some.where(full & (F.hash(*[F.col(quoted(c)) for c in by]) >= F.lit(-(1 << 31))))
    named = df.join(F.broadcast(listed), list(by), "left_semi")
    return named.unionByName(_matched(df.where(~full), some.where(~full), by, "left_semi"))


def _sums(df: DataFrame, by: list[str]) -> DataFrame:
    rows = comparable_columns(df)
    types = dict(sorted(types_of(rows).items(), key=lambda c: c[0].lower()))
    if not digestible(types):
        raise ConfigError("texts that compare by a collation have no digests to add up")
    digested = rows.selectExpr(*map(quoted, by), f"{digest({c.lower(): t for c, t in types.items()})} AS d")
    sums = [F.expr(_SUM.format(f"d.{c}")).alias(c) for c in (_HIGH, _LOW)]
    return digested.groupBy(*map(quoted, by)).agg(F.count(F.lit(1)).alias(_ROWS), *sums)


def _same(left: DataFrame, names: list[str], right: str):
    return reduce(lambda a, b: a & b, [left[quoted(c)].eqNullSafe(F.col(f"{right}.{quoted(c)}")) for c in names])


def _matched(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    return left.alias("a").join(
        right.alias("b"),
        reduce(lambda a, b: a & b, [F.col(f"a.{quoted(c)}").eqNullSafe(F.col(f"b.{quoted(c)}")) for c in names]),
        how,
    )
