"""The checks a user names in a job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accordance.functions.expressions import (
    castable_from_text,
    kept_by_cast,
    literal,
    quoted,
    struct,
    uncastable_text,
)
from accordance.model import Pairs, Status
from accordance.operators.align import (
    align_source_to_target,
    one_sided_columns,
    real_names,
    types_of,
)
from accordance.operators.cells import cell_diff
from accordance.operators.keys import key_diff
from accordance.operators.rows import diff_summary, row_diff

s2t_cells = cell_diff
s2t_rows = row_diff
missing_extra = key_diff


def record_count(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: both counts and whether they are equal."""
    zero = F.lit(0).cast("bigint")
    counts = (
        source.agg(F.count("*").alias("source_count"), zero.alias("target_count"))
        .unionByName(target.agg(zero.alias("source_count"), F.count("*").alias("target_count")))
        .agg(
            F.sum("source_count").alias("source_count"),
            F.sum("target_count").alias("target_count"),
        )
    )
    status = _success_if(F.col("source_count") == F.col("target_count"))
    return counts.withColumn("status", status)


def threshold(
    source: DataFrame, target: DataFrame, mapping: Pairs | None = None, limit: float | None = None
) -> DataFrame:
    """One row: the share of the rows of both sides without a partner, held against the limit.

    No limit means that no row may differ.
    """
    summary = diff_summary(source, target, mapping)
    return summary.withColumn("mismatch_ratio", F.expr(MISMATCH_RATIO)).withColumn(
        "status", _success_if(F.col("mismatch_ratio") <= F.lit(float(limit or 0.0)))
    )


#: The share of rows without a partner among the rows of both sides.
MISMATCH_RATIO = "(source_only + target_only) / greatest(source_count + target_count, 1L)"


def schema_drift(
    source: DataFrame, target: DataFrame, mapping: Pairs | None = None
) -> DataFrame:
    """One row per column or nested field whose name or type differs.

    ``column_name, drift, source_type, target_type, unreadable_rows``.  Structs, arrays and maps are gone through
    as long as both sides have them; ``a.b`` is a field, ``a[]`` the elements of an array, ``a{key}`` and ``a{value}`` the
    entries of a map.  For a type difference ``unreadable_rows`` counts the source values (all elements and entries) that are no value of
    the target's type; all are counted in one aggregation.  It is null where no cast exists.
    """
    renamed = align_source_to_target(source, mapping or [])
    only_source, only_target = one_sided_columns(source, target, mapping)
    old_types, new_types = types_of(renamed), types_of(target)
    found = [
        *[_Drift(c, old_types[c], None) for c in only_source],
        *[_Drift(c, None, new_types[c]) for c in only_target],
    ]
    for name, own in zip(target.columns, real_names(renamed, target.columns)):
        if own:
            found += _drifts(name, f"array({quoted(own)})", old_types[own], new_types[name])
    null = "CAST(NULL AS BIGINT)"
    counts, lines = [], []
    for drift in found:
        count = null
        if drift.unreadable:
            count = f"n{len(counts)}"
            counts.append(f"coalesce(sum(size(filter({drift.values}, v -> {drift.unreadable}))), 0) AS {count}")
        lines.append(_drift_line(drift.path, drift.kind, drift.old, drift.new, count))
    # Without drift the one line is filtered away and leaves the schema.
    kept = lines or [_drift_line(None, None, None, None, null)]
    # Names alone need no look at the data.
    one_row = renamed.agg(*map(F.expr, counts)) if counts else renamed.sparkSession.range(1)
    return one_row.selectExpr(f"inline(array({', '.join(kept)}))").where("drift IS NOT NULL")


@dataclass(frozen=True)
class _Drift:
    """A difference at a path; ``values`` is SQL for the array of a row's source values there."""

    path: str
    old: T.DataType | None
    new: T.DataType | None
    values: str = ""

    @property
    def kind(self) -> str:
        if self.old and self.new:
            return "type_differs"
        return "only_in_source" if self.old else "only_in_target"

    @property
    def unreadable(self) -> str | None:
        """Whether a value ``v`` is none of the new type, as SQL; None where that can't be said."""
        return _is_unreadable("v", self.old, self.new) if self.old and self.new else None


def _drifts(path: str, values: str, old: T.DataType, new: T.DataType) -> list[_Drift]:
    """The differences of two types, down to the fields that differ."""
    if old.simpleString() == new.simpleString():
        return []
    there = f"filter({values}, v -> v IS NOT NULL)"
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return _drifts(f"{path}[]", f"flatten({there})", old.elementType, new.elementType)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        parts = {
            part: f"flatten(transform({there}, v -> map_{part}s(v)))" for part in ("key", "value")
        }
        return [
            *_drifts(path + "{key}", parts["key"], old.keyType, new.keyType),
            *_drifts(path + "{value}", parts["value"], old.valueType, new.valueType),
        ]
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        olds, news = ({f.name: f.dataType for f in t.fields} for t in (old, new))
        found = []
        for name in [*olds, *[n for n in news if n not in olds]]:
            if name in olds and name in news:
                inner = f"transform({there}, v -> v.{quoted(name)})"
                found += _drifts(f"{path}.{name}", inner, olds[name], news[name])
            else:
                found.append(_Drift(f"{path}.{name}", olds.get(name), news.get(name)))
        return found
    return [_Drift(path, old, new, values)]


def _drift_line(name, drift, old: T.DataType | None, new: T.DataType | None, count: str) -> str:
    def text(value) -> str:
        return "CAST(NULL AS STRING)" if value is None else literal(value)

    return struct(
        {
            "column_name": text(name),
            "drift": text(drift),
            "source_type": text(old and old.simpleString()),
            "target_type": text(new and new.simpleString()),
            "unreadable_rows": count,
        }
    )


def _is_unreadable(value: str, old: T.DataType, new: T.DataType) -> str | None:
    """Whether a value of one type is no value of the other."""
    if isinstance(new, T.StringType) and isinstance(old, T.AtomicType):
        return "false"
    if isinstance(old, T.StringType) and castable_from_text(new):
        return f"{uncastable_text(value, new)} IS NOT NULL"
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    numbers = isinstance(old, T.NumericType) and isinstance(new, T.NumericType)
    if numbers or (isinstance(old, times) and isinstance(new, times)):
        return f"{value} IS NOT NULL AND NOT {kept_by_cast(value, old, new)}"
    return None


def _success_if(condition: Column) -> Column:
    return F.when(condition, Status.SUCCESS).otherwise(Status.FAILURE)
