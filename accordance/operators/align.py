"""Bringing two tables to the same names and types before they are compared."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from accordance.functions.expressions import (
    as_text,
    castable_from_text,
    comparable,
    holds,
    is_binary_float,
    is_exact,
    kept_by_cast,
    quoted,
    struct,
    try_cast,
    uncastable_text,
)
from accordance.model import ConfigError, Pairs, check_pairs

IN_SOURCE, IN_TARGET, DIGEST = "__in_source", "__in_target", "__digest"

# Columns of the library's own results; a data column of such a name is shown with an underscore after it.
OWN_NAMES = frozenset(
    (
        "column_name",
        "joined_rows",
        "kind",
        "repeated",
        "source_value",
        "src_n",
        "src_total",
        "target_value",
        "tgt_n",
        "tgt_total",
        "uncastable",
        "uncastable_key",
        "__group",
        "__place",
        "__row",
        "__source_row",
        "__target_row",
        IN_SOURCE,
        IN_TARGET,
        DIGEST,
    )
)


@dataclass(frozen=True)
class Sides:
    """Source and target with the same column names."""

    source: DataFrame
    target: DataFrame
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    #: The names that columns have in the tables, where it is another.
    shown: dict[str, str]


def real_names(df: DataFrame, names) -> list[str | None]:
    """The columns as the frame spells them, following the session's case sensitivity."""
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        have = {c: c for c in df.columns}
        return [have.get(name) for name in names]
    have = {c.lower(): c for c in df.columns}
    return [have.get(name.lower()) for name in names]


def require_columns(df: DataFrame, names, side: str) -> None:
    names = list(names)
    unknown = [name for name, real in zip(names, real_names(df, names)) if real is None]
    if unknown:
        raise ConfigError(f"{side} has no column {', '.join(unknown)}; it has {df.columns}")


def rename_columns(df: DataFrame, renames: dict[str, str], side: str) -> DataFrame:
    """All columns in one select, so that swapped names do not collide."""
    require_columns(df, renames, side)
    new_name = dict(zip(real_names(df, renames), renames.values()))
    result = [new_name.get(c, c) for c in df.columns]
    times = Counter(name.lower() for name in result)
    twice = sorted(name for name in result if times[name.lower()] > 1)
    if twice:
        raise ConfigError(f"{side} would have column {', '.join(twice)} twice after renaming")
    return select_as(df, dict(zip(result, df.columns)))


def select_as(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The columns under new names, given as new name to old."""
    return df.selectExpr(*[f"{quoted(old)} AS {quoted(new)}" for new, old in columns.items()])


def align_target_to_source(target: DataFrame, mapping: Pairs) -> DataFrame:
    """The target under the source's names; unmapped columns keep their own."""
    check_pairs(mapping)
    return rename_columns(target, {tgt: src for src, tgt in mapping}, "target")


def align_source_to_target(source: DataFrame, mapping: Pairs) -> DataFrame:
    """The source under the target's names; unmapped columns keep their own."""
    check_pairs(mapping)
    return rename_columns(source, dict(mapping), "source")


def key_projection(source: DataFrame, target: DataFrame, keys: Pairs) -> Sides:
    """Only the key columns of both sides, under the target's names."""
    return mapped_sides(source, target, [], keys, name_of="target")


def mapped_sides(
    source: DataFrame, target: DataFrame, mapping: Pairs, keys: Pairs, name_of: str = "source"
) -> Sides:
    """Keys and mapped columns of both sides; everything else is pruned from the scans."""
    if not keys:
        raise ConfigError("the list of key columns is empty")
    check_pairs(keys)
    check_pairs(mapping)
    partner = {s.lower(): t.lower() for s, t in keys}
    for src, tgt in mapping:
        if partner.get(src.lower(), tgt.lower()) != tgt.lower():
            raise ConfigError(f"the key maps {src} to {partner[src.lower()]}, the mapping to {tgt}")
    compared = [pair for pair in mapping if pair[0].lower() not in partner]
    pairs = [*keys, *compared]
    require_columns(source, [s for s, _ in pairs], "source")
    require_columns(target, [t for _, t in pairs], "target")
    own = [s if name_of == "source" else t for s, t in pairs]
    names = free_names(own)
    return Sides(
        select_as(source, {n: s for (s, _), n in zip(pairs, names)}),
        select_as(target, {n: t for (_, t), n in zip(pairs, names)}),
        tuple(names[: len(keys)]),
        tuple(names[len(keys) :]),
        dict(zip(names, own)),
    )


def shared_sides(source: DataFrame, target: DataFrame, mapping: Pairs | None = None) -> Sides:
    """All columns both sides have after renaming, matched by name and not by position."""
    renamed = align_source_to_target(source, mapping or [])
    names = [c for c, own in zip(target.columns, real_names(renamed, target.columns)) if own]
    if not names:
        raise ConfigError(f"no common columns: {renamed.columns} and {target.columns}")
    shown = dict(zip(free_names(names), names))
    return Sides(select_as(renamed, shown), select_as(target, shown), (), tuple(shown), shown)


def one_sided_columns(
    source: DataFrame, target: DataFrame, mapping: Pairs | None = None
) -> tuple[list[str], list[str]]:
    """Names only the source has and names only the target has, after renaming."""
    renamed = align_source_to_target(source, mapping or [])

    def only_in(df: DataFrame, other: DataFrame) -> list[str]:
        return sorted(c for c, its in zip(df.columns, real_names(other, df.columns)) if not its)

    return only_in(renamed, target), only_in(target, renamed)


def free_names(names) -> list[str]:
    """The names, with underscores after those that results use themselves, and no name twice."""
    taken = {name.lower() for name in names}
    free = []
    for name in names:
        while name.lower() in OWN_NAMES or (name != names[len(free)] and name.lower() in taken):
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free


def align_types(
    source: DataFrame, target: DataFrame, names=None, marker: str = "uncastable"
) -> tuple[DataFrame, DataFrame]:
    """Read text as the other side's type wherever exactly one side is text.

    Text that is no value of that type, or says more than a value of that type can, becomes null,
    and the raw text is kept in the struct column ``marker`` (null on rows where all text could be
    read).  Whole numbers and decimals against floating numbers become such, and those that would change are kept as
    text in the same way.  The marker is there only if some column was read.  Other numeric
    or date types are left to Spark's widening; times with and without zone never agree.
    """
    left_types, right_types = types_of(source), types_of(target)
    casts = {}
    for name in source.columns if names is None else names:
        left, right = left_types[name], right_types[name]
        if {type(left), type(right)} == {T.TimestampType, T.TimestampNTZType}:
            raise ConfigError(f"column {name}: cannot compare times with and without zone")
        if is_exact(left) and is_binary_float(right) or is_exact(right) and is_binary_float(left):
            casts[name] = left if is_binary_float(left) else right
            continue
        if isinstance(left, T.StringType) == isinstance(right, T.StringType):
            continue
        typed = right if isinstance(left, T.StringType) else left
        if not castable_from_text(typed):
            raise ConfigError(f"column {name}: cannot compare text with {typed.simpleString()}")
        casts[name] = typed
    if not casts:
        return source, target
    return _read_text(source, casts, marker), _read_text(target, casts, marker)


def types_of(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema}


def _read_text(df: DataFrame, casts: dict[str, T.DataType], marker: str) -> DataFrame:
    own = types_of(df)
    raw, read = {}, {}
    for name, dtype in casts.items():
        value = quoted(name)
        raw[name] = "CAST(NULL AS STRING)"
        if isinstance(own[name], T.StringType):
            raw[name] = uncastable_text(value, dtype)
        elif is_exact(own[name]) and is_binary_float(dtype):
            text = as_text(value, own[name])
            raw[name] = f"if({value} IS NULL OR {kept_by_cast(value, own[name], dtype)}, NULL, {text})"
        else:
            continue
        read[name] = f"if({raw[name]} IS NULL, {try_cast(value, dtype)}, NULL)"
    return df.selectExpr(
        *[f"{read[c]} AS {quoted(c)}" if c in read else quoted(c) for c in df.columns],
        f"if(coalesce({', '.join(raw.values())}) IS NULL, NULL, {struct(raw)}) AS {marker}",
    )


def comparable_columns(df: DataFrame) -> DataFrame:
    """All columns in a form that groups, joins and compares."""
    if not holds(df.schema, T.VariantType, T.MapType):
        return df
    return df.selectExpr(
        *[f"{comparable(quoted(c), dtype)} AS {quoted(c)}" for c, dtype in types_of(df).items()]
    )


def both_sides(source: DataFrame, target: DataFrame) -> DataFrame:
    """The rows of both sides in one frame, marked by side."""
    return source.selectExpr("*", f"1 AS {IN_SOURCE}", f"0 AS {IN_TARGET}").unionByName(
        target.selectExpr("*", f"0 AS {IN_SOURCE}", f"1 AS {IN_TARGET}")
    )
