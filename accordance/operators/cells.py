"""Keyed comparison, cell by cell.

Where keys are known to be unique, two tables are matched by a full outer join: no key can
be hot then.  Otherwise all rows of a key are brought together once, in so many parts that each holds about ``SHARE`` rows
at any size of the tables, and are paired or counted there without another shuffle.

Keys that lie in a part too large for that, as hot keys do, are found by a count of hashes first and go another way: the union of
both sides is grouped by key *and* row, which drops equal rows before the shuffle by key and spreads a hot key over its rows.  What is
left of unique keys is joined.

A key with several rows on a side stands for the product of its rows, which is never built:
each distinct cell value is one line with the rows of each side that hold it and the exact
number of joined rows that differ, which is linear in the data.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accordance.functions.expressions import (
    as_text,
    detail_text,
    differs,
    digest,
    digestible,
    literal,
    plain_zero,
    quoted,
    struct,
)
from accordance.model import Kind, Pairs
from accordance.operators.align import (
    IN_SOURCE,
    IN_TARGET,
    align_types,
    both_sides,
    comparable_columns,
    mapped_sides,
    types_of,
)

_ROW, _SRC, _TGT = "__row", "__source_row", "__target_row"
_GROUP, _PLACE = "__group", "__place"
_COUNTS = ("src_n", "tgt_n", "joined_rows")
_TOTALS = ("src_total", "tgt_total")

#: Rows that a task is to bring together by their keys.
SHARE = 1 << 17
#: Parts that keys are dealt to for counting, and the rows of a part that has to be spread.
PARTS, HEAVY = 1 << 16, 1 << 16

#: Of keys with their totals: those with several rows on a side.
NOT_UNIQUE = "src_total > 1 OR tgt_total > 1"
_SINGLE = "(src_n = 1 AND tgt_n = 1)"
_MISSING = "(src_n = 0 OR tgt_n = 0)"
_MISSING_KIND = f"if(tgt_n = 0, '{Kind.MISSING_IN_TARGET}', '{Kind.MISSING_IN_SOURCE}')"
_LINE = ("column_name", "source_value", "target_value", "kind")
_NO_TEXT = "CAST(NULL AS STRING)"


@dataclass(frozen=True)
class _Cells:
    """Both sides as ``<keys>, [uncastable_key], <columns>, [uncastable]``, of equal types."""

    source: DataFrame
    target: DataFrame
    keys: tuple[str, ...]
    types: dict[str, T.DataType]
    cast: frozenset[str]
    cast_keys: tuple[str, ...]
    shown: dict[str, str]

    @property
    def rows(self) -> DataFrame:
        """Both sides in one: ``<keys>, [uncastable_key], __row``, marked by side."""
        row = f"{self.row()} AS {_ROW}"
        return both_sides(self.source, self.target).selectExpr(
            *self.group, row, IN_SOURCE, IN_TARGET
        )

    def row(self, side: str = "") -> str:
        """All that is compared of a row, as one struct."""
        names = [*(["uncastable"] if self.cast else []), *self.types]
        return struct({c: f"{side}{quoted(c)}" for c in names} or {"present": "true"})

    @property
    def group(self) -> list[str]:
        return [*map(quoted, self.keys), *(["uncastable_key"] if self.cast_keys else [])]

    @property
    def part(self) -> str | None:
        """The part of a key, the same for keys that group together; none if keys compare by a collation."""
        types = types_of(self.source)
        of = {c: types[c] for c in (*self.keys, *(["uncastable_key"] if self.cast_keys else []))}
        return f"pmod({digest(of)}.high, {PARTS}L)" if digestible(of) else None

    # The parts below are SQL text over a source row and a target row.

    def raw(self, row: str, name: str) -> str:
        return f"{row}.uncastable.{quoted(name)}"

    def text(self, row: str, name: str) -> str:
        text = as_text(f"{row}.{quoted(name)}", self.types[name])
        return f"coalesce({self.raw(row, name)}, {text})" if name in self.cast else text

    def uncastable(self, name: str) -> str:
        return f"coalesce({self.raw(_SRC, name)}, {self.raw(_TGT, name)}) IS NOT NULL"

    def diff(self, name: str) -> str:
        diff = differs(f"{_SRC}.{quoted(name)}", f"{_TGT}.{quoted(name)}")
        return f"({self.uncastable(name)} OR {diff})" if name in self.cast else f"({diff})"

    def any_diff(self) -> str:
        return "(" + (" OR ".join(self.diff(name) for name in self.types) or "false") + ")"

    def lines(self) -> str:
        """A line per compared column; its kind is null where the cells agree."""
        return _array([self._cell_line(name) for name in self.types])

    def _cell_line(self, name: str) -> str:
        one_null = f"({_SRC}.{quoted(name)} IS NULL OR {_TGT}.{quoted(name)} IS NULL)"
        kind = f"if({one_null}, '{Kind.NULL_VS_VALUE}', '{Kind.VALUE}')"
        if name in self.cast:
            kind = f"if({self.uncastable(name)}, '{Kind.UNCASTABLE}', {kind})"
        kind = f"if({self.diff(name)}, {kind}, NULL)"
        return _line(literal(self.shown[name]), self.text(_SRC, name), self.text(_TGT, name), kind)

    def details(self) -> str:
        """``column:source!=target`` for each differing cell, in mapping order."""
        parts = [
            f"if({self.diff(n)}, {detail_text(self.shown[n], self.text(_SRC, n), self.text(_TGT, n))}, NULL)"
            for n in self.types
        ]
        return f"concat_ws(',', {', '.join(parts) or 'NULL'})"

    def key_lines(self) -> str:
        """The lines of a key that is not compared: missing or unreadable."""
        plain = _array([_line(_NO_TEXT, _NO_TEXT, _NO_TEXT, _MISSING_KIND)])
        if not self.cast_keys:
            return plain
        unread = []
        for name in self.cast_keys:
            raw = f"uncastable_key.{quoted(name)}"
            source, target = f"if(src_n > 0, {raw}, NULL)", f"if(tgt_n > 0, {raw}, NULL)"
            kind = f"if({raw} IS NULL, NULL, '{Kind.UNCASTABLE}')"
            unread.append(_line(literal(self.shown[name]), source, target, kind))
        return f"if(uncastable_key IS NULL, {plain}, {_array(unread)})"

    def key_detail(self) -> str:
        if not self.cast_keys:
            return _MISSING_KIND
        raw = [
            f"concat({literal(self.shown[name] + ':')}, uncastable_key.{quoted(name)})"
            for name in self.cast_keys
        ]
        unread = f"concat_ws(',', '{Kind.UNCASTABLE}', {', '.join(raw)})"
        return f"if(uncastable_key IS NULL, {_MISSING_KIND}, {unread})"


def _line(column_name: str, source_value: str, target_value: str, kind: str) -> str:
    return struct(
        {
            "column_name": column_name,
            "source_value": source_value,
            "target_value": target_value,
            "kind": kind,
        }
    )


def _array(lines: list[str]) -> str:
    return f"array({', '.join(lines or [_line(*[_NO_TEXT] * 4)])})"


def cell_diff(
    source: DataFrame,
    target: DataFrame,
    mapping: Pairs,
    keys: Pairs,
    unique_keys: bool = False,
    duplicates: DataFrame | None = None,
    few_duplicates: bool = False,
) -> DataFrame:
    """One row per differing cell, named as in the source.

    ``<keys>, column_name, source_value, target_value, kind, repeated, src_n, tgt_n,
    joined_rows``.  Missing keys give a line with a null ``column_name``.  ``src_n`` and
    ``tgt_n`` are the rows behind the line and ``joined_rows`` the rows a join on the keys
    would show for it.  ``repeated`` says that the key has several rows on a side; its lines
    are of single values, of the kind of that value.

    ``unique_keys`` says that no key has several rows on a side; one join then does it all.
    ``duplicates`` is a stored result of ``keys_not_unique`` for the same arguments.  Being
    a file of known size, Spark broadcasts it if it is small, and shuffles it if not.
    ``few_duplicates`` says that it is small enough for every task: the other keys, which are unique, then go through
    one join, as if they were all.
    """
    cells = _cells(source, target, mapping, keys)
    lines = f"if({_SINGLE}, {cells.lines()}, {cells.key_lines()})"
    if unique_keys:
        return _inline(cells, _joined(cells), lines, repeated="false")

    def spread(cells: _Cells, totals: DataFrame, once: DataFrame) -> DataFrame:
        return (
            _inline(cells, once, lines, repeated="false")
            .unionByName(_inline(cells, _missing(totals), cells.key_lines(), repeated="true"))
            .unionByName(_values(cells, totals, duplicates is not None))
        )

    if few_duplicates:
        return spread(cells, duplicates, _joined(cells, duplicates))
    light, heavy, where = _dealt(cells)
    if light is not None:
        found = _inline(cells, _paired(light, cells), lines, repeated=NOT_UNIQUE).unionByName(_values_together(light, cells))
        if heavy is None:
            return found
    totals = _totals(heavy) if duplicates is None else duplicates.where(where)
    others = spread(heavy, totals, _excess(heavy, totals))
    return others if light is None else found.unionByName(others)


def keys_not_unique(
    source: DataFrame, target: DataFrame, mapping: Pairs, keys: Pairs
) -> DataFrame:
    """Keys with more than one row on a side: ``<keys>, src_total, tgt_total``.

    Reads the key columns only.  If there are none, no key is hot on either side.
    """
    return odd_keys(source, target, mapping, keys).where(NOT_UNIQUE)


def odd_keys(source: DataFrame, target: DataFrame, mapping: Pairs, keys: Pairs) -> DataFrame:
    """All keys but those with one row on each side: ``<keys>, src_total, tgt_total``.

    From one look at the key columns: the keys that are not unique and those that are missing.
    """
    return _key_totals(_cells(source, target, mapping, keys)).where("src_total <> 1 OR tgt_total <> 1")


def mismatch_details(
    source: DataFrame, target: DataFrame, mapping: Pairs, keys: Pairs
) -> DataFrame:
    """One row per differing joined row: ``<keys>, mismatch_details, src_n, tgt_n, joined_rows``.

    The detail lists ``column:source!=target`` for each differing cell in mapping order, or
    tells on which side the key is missing.  Keys with several rows on a side give a row per
    distinct value, ``column:value in N source rows and M target rows``.
    """
    cells = _cells(source, target, mapping, keys)
    value = (
        "concat(column_name, ':', coalesce(source_value, target_value, 'NULL'),"
        " format_string(' in %s source rows and %s target rows', src_n, tgt_n))"
    )

    def detailed(df: DataFrame, detail: str) -> DataFrame:
        out = [*map(quoted, cells.keys), f"{detail} AS mismatch_details", *_COUNTS]
        return df.selectExpr(*out)

    once = f"if({_SINGLE}, {cells.details()}, {cells.key_detail()})"
    light, heavy, _ = _dealt(cells)
    if light is not None:
        found = detailed(_paired(light, cells), once).unionByName(detailed(_values_together(light, cells), value))
        if heavy is None:
            return found
    totals = _totals(heavy)
    others = (
        detailed(_excess(heavy, totals), once)
        .unionByName(detailed(_missing(totals), cells.key_detail()))
        .unionByName(detailed(_values(heavy, totals, False), value))
    )
    return others if light is None else found.unionByName(others)


def _cells(source: DataFrame, target: DataFrame, mapping: Pairs, keys: Pairs) -> _Cells:
    sides = mapped_sides(source, target, mapping, keys)
    left, right = comparable_columns(sides.source), comparable_columns(sides.target)
    left, right = align_types(left, right, sides.keys, marker="uncastable_key")
    left, right = align_types(left, right, sides.columns)
    types = types_of(left.unionByName(right))

    def cast_in(marker: str) -> list[str]:
        return types[marker].names if marker in types else []

    def widened(df: DataFrame) -> DataFrame:
        own = types_of(df)
        return df.selectExpr(
            *[
                quoted(c)
                if own[c] == dtype
                else f"CAST({quoted(c)} AS {dtype.simpleString()}) AS {quoted(c)}"
                for c, dtype in types.items()
            ]
        )

    return _Cells(
        widened(left),
        widened(right),
        sides.keys,
        {c: types[c] for c in sides.columns},
        frozenset(cast_in("uncastable")),
        tuple(cast_in("uncastable_key")),
        sides.shown,
    )


def _dealt(cells: _Cells) -> tuple[DataFrame | None, _Cells | None, str]:
    """The rows that are brought together by key, with the totals of their key; the others, and what tells them.

    One look at the key columns counts the rows of each part.  A part of more than ``HEAVY`` rows holds hot keys, or the table is
    beyond ``PARTS`` times as many.
    """
    if cells.part is None:
        return None, cells, "true"
    parts = cells.rows.groupBy(F.expr(cells.part).alias("part")).agg(F.count("*").alias("n"))
    counts = parts.agg(F.sum("n").alias("n"), F.collect_list(F.expr(f"if(n > {HEAVY}, part, NULL)")).alias("heavy")).first()
    where = f"{cells.part} IN ({', '.join(f'{part}L' for part in sorted(counts['heavy'])) or 'NULL'})"
    rows, heavy = cells.rows, None
    if counts["heavy"]:
        heavy = replace(cells, source=cells.source.where(where), target=cells.target.where(where))
        rows = rows.where(f"NOT ({where})")
    # So many tasks that none gets more rows as the tables grow; of few rows Spark makes fewer.
    tasks = -(-(counts["n"] or 0) // SHARE)
    if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        rows = rows.repartition(tasks, *cells.group)
    key = Window.partitionBy(*cells.group).orderBy(IN_TARGET)
    whole = key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = [F.sum(side).over(whole).alias(total) for side, total in zip((IN_SOURCE, IN_TARGET), _TOTALS)]
    of_side = [
        F.first(F.expr(f"if({side} = 1, {_ROW}, NULL)"), ignorenulls=True).over(whole).alias(name)
        for side, name in ((IN_SOURCE, _SRC), (IN_TARGET, _TGT))
    ]
    return rows.select("*", *totals, *of_side, F.row_number().over(key).alias(_PLACE)), heavy, where


def _paired(light: DataFrame, cells: _Cells) -> DataFrame:
    """One row for each key that is on one side only, or that is unique and whose rows differ; as ``_excess`` and ``_missing``."""
    own = light.where(f"{_PLACE} = 1 AND NOT (({NOT_UNIQUE}) AND src_total * tgt_total > 0)")
    return own.selectExpr(
        *cells.group, *_TOTALS, "src_total AS src_n", "tgt_total AS tgt_n",
        "greatest(src_total, tgt_total) AS joined_rows", _SRC, _TGT,
    ).where(f"{_MISSING} OR {cells.any_diff()}")


def _counted(cells: _Cells) -> DataFrame:
    """Each distinct row of a key with its copies on both sides."""
    return cells.rows.groupBy(*cells.group, _ROW).agg(
        F.expr(f"sum({IN_SOURCE}) AS src_n"), F.expr(f"sum({IN_TARGET}) AS tgt_n")
    )


def _excess(cells: _Cells, totals: DataFrame) -> DataFrame:
    """Keys with at most one row per side that are on one side only or whose rows differ.

    ``<keys>, [uncastable_key], src_n, tgt_n, joined_rows, __source_row, __target_row``
    """
    differing = (
        _counted(cells)
        .where("src_n <> tgt_n")
        .alias("r")
        .join(totals.alias("d"), F.expr(_same_key(cells, "r", "d")), "left_anti")
    )
    source = differing.where("src_n > tgt_n").withColumnRenamed("src_n", IN_SOURCE).drop("tgt_n")
    target = differing.where("tgt_n > src_n").withColumnRenamed("tgt_n", IN_TARGET).drop("src_n")
    joined = source.alias("s").join(target.alias("t"), F.expr(_same_key(cells, "s", "t")), "full_outer")
    return joined.selectExpr(
        *[f"coalesce(s.{k}, t.{k}) AS {k}" for k in cells.group],
        f"coalesce({IN_SOURCE}, 0L) AS src_n",
        f"coalesce({IN_TARGET}, 0L) AS tgt_n",
        "1L AS joined_rows",
        f"s.{_ROW} AS {_SRC}",
        f"t.{_ROW} AS {_TGT}",
    )


def _missing(totals: DataFrame) -> DataFrame:
    """Keys with several rows on one side and none on the other."""
    return totals.where("src_total = 0 OR tgt_total = 0").selectExpr(
        "*", "src_total AS src_n", "tgt_total AS tgt_n", "src_total + tgt_total AS joined_rows"
    )


def _same_key(cells: _Cells, left: str, right: str) -> str:
    return " AND ".join(f"{left}.{k} <=> {right}.{k}" for k in cells.group)


def _joined(cells: _Cells, duplicates: DataFrame | None = None) -> DataFrame:
    """The same relation by a full outer join, for keys that are unique once a few others are left out."""
    # Marks tell presence; a key may be null on both sides.
    source = cells.source.selectExpr("*", f"1L AS {IN_SOURCE}")
    target = cells.target.selectExpr("*", f"1L AS {IN_TARGET}")
    if duplicates is not None:
        few = F.broadcast(duplicates.selectExpr(*cells.group)).alias("d")
        source, target = (
            df.alias("r").join(few, F.expr(_same_key(cells, "r", "d")), "left_anti") for df in (source, target)
        )
    source, target = source.alias("s"), target.alias("t")
    return (
        source.join(target, F.expr(_same_key(cells, "s", "t")), "full_outer")
        .selectExpr(
            *[f"coalesce(s.{k}, t.{k}) AS {k}" for k in cells.group],
            f"coalesce({IN_SOURCE}, 0L) AS src_n",
            f"coalesce({IN_TARGET}, 0L) AS tgt_n",
            "1L AS joined_rows",
            f"{cells.row('s.')} AS {_SRC}",
            f"{cells.row('t.')} AS {_TGT}",
        )
        .where(f"{_MISSING} OR {cells.any_diff()}")
    )


def _inline(cells: _Cells, rows: DataFrame, lines: str, repeated: str) -> DataFrame:
    keys = [quoted(k) for k in cells.keys]
    found = rows.selectExpr(*keys, f"inline({lines})", f"{repeated} AS repeated", *_COUNTS).where("kind IS NOT NULL")
    return found.selectExpr(*keys, *_LINE, "repeated", *_COUNTS)


def _key_totals(cells: _Cells) -> DataFrame:
    return cells.rows.groupBy(*cells.group).agg(
        F.expr(f"sum({IN_SOURCE}) AS src_total"), F.expr(f"sum({IN_TARGET}) AS tgt_total")
    )


def _totals(cells: _Cells) -> DataFrame:
    return _key_totals(cells).where(NOT_UNIQUE)


def _values(cells: _Cells, totals: DataFrame, stored: bool) -> DataFrame:
    """The product of each repeated key, given by the distinct values of each column.

    Of the ``src_total * tgt_total`` joined rows, those with this value in the source and
    another in the target number ``src_n * (tgt_total - tgt_n)``; summed over the lines of
    a column they are all joined rows whose cells differ.

    Unless the keys are stored, the rows pass a test that there are such keys.  The join has one
    row per key on its right side, so that adaptive execution can split a hot key on the
    left.  The key goes on as a struct: the next grouping, which counts the copies
    of each distinct row, then shuffles anew and does not tie that split to the join.
    """
    # Keys of one side only have nothing to be multiplied with.
    totals = totals.where("src_total * tgt_total > 0")
    rows = cells.rows if stored else cells.rows.where(totals.exists())
    group = F.expr(f"struct({', '.join(f'r.{k}' for k in cells.group)}) AS {_GROUP}")
    counted = (
        rows.alias("r")
        .join(totals.alias("d"), F.expr(_same_key(cells, "r", "d")))
        .groupBy(group, *_TOTALS, _ROW)
        .agg(F.expr(f"sum({IN_SOURCE}) AS src_n"), F.expr(f"sum({IN_TARGET}) AS tgt_n"))
    )
    return _value_lines(cells, counted, [_GROUP], [f"{_GROUP}.{quoted(k)} AS {quoted(k)}" for k in cells.keys])


def _values_together(light: DataFrame, cells: _Cells) -> DataFrame:
    """The same where the rows of a key are together: no row or line is shuffled again."""
    rows = light.where(f"({NOT_UNIQUE}) AND src_total * tgt_total > 0")
    rows = rows.withColumnsRenamed({IN_SOURCE: "src_n", IN_TARGET: "tgt_n"})
    return _value_lines(cells, rows, cells.group, list(map(quoted, cells.keys)))


def _value_lines(cells: _Cells, counted: DataFrame, group: list[str], keys: list[str]) -> DataFrame:
    """Lines from rows of repeated keys with their copies: ``<group>, src_total, tgt_total, __row, src_n, tgt_n``."""

    def value(name: str) -> str:
        dtype = cells.types[name]
        plain = plain_zero(f"{_ROW}.{quoted(name)}", dtype)
        text, unread = as_text(plain, dtype), "false"
        if name in cells.cast:
            unread = f"{cells.raw(_ROW, name)} IS NOT NULL"
            text = f"coalesce({cells.raw(_ROW, name)}, {text})"
        # Two instants can print alike in the session's zone.
        instant = f"unix_micros({plain})" if isinstance(dtype, T.TimestampType) else "NULL"
        return struct(
            {
                "column_name": literal(cells.shown[name]),
                "value": text,
                "unread": unread,
                "instant": f"CAST({instant} AS BIGINT)",
            }
        )

    none = (
        "CAST(array() AS ARRAY<STRUCT<column_name: STRING, value: STRING, unread: BOOLEAN,"
        " instant: BIGINT>>)"
    )
    values = f"array({', '.join(map(value, cells.types))})" if cells.types else none
    kind = f"if(value IS NULL, '{Kind.NULL_VS_VALUE}', '{Kind.VALUE}')"
    return (
        counted.selectExpr(*group, *_TOTALS, "src_n", "tgt_n", f"inline({values})")
        .groupBy(*group, *_TOTALS, "column_name", "value", "unread", "instant")
        .agg(F.expr("sum(src_n) AS src_n"), F.expr("sum(tgt_n) AS tgt_n"))
        .where("src_n < src_total OR tgt_n < tgt_total")
        .selectExpr(
            *keys,
            "column_name",
            "if(src_n > 0, value, NULL) AS source_value",
            "if(tgt_n > 0, value, NULL) AS target_value",
            f"if(unread, '{Kind.UNCASTABLE}', {kind}) AS kind",
            "true AS repeated",
            "src_n",
            "tgt_n",
            "src_n * (tgt_total - tgt_n) AS joined_rows",
        )
    )
