"""Expressions used by the checks, as SQL text.

Text keeps the driver's work small for tables of many columns, where a Column object for
every part of every cell comparison would not; all of it is built-in and stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_JSON_OPTIONS = (
    "map('ignoreNullFields', 'false',"
    " 'timestampFormat', 'yyyy-MM-dd HH:mm:ss.SSSSSSXXX',"
    " 'timestampNTZFormat', 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
)

_CASTABLE_FROM_TEXT = (
    T.NumericType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def null_aware_diff(left: Column, right: Column) -> Column:
    """True where the cells differ, null against value included; never null."""
    return ~left.eqNullSafe(right)


def quoted(name: str) -> str:
    """The column of exactly this name, dots and spaces included."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def differs(left: str, right: str) -> str:
    return f"NOT ({left} <=> {right})"


def struct(parts: dict[str, str]) -> str:
    """A struct of named expressions."""
    return "struct(" + ", ".join(f"{e} AS {quoted(n)}" for n, e in parts.items()) + ")"


def holds(dtype: T.DataType, *kinds: type) -> bool:
    """Whether the type is, or contains, one of the given types."""
    if isinstance(dtype, kinds):
        return True
    if isinstance(dtype, T.ArrayType):
        return holds(dtype.elementType, *kinds)
    if isinstance(dtype, T.MapType):
        return holds(dtype.keyType, *kinds) or holds(dtype.valueType, *kinds)
    if isinstance(dtype, T.StructType):
        return any(holds(f.dataType, *kinds) for f in dtype.fields)
    return False


def comparable(value: str, dtype: T.DataType, depth: int = 0) -> str:
    """The value in a form that groups, joins and compares.

    Variants become JSON text and maps become sorted entries, at any depth.
    """
    if not holds(dtype, T.VariantType, T.MapType):
        return value
    if isinstance(dtype, T.VariantType):
        return f"to_json({value})"
    element = f"e{depth}"
    if isinstance(dtype, T.ArrayType):
        inner = comparable(element, dtype.elementType, depth + 1)
        return f"transform({value}, {element} -> {inner})"
    if isinstance(dtype, T.MapType):
        entry = struct(
            {
                "key": comparable(f"{element}.key", dtype.keyType, depth + 1),
                "value": comparable(f"{element}.value", dtype.valueType, depth + 1),
            }
        )
        return f"array_sort(transform(map_entries({value}), {element} -> {entry}))"
    return _rebuilt(value, dtype, lambda v, t: comparable(v, t, depth + 1))


def plain_zero(value: str, dtype: T.DataType, depth: int = 0) -> str:
    """Negative zero as zero, since the two compare equal but print differently."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return f"if({value} = 0, CAST(0 AS {dtype.simpleString()}), {value})"
    if not holds(dtype, T.FloatType, T.DoubleType):
        return value
    if isinstance(dtype, T.ArrayType):
        element = f"z{depth}"
        inner = plain_zero(element, dtype.elementType, depth + 1)
        return f"transform({value}, {element} -> {inner})"
    return _rebuilt(value, dtype, lambda v, t: plain_zero(v, t, depth + 1))


def _rebuilt(value: str, dtype: T.StructType, change) -> str:
    parts = {f.name: change(f"{value}.{quoted(f.name)}", f.dataType) for f in dtype.fields}
    return f"if({value} IS NULL, NULL, {struct(parts)})"


def as_text(value: str, dtype: T.DataType) -> str:
    """The cell as text; nested values as JSON, so that equal text means equal value."""
    if isinstance(dtype, _NESTED):
        return f"to_json({value}, {_JSON_OPTIONS})"
    if isinstance(dtype, T.BinaryType):
        return f"hex({value})"
    return value if isinstance(dtype, T.StringType) else f"CAST({value} AS STRING)"


def digestible(types: dict[str, T.DataType]) -> bool:
    """Whether equal values of these types have equal digests; texts that compare by a collation have not."""
    return not any(_collated(dtype) for dtype in types.values())


def _collated(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StringType):
        return dtype.collation != "UTF8_BINARY"
    if isinstance(dtype, T.ArrayType):
        return _collated(dtype.elementType)
    return isinstance(dtype, T.StructType) and any(_collated(f.dataType) for f in dtype.fields)


def digest(types: dict[str, T.DataType]) -> str:
    """128 bits of a row of comparable columns, equal for rows that group together.

    Two 64-bit hashes of the same values by different seeds.  A hash passes over nulls, so that which columns are null goes
    in as numbers, and nested values as text.
    """
    parts = []
    for name, dtype in types.items():
        value = quoted(name)
        parts.append(as_text(plain_zero(value, dtype), dtype) if isinstance(dtype, _NESTED) else value)
    nulls = [f"if({quoted(name)} IS NULL, {1 << n % 62}L, 0L)" for n, name in enumerate(types)]
    masks = [" + ".join(nulls[n : n + 62]) for n in range(0, len(nulls), 62)]
    return struct({c: f"xxhash64({seed}, {', '.join(masks + parts)})" for c, seed in (("high", 1), ("low", 2))})


def castable_from_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, _CASTABLE_FROM_TEXT)


def try_cast(value: str, dtype: T.DataType) -> str:
    return f"try_cast({value} AS {dtype.simpleString()})"


def uncastable_text(value: str, dtype: T.DataType) -> str:
    """The raw text where it is not a value of the type, or is more than that, else null."""
    lost = f"({try_cast(value, dtype)} IS NULL)"
    if more := _more_than(value, dtype):
        lost = f"({lost} OR coalesce({more}, false))"
    return f"if({lost}, {value}, NULL)"


def _more_than(value: str, dtype: T.DataType) -> str | None:
    """Whether text that can be read as the type says more than the value read."""
    read = try_cast(value, dtype)
    if isinstance(dtype, T.DecimalType):
        # All digits before the point that the type has room for, and as many as can be after it.
        wide = f"DECIMAL(38,{38 - (dtype.precision - dtype.scale)})"
        return f"try_cast({value} AS {wide}) <> try_cast({read} AS {wide})"
    if isinstance(dtype, T.DateType):
        return f"try_cast({value} AS TIMESTAMP_NTZ) <> CAST({read} AS TIMESTAMP_NTZ)"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return f"{value} RLIKE '[.][0-9]{{6}}[0-9]*[1-9]'"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return f"try_cast({value} AS DECIMAL(38,0)) <> try_cast({read} AS DECIMAL(38,0)) AND {value} RLIKE '^ *[+-]?[0-9]+ *$'"
    return None


def kept_by_cast(value: str, old: T.DataType, new: T.DataType) -> str:
    """Whether a value that is not null is the same after a cast there and back."""
    there = try_cast(value, new)
    return f"coalesce(try_cast({there} AS {old.simpleString()}) <=> {value} AND {there} IS NOT NULL, false)"


def is_exact(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.IntegralType, T.DecimalType))


def is_binary_float(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def detail_text(name: str, source_text: str, target_text: str) -> str:
    """One difference as ``column:source!=target``."""
    return (
        f"concat({literal(name + ':')}, coalesce({source_text}, 'NULL'), '!=',"
        f" coalesce({target_text}, 'NULL'))"
    )


def epoch_second(millis: int) -> Column:
    """Epoch milliseconds as a timestamp of whole seconds."""
    return F.date_trunc("second", F.timestamp_millis(F.lit(millis)))
