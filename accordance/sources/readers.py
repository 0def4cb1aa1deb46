"""One reader for sources and targets."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession

from accordance.functions.expressions import literal
from accordance.model import ConfigError

# The source types a job row may name.
SOURCE_TYPES = (
    "csv",
    "dat",
    "text",
    "parquet",
    "orc",
    "json",
    "hive",
    "local",
    "jdbc",
    "query",
)

_FORMAT_OF_EXTENSION = {
    "csv": "csv",
    "dat": "dat",
    "txt": "text",
    "text": "text",
    "parquet": "parquet",
    "orc": "orc",
    "json": "json",
}

_COMPRESSED = {"bz2", "gz", "lz4", "snappy", "zst"}

_DEFAULTS = {
    "csv": {"header": "true"},
    "dat": {"header": "true", "delimiter": "|"},
}

_FORMAT_OF_TYPE = {"dat": "csv"}

#: Types whose lines are rows of fields, and the field put after a line to see whether it ends there.
_LINES, _END = ("csv", "dat"), "end-of-line"


def read(
    spark: SparkSession,
    source_type: str,
    location: str | None = None,
    query: str | None = None,
    schema: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A table of any source type; wrong types raise before Spark is asked.

    Text formats give strings unless a schema is given: they are read as the other side's
    types when the sides are aligned; what such a type cannot hold is kept and reported.
    """
    kind = (source_type or "").strip().lower()
    if kind not in SOURCE_TYPES:
        raise ConfigError(f"unsupported source type {source_type!r}, know {list(SOURCE_TYPES)}")
    if kind == "query":
        if not (query or "").strip():
            raise ConfigError("a query source needs a query")
        return spark.sql(f"SELECT * FROM (\n{query.strip().removesuffix(';')}\n)")
    if not (location or "").strip():
        raise ConfigError(f"a {kind} source needs a location")
    if kind == "hive":
        return spark.table(location)
    if kind == "jdbc":
        return _read_jdbc(spark, location, options or {})
    if kind == "local":
        kind = format_of_path(location)
    given = {**_DEFAULTS.get(kind, {}), **(options or {})}
    if kind in _LINES and of_several_lines(given):
        # Records are no lines then, which malformed_lines could list: the first wrong one fails the check.
        given = {"mode": "FAILFAST", "columnPruning": "false", **given}
    reader = spark.read.format(_FORMAT_OF_TYPE.get(kind, kind))
    if schema:
        reader = reader.schema(schema)
    return reader.options(**given).load(location)


def malformed_lines(
    spark: SparkSession,
    source_type: str,
    location: str,
    schema: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The lines of a csv or dat source that are no rows of its columns: ``line, reason``.

    Spark's reader drops fields that are too many, fills up those that are missing and closes open quotes, all
    without a word.  Here each line is parsed with one more field after it: what has another number of fields
    is ``fields``, and a quote that swallows that field is an ``open quote``.  Blank lines, comments and headers are none.
    """
    kind = lines_kind(source_type, location)
    if kind is None:
        raise ConfigError(f"{source_type!r} sources have no lines of fields")
    given = {**_DEFAULTS[kind], **(options or {})}
    if of_several_lines(given):
        raise ConfigError("records of several lines can't be looked at line by line")
    names = read(spark, kind, location, schema=schema, options=options).columns
    sep = _option(given, "sep", _option(given, "delimiter", ",")).replace("\\t", "\t")
    parser = {
        name: value
        for name, value in given.items()
        if name.lower() in ("quote", "escape", "chartoescapequoteescaping", "maxcolumns", "maxcharspercolumn")
    }
    parser |= {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}
    text = spark.read.options(**{k: v for k, v in given.items() if k.lower() in ("linesep", "encoding", "pathglobfilter")})
    lines = text.text(location).where("trim(value) <> ''")
    comment = _option(given, "comment", "")
    if comment:
        lines = lines.where(f"NOT startswith(value, {literal(comment)})")

    def parsed(line: str, fields: int) -> str:
        columns = ", ".join([*[f"c{n} STRING" for n in range(fields)], "bad STRING"])
        pairs = ", ".join(f"{literal(k)}, {literal(v)}" for k, v in parser.items())
        return f"from_csv({line}, {literal(columns)}, map({pairs}))"

    n = len(names)
    rows = lines.selectExpr("value AS line", f"{parsed(f'concat(value, {literal(sep + _END)})', n + 1)} AS row")
    wrong = rows.where(f"row.bad IS NOT NULL OR NOT (row.c{n} <=> {literal(_END)})")
    if _option(given, "header", "false").lower() == "true":
        header = " AND ".join(f"row.c{i} <=> {literal(name)}" for i, name in enumerate(names))
        wrong = wrong.where(f"NOT ({header})")
    reason = f"if(row.c{n} IS NULL AND {_open(parser, 'line')}, 'open quote', 'fields') AS reason"
    return wrong.selectExpr("line", reason)


def _open(parser: dict[str, str], line: str) -> str:
    """Whether the quotes of a line, without escaped ones, are odd in number."""
    quote, escape = _option(parser, "quote", '"'), _option(parser, "escape", "\\")
    plain = f"replace(replace({line}, {literal(escape * 2)}, ''), {literal(escape + quote)}, '')" if escape != quote else line
    return f"(length({plain}) - length(replace({plain}, {literal(quote)}, ''))) % 2 = 1"


def lines_kind(source_type: str | None, location: str | None) -> str | None:
    """csv or dat, if the source is one of them, told by its type or extension."""
    kind = (source_type or "").strip().lower()
    if kind == "local" and location:
        kind = format_of_path(location)
    return kind if kind in _LINES else None


def of_several_lines(options: dict[str, str]) -> bool:
    return _option(options, "multiLine", "false").lower() == "true"


def _option(options: dict[str, str], name: str, default: str) -> str:
    """An option, whose name is spelled in any case."""
    return {k.lower(): str(v) for k, v in options.items()}.get(name.lower(), default)


def format_of_path(path: str) -> str:
    """The source type told by the file extension, seen through a compression suffix."""
    suffixes = [s.lstrip(".").lower() for s in PurePosixPath(path).suffixes]
    if suffixes and suffixes[-1] in _COMPRESSED:
        suffixes.pop()
    extension = suffixes[-1] if suffixes else ""
    if extension not in _FORMAT_OF_EXTENSION:
        raise ConfigError(f"cannot tell the format of {path!r} by its extension")
    return _FORMAT_OF_EXTENSION[extension]


def _read_jdbc(spark: SparkSession, table: str, options: dict[str, str]) -> DataFrame:
    """A database table, read by many tasks that each take a range of one column."""
    if "url" not in options:
        raise ConfigError("a jdbc source needs the option url")
    split = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
    given = [name for name in split if name in options]
    if given != list(split) and given != ["numPartitions"]:
        raise ConfigError(
            f"a jdbc source needs all of {', '.join(split)}; numPartitions=1 alone reads the table by one task"
        )
    return spark.read.format("jdbc").options(**{**options, "dbtable": table}).load()
