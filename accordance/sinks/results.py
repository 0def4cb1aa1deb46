"""Difference rows of all checks in one table of fixed columns."""

from __future__ import annotations

import re
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accordance.functions.expressions import as_text, literal, quoted, struct
from accordance.model import ConfigError, Kind
from accordance.operators.align import comparable_columns, types_of

# The kinds of place results may be written to.
TARGET_TYPES = ("hive", "parquet", "orc")

#: Where files say which run of a check counts; Spark's readers pass over names with an underscore first.
_CURRENT = "_current"

#: A stored difference row.
RESULTS_SCHEMA = (
    "row_key string, column_name string, source_value string, target_value string, kind string, src_n bigint,"
    " tgt_n bigint, status string, start_time timestamp, end_time timestamp, total_time_taken_for_execution bigint,"
    " record_count bigint, mismatch_count int, source_count bigint, job_name string, recon_type string, run_id string"
)


def _common(
    df: DataFrame,
    names: list[str],
    kind: str,
    cell: tuple[str, str, str] = ("NULL", "NULL", "NULL"),
    counts: tuple[str, str] = ("NULL", "NULL"),
) -> DataFrame:
    """The rows in the common columns; the named columns become one JSON text."""
    types = types_of(df)
    row = T.StructType([T.StructField(name, types[name]) for name in names])
    key = as_text(struct({name: quoted(name) for name in names}), row)
    column_name, source_value, target_value = cell
    src_n, tgt_n = counts
    return df.selectExpr(
        f"{key} AS row_key",
        f"CAST({column_name} AS STRING) AS column_name",
        f"CAST({source_value} AS STRING) AS source_value",
        f"CAST({target_value} AS STRING) AS target_value",
        f"{kind} AS kind",
        f"CAST({src_n} AS BIGINT) AS src_n",
        f"CAST({tgt_n} AS BIGINT) AS tgt_n",
    )


def cell_results(cells: DataFrame, keys: list[str]) -> DataFrame:
    cell = "column_name", "source_value", "target_value"
    return _common(cells, keys, "kind", cell, ("src_n", "tgt_n"))


def _unread(df: DataFrame, marker: str, in_source: str) -> tuple[str, str, str]:
    """The raw text of unreadable cells as the value of its side."""
    if marker not in df.columns:
        return "NULL", "NULL", "NULL"
    raw = f"to_json({marker})"
    return "NULL", f"if({in_source}, {raw}, NULL)", f"if({in_source}, NULL, {raw})"


def row_results(diff: DataFrame) -> DataFrame:
    names = [c for c in diff.columns if c not in ("uncastable", "src_n", "tgt_n")]
    kind = f"if(src_n > tgt_n, '{Kind.SOURCE_ONLY}', '{Kind.TARGET_ONLY}')"
    cell = _unread(diff, "uncastable", "src_n > tgt_n")
    return _common(diff, names, kind, cell, ("src_n", "tgt_n"))


def key_results(diff: DataFrame) -> DataFrame:
    names = [c for c in diff.columns if c not in ("uncastable_key", "kind")]
    cell = _unread(diff, "uncastable_key", f"kind = '{Kind.MISSING_IN_TARGET}'")
    return _common(diff, names, "kind", cell)


def violation_results(rows: DataFrame) -> DataFrame:
    rows = comparable_columns(rows)
    return _common(rows, rows.columns, literal(Kind.VIOLATION), counts=("1", "NULL"))


def malformed_results(lines: DataFrame, side: str) -> DataFrame:
    """Lines of a text file that are no rows, as values of their side."""
    line = ("NULL", "line", "NULL") if side == "source" else ("NULL", "NULL", "line")
    counts = ("1", "NULL") if side == "source" else ("NULL", "1")
    return _common(lines, ["reason"], literal(Kind.MALFORMED), line, counts)


def write_results(df: DataFrame, target_type: str, location: str) -> None:
    """Append to a table, or replace the files of the jobs in ``df`` and of no other job.

    All rows of a job have to come in one call.  What a run stores goes by ``commit_results``.
    """
    kind = check_target_type(target_type)
    if kind == "hive":
        df.write.mode("append").saveAsTable(location)
        return
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("job_name")
        .format(kind)
        .save(location)
    )


def check_target_type(target_type: str) -> str:
    kind = (target_type or "").lower()
    if kind not in TARGET_TYPES:
        raise ConfigError(f"unsupported target type {target_type!r}, know {list(TARGET_TYPES)}")
    return kind


def commit_results(
    rows: DataFrame | None, target_type: str, location: str, job_name: str, check: str, run_id: str
) -> None:
    """The difference rows of one check of one run, None if it found nothing, as the newest of that check.

    Files of a run lie apart, ``job_name=/recon_type=/run_id=``, and count from the moment on at which an empty file
    of the run's time and name is put under ``_current``; then the earlier runs of this check, and of no other, are
    removed.  What breaks off before leaves the earlier run in force.  A table is appended to, unless it has
    rows of this run and check already.
    """
    kind = check_target_type(target_type)
    if kind == "hive":
        if rows is not None and not _held(rows.sparkSession, location, job_name, check, run_id):
            rows.write.mode("append").saveAsTable(location)
        return
    spark = rows.sparkSession if rows is not None else SparkSession.getActiveSession()
    root = location.rstrip("/")
    own = f"job_name={_escaped(job_name)}/recon_type={_escaped(check)}"
    if rows is not None:
        path = f"{root}/{own}/run_id={_escaped(run_id)}"
        rows.drop("job_name", "recon_type", "run_id").write.mode("overwrite").format(kind).save(path)
    else:
        _delete(spark, f"{root}/{own}/run_id={_escaped(run_id)}")
    marks = f"{root}/{_CURRENT}/{own}"
    mark = f"{time.time_ns():020d}.run_id={_escaped(run_id)}"
    files, at = _files(spark, f"{marks}/{mark}")
    files.create(at, True).close()
    for old in _listed(spark, f"{marks}/*"):
        if old.getName() < mark:
            _delete(spark, str(old))
    for old in _listed(spark, f"{root}/{own}/run_id=*"):
        if old.getName() != f"run_id={_escaped(run_id)}":
            _delete(spark, str(old))


def read_results(spark: SparkSession, target_type: str, location: str) -> DataFrame:
    """The stored difference rows: of files those of the newest complete run of each check."""
    kind = check_target_type(target_type)
    if kind == "hive":
        return spark.table(location)
    root = location.rstrip("/")
    newest: dict[tuple[str, str], str] = {}
    for mark in sorted(_listed(spark, f"{root}/{_CURRENT}/*/*/*"), key=lambda m: m.getName()):
        job, check = mark.getParent().getParent().getName(), mark.getParent().getName()
        newest[job, check] = mark.getName().split(".", 1)[1]
    # One row for each check that has ever been stored.
    names = ("job_name", "recon_type", "run_id")
    current = [tuple(_unescaped(part.split("=", 1)[1]) for part in (*key, run)) for key, run in newest.items()]
    marks = spark.createDataFrame(current, ", ".join(f"{n} string" for n in names))
    rows = spark.read.schema(RESULTS_SCHEMA).format(kind)
    # Without marks there is no folder either.
    found = rows.load(root) if current else spark.createDataFrame([], RESULTS_SCHEMA)
    return found.join(F.broadcast(marks), list(names)).select(*found.columns)


def _held(spark: SparkSession, table: str, job_name: str, check: str, run_id: str) -> bool:
    if not spark.catalog.tableExists(table):
        return False
    own = {"job_name": job_name, "recon_type": check, "run_id": run_id}
    if not set(own) <= set(spark.table(table).columns):
        return False
    rows = reduce(lambda df, c: df.where(F.col(c) == F.lit(own[c])), own, spark.table(table))
    return not rows.isEmpty()


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _listed(spark: SparkSession, pattern: str) -> list:
    # Brackets and braces of the location are escaped in names, and no patterns elsewhere.
    files, at = _files(spark, pattern)
    return [f.getPath() for f in files.globStatus(at) or []]


def _delete(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def _escaped(value: str) -> str:
    """A partition value as Spark spells it in paths."""
    special = set("\"#%'*/:=?\\{[]^\x7f") | {chr(c) for c in range(32)}
    return "".join(f"%{ord(c):02X}" if c in special else c for c in value)


def _unescaped(value: str) -> str:
    return re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)
