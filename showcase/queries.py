"""One query per operator; each takes the session and a folder of test tables."""

from __future__ import annotations

import tempfile
from dataclasses import replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import accordance as ac
from accordance.functions.expressions import null_aware_diff
from accordance.functions.job_text import explode_checks, parse_mappings
from accordance.model import AUDIT_SCHEMA, JOBS_SCHEMA
from accordance.plans.workspace import new_folder
from accordance.sinks.audit import append_audit
from accordance.sinks.results import cell_results, key_results, write_results
from accordance.sources.jobs import audit_for_run, job_lookup
from showcase import pairs

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

ORDERS_MAPPING = ac.parse_mapping(pairs.ORDERS_MAPPING)
ORDERS_KEYS = ac.parse_keys(pairs.ORDERS_KEYS, ORDERS_MAPPING)
LINES_MAPPING = ac.parse_mapping(pairs.LINES_MAPPING)
LINES_KEYS = ac.parse_keys(pairs.LINES_KEYS)
EVENTS_MAPPING = ac.parse_mapping(pairs.EVENTS_MAPPING)
EVENTS_KEYS = ac.parse_keys(pairs.EVENTS_KEYS)

# Fixed values of the tagged results.
START_MS, END_MS = 1_700_000_000_123, 1_700_000_065_456


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ac.read(spark, "parquet", f"{sf_dir}/{name}.parquet")


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A text over the test tables, as a query source reads it."""
    used = {name: table(spark, sf_dir, name) for name in TABLES if name in text}
    return ac.rule_violations(used, text)


def on_files(text: str, sf_dir: str) -> str:
    """The text with the files of the test tables in place of views."""
    used = [f"{t} AS (SELECT * FROM parquet.`{sf_dir}/{t}.parquet`)" for t in TABLES if t in text]
    return f"WITH {', '.join(used)} {text}"


def orders_pair(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return sql(spark, sf_dir, pairs.ORDERS_SOURCE), sql(spark, sf_dir, pairs.ORDERS_TARGET)


def text_pair(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return sql(spark, sf_dir, pairs.ORDERS_AS_TEXT), sql(spark, sf_dir, pairs.ORDERS_TYPED)


def lines_pair(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return sql(spark, sf_dir, pairs.LINES_SOURCE), sql(spark, sf_dir, pairs.LINES_TARGET)


def own_names_pair(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return sql(spark, sf_dir, pairs.OWN_NAMES_SOURCE), sql(spark, sf_dir, pairs.OWN_NAMES_TARGET)


def vectors_pair(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return sql(spark, sf_dir, pairs.VECTORS_SOURCE), sql(spark, sf_dir, pairs.VECTORS_TARGET)


def events_pair(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return sql(spark, sf_dir, pairs.EVENTS_SOURCE), sql(spark, sf_dir, pairs.EVENTS_TARGET)


# Sources: written to the shared folder with Spark, then read as that type.


def src_csv(spark, sf_dir):
    path = new_folder(spark, "orders.csv")
    sql(spark, sf_dir, pairs.ORDERS_SOURCE).write.option("header", True).csv(path)
    return ac.read(spark, "csv", path)


def src_dat(spark, sf_dir):
    path = new_folder(spark, "lines.dat")
    lines = sql(spark, sf_dir, pairs.LINES_SOURCE)
    lines.write.option("header", True).option("delimiter", "|").csv(path)
    return ac.read(spark, "dat", path)


def src_malformed_lines(spark, sf_dir):
    path = new_folder(spark, "orders.csv")
    sql(spark, sf_dir, pairs.ORDER_LINES).select("value").write.text(path)
    schema = "o_orderkey bigint, o_orderstatus string, o_orderpriority string"
    return ac.malformed_lines(spark, "csv", path, schema=schema, options={"header": "false"})


def src_text(spark, sf_dir):
    path = new_folder(spark, "documents.txt")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    return ac.read(spark, "text", path)


def src_parquet(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def src_orc(spark, sf_dir):
    path = new_folder(spark, "events.orc")
    table(spark, sf_dir, "events").write.orc(path)
    return ac.read(spark, "orc", path)


def src_json(spark, sf_dir):
    path = new_folder(spark, "conversations.json")
    table(spark, sf_dir, "conversations").write.json(path)
    return ac.read(spark, "json", path, schema="conv_id long, turn long, role string, text string")


def src_table(spark, sf_dir):
    path = new_folder(spark, "customer")
    name = "customer_" + path.split("/")[-2]
    table(spark, sf_dir, "customer").write.option("path", path).saveAsTable(name)
    return ac.read(spark, "hive", name)


def src_by_extension(spark, sf_dir):
    return ac.read(spark, "local", f"{sf_dir}/part.parquet")


def src_query(spark, sf_dir):
    query = f"SELECT o_custkey, count(*) AS n_orders FROM parquet.`{sf_dir}/orders.parquet` GROUP BY 1"
    return ac.read(spark, "query", query=query)


def job_lookup_(spark, sf_dir):
    return job_lookup(sql(spark, sf_dir, pairs.JOBS_OF_PARTS), "part-42")


def audit_for_run_(spark, sf_dir):
    return audit_for_run(sql(spark, sf_dir, pairs.AUDIT_OF_EVENTS), "run-8")


def parse_mappings_(spark, sf_dir):
    return parse_mappings(sql(spark, sf_dir, pairs.JOBS_OF_PARTS))


def explode_checks_(spark, sf_dir):
    return explode_checks(sql(spark, sf_dir, pairs.JOBS_OF_PARTS))


# Alignment.


def align_target_to_source(spark, sf_dir):
    return ac.align_target_to_source(orders_pair(spark, sf_dir)[1], ORDERS_MAPPING)


def align_source_to_target(spark, sf_dir):
    return ac.align_source_to_target(orders_pair(spark, sf_dir)[0], ORDERS_MAPPING)


def key_projection(spark, sf_dir):
    sides = ac.key_projection(*orders_pair(spark, sf_dir), ORDERS_KEYS)
    return sides.source.withColumn("side", F.lit("source")).unionByName(
        sides.target.withColumn("side", F.lit("target"))
    )


def align_types(spark, sf_dir):
    source, target = text_pair(spark, sf_dir)
    names = ["order_key", "cust_key", "total", "status", "ordered"]
    source, _ = ac.align_types(source.select(names), target.select(names))
    return source.select(*names, F.col("uncastable.total").alias("unread_total"))


def null_aware_diff_(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    both = documents.select("doc_id").join(labels, "doc_id", "left")
    differs = null_aware_diff(F.col("quality"), F.col("toxic"))
    against_one = null_aware_diff(F.col("quality"), F.lit(1))
    return both.select(
        "doc_id", differs.alias("quality_vs_toxic"), against_one.alias("quality_vs_one")
    )


# Differences.


def s2t_cells(spark, sf_dir):
    return ac.s2t_cells(*orders_pair(spark, sf_dir), ORDERS_MAPPING, ORDERS_KEYS)


def s2t_cells_of_text(spark, sf_dir):
    mapping = [(name, name) for name in ("order_key", "cust_key", "total", "status", "ordered")]
    return ac.s2t_cells(*text_pair(spark, sf_dir), [*mapping, ("urgency", "priority")], mapping[:1])


def s2t_cells_of_duplicates(spark, sf_dir):
    return ac.s2t_cells(*lines_pair(spark, sf_dir), LINES_MAPPING, LINES_KEYS)


def s2t_cells_of_hot_keys(spark, sf_dir):
    return ac.s2t_cells(*events_pair(spark, sf_dir), EVENTS_MAPPING, EVENTS_KEYS)


def cell_mismatch_summary(spark, sf_dir):
    return ac.cell_summary(s2t_cells_of_duplicates(spark, sf_dir))


def mismatch_detail_text(spark, sf_dir):
    return ac.mismatch_details(*lines_pair(spark, sf_dir), LINES_MAPPING, LINES_KEYS)


def duplicate_keys(spark, sf_dir):
    return ac.duplicate_keys(*lines_pair(spark, sf_dir), LINES_KEYS)


def row_diff(spark, sf_dir):
    return ac.row_diff(*lines_pair(spark, sf_dir))


def s2t_rows(spark, sf_dir):
    return ac.s2t_rows(*orders_pair(spark, sf_dir), ORDERS_MAPPING)


def row_diff_of_text(spark, sf_dir):
    diff = ac.row_diff(*text_pair(spark, sf_dir), [("urgency", "priority")])
    return diff.withColumn("unread_total", F.col("uncastable.total")).drop("uncastable")


def row_diff_of_documents(spark, sf_dir):
    """Whole texts, the first two sources against all others: copies cancel one by one."""
    documents = table(spark, sf_dir, "documents").select("text", "lang", "n_chars", "source")
    first = documents.where("source < 'src2'").drop("source")
    second = documents.where("source >= 'src2'").drop("source")
    return ac.row_diff(first, second)


def row_diff_by_digests(spark, sf_dir):
    """Digests of all lines first, then the lines whose digest differs."""
    return ac.stage_row_diff(*lines_pair(spark, sf_dir))[0]


def row_diff_of_own_names(spark, sf_dir):
    return ac.stage_row_diff(*own_names_pair(spark, sf_dir))[0]


def s2t_cells_of_own_names(spark, sf_dir):
    source, target = own_names_pair(spark, sf_dir)
    pairs_of = [(c, c) for c in source.columns]
    return ac.s2t_cells(source, target, pairs_of, pairs_of[:1])


def row_diff_of_vectors(spark, sf_dir):
    """Array columns, compared element by element; shown in millionths."""
    diff = ac.stage_row_diff(*vectors_pair(spark, sf_dir))[0]
    millionths = "transform(embedding, x -> CAST(floor(CAST(x AS DOUBLE) * 1000000) AS BIGINT))"
    return diff.withColumn("embedding", F.expr(f"array_join({millionths}, ',')"))


def s2t_cells_of_vectors(spark, sf_dir):
    """The cells of an array column; of its values only whether there is one, since engines print floats each in its way."""
    mapping = [(c, c) for c in ("vec_id", "embedding", "label")]
    cells = ac.s2t_cells(*vectors_pair(spark, sf_dir), mapping, mapping[:1])
    there = {c: F.when(F.col("column_name") == "embedding", F.col(c).isNotNull().cast("string")).otherwise(F.col(c)) for c in ("source_value", "target_value")}
    return cells.withColumns(there)


def diff_summary(spark, sf_dir):
    return ac.diff_summary(*lines_pair(spark, sf_dir))


def missing_extra_keys(spark, sf_dir):
    return ac.missing_extra(*orders_pair(spark, sf_dir), ORDERS_KEYS)


def missing_labels(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return ac.missing_extra(documents, labels, [("doc_id", "doc_id")])


def record_count(spark, sf_dir):
    return ac.record_count(*orders_pair(spark, sf_dir))


def threshold(spark, sf_dir):
    return ac.threshold(*orders_pair(spark, sf_dir), ORDERS_MAPPING, limit=0.05)


def summary_diff(spark, sf_dir):
    """Orders as files of one partition a priority, against the same with some changed, by sums of digests."""
    paths = []
    for text in (pairs.ORDERS_SOURCE, pairs.ORDERS_PARTLY):
        paths.append(new_folder(spark, "orders"))
        sql(spark, sf_dir, text).write.partitionBy("o_orderpriority").parquet(paths[-1])
    by = ["o_orderpriority"]
    return ac.summary_diff(*[ac.partition_summary(spark.read.parquet(path), by) for path in paths], by)


def schema_drift(spark, sf_dir):
    return ac.schema_drift(*text_pair(spark, sf_dir))


def schema_drift_of_nested(spark, sf_dir):
    return ac.schema_drift(sql(spark, sf_dir, pairs.NESTED_SOURCE), sql(spark, sf_dir, pairs.NESTED_TARGET))


# Rules.


def rule_filter(spark, sf_dir):
    source = sql(spark, sf_dir, pairs.ORDERS_SOURCE)
    return ac.rule_violations({"source_view": source}, pairs.RULE_FILTER)


def rule_join_agg(spark, sf_dir):
    views = {
        "source_view": sql(spark, sf_dir, pairs.ORDERS_SOURCE),
        "lineitem": table(spark, sf_dir, "lineitem"),
    }
    return ac.rule_violations(views, pairs.RULE_JOIN_AGG)


def rule_window(spark, sf_dir):
    views = {"source_view": table(spark, sf_dir, "lineitem")}
    return ac.rule_violations(views, pairs.RULE_WINDOW)


def rule_vs_target(spark, sf_dir):
    views = {"source_view": sql(spark, sf_dir, pairs.ORDERS_SOURCE)}
    target = sql(spark, sf_dir, pairs.TOTALS_TARGET)
    return ac.rule_vs_target(views, pairs.RULE_TOTALS, target, [("o_custkey", "cust_id")])


# Reports.


def mismatch_preview(spark, sf_dir):
    return ac.preview(s2t_cells(spark, sf_dir), 10, ["o_orderkey", "column_name"])


def stratified_preview(spark, sf_dir):
    return ac.stratified_preview(s2t_cells_of_duplicates(spark, sf_dir), 3, by=["l_orderkey", "l_linenumber"])


def tag_results(spark, sf_dir):
    tagged = ac.tag_results(
        missing_extra_keys(spark, sf_dir), "orders", "s2t", "FAILURE", START_MS, END_MS
    )
    return tagged.drop("source_count").withColumns(
        {"start_time": F.unix_millis("start_time"), "end_time": F.unix_millis("end_time")}
    )


def run_rollup(spark, sf_dir):
    return ac.run_rollup(sql(spark, sf_dir, pairs.AUDIT_OF_EVENTS))


def run_report(spark, sf_dir):
    checks = sql(spark, sf_dir, pairs.AUDIT_OF_EVENTS)
    return ac.run_report(checks, sql(spark, sf_dir, pairs.JOB_FLAGS))


# Sinks: written, then read back.


def _tagged(results: DataFrame, job_name: str) -> DataFrame:
    return ac.tag_results(results, job_name, "s2t", "FAILURE", START_MS, END_MS)


def _cell_results(spark, sf_dir):
    return _tagged(cell_results(s2t_cells(spark, sf_dir), ["o_orderkey"]), "cells")


def _key_results(spark, sf_dir):
    return _tagged(key_results(missing_extra_keys(spark, sf_dir)), "keys")


RESULT_COLUMNS = [
    "job_name",
    "row_key",
    "column_name",
    "source_value",
    "target_value",
    "kind",
    "record_count",
]


def _external_table(spark, name: str, schema) -> str:
    path = new_folder(spark, name)
    unique = f"{name}_{path.split('/')[-2]}"
    spark.catalog.createTable(unique, path=path, source="parquet", schema=schema)
    return unique


def sink_table(spark, sf_dir):
    """Two jobs of different keys and columns, appended to one table."""
    cells, keys = _cell_results(spark, sf_dir), _key_results(spark, sf_dir)
    name = _external_table(spark, "recon_results", cells.schema)
    write_results(cells, "hive", name)
    write_results(keys, "hive", name)
    return spark.table(name).select(RESULT_COLUMNS)


def _sink_files(spark, sf_dir, kind):
    """A job of two checks, run twice: the second run replaces what the first has stored."""
    path = new_folder(spark, f"results.{kind}")
    job = ac.Job(
        job_name="orders",
        source_type="query",
        source_query=on_files(pairs.ORDERS_SOURCE, sf_dir),
        target_type="query",
        target_query=on_files(pairs.ORDERS_TARGET, sf_dir),
        checks="s2t, missing_extra_records",
        column_mapping=pairs.ORDERS_MAPPING,
        key_mapping=pairs.ORDERS_KEYS,
        write_results="Y",
    )
    for _ in range(2):
        ac.run_job(spark, job, results_type=kind, results_location=path)
    return ac.read(spark, kind, path).select("recon_type", *RESULT_COLUMNS)


def sink_parquet(spark, sf_dir):
    return _sink_files(spark, sf_dir, "parquet")


def sink_orc(spark, sf_dir):
    return _sink_files(spark, sf_dir, "orc")


def sink_rerun(spark, sf_dir):
    """What is stored after a second run of which one check errs and another finds nothing more.

    Rows of the check that erred are those of the first run; the clean one's are gone.
    """
    path = new_folder(spark, "results")
    job = ac.Job(
        job_name="orders",
        source_type="query",
        source_query=on_files(pairs.ORDERS_SOURCE, sf_dir),
        target_type="query",
        target_query=on_files(pairs.ORDERS_TARGET, sf_dir),
        checks="missing_extra_records, business_rule, s2t",
        column_mapping=pairs.ORDERS_MAPPING,
        key_mapping=pairs.ORDERS_KEYS,
        rule_sql="SELECT * FROM source_view WHERE o_totalprice > 0",
        write_results="Y",
    )
    where = dict(results_type="parquet", results_location=path)
    ac.run_job(spark, job, "first", **where)
    same = replace(
        job,
        target_query=on_files(f"SELECT o_orderkey AS order_id, o_custkey AS cust_id, o_totalprice AS total, o_orderstatus AS status, o_orderdate AS ordered, o_orderpriority AS priority FROM ({pairs.ORDERS_SOURCE}) x", sf_dir),
        rule_sql="SELECT raise_error('no rule') AS order_id, o_custkey FROM source_view",
    )
    ac.run_job(spark, same, "second", **where)
    return ac.read_results(spark, "parquet", path).select("job_name", "recon_type", "run_id", "row_key", "kind")


def sink_audit(spark, sf_dir):
    """Two runs appended to the audit table; one of them is read back."""
    audit = sql(spark, sf_dir, pairs.AUDIT_OF_EVENTS)
    events = audit.withColumn("event_ts", F.timestamp_millis(F.lit(START_MS)))
    name = _external_table(spark, "recon_audit_log", AUDIT_SCHEMA)
    append_audit(events.where("run_id < 'run-5'"), name)
    append_audit(events.where("run_id >= 'run-5'"), name)
    stored = audit_for_run(spark.table(name), "run-8")
    return stored.withColumn("event_ts", F.unix_millis("event_ts"))


# The runner.


def suite_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three jobs over the whole test tables, of query and file sources."""

    jobs = [
        dict(
            job_name="documents_labelled",
            source_type="parquet",
            source_location=f"{sf_dir}/documents.parquet",
            target_type="local",
            target_location=f"{sf_dir}/labels.parquet",
            checks="missing_extra_records,record_count",
            key_mapping="doc_id",
            notify_on_failure="Y",
        ),
        dict(
            job_name="orders_copied",
            source_type="query",
            source_query=on_files(pairs.ORDERS_SOURCE, sf_dir),
            target_type="query",
            target_query=on_files(pairs.ORDERS_TARGET, sf_dir),
            checks="s2t, source_to_target, record_count, missing_extra_records, threshold, schema_drift",
            column_mapping=pairs.ORDERS_MAPPING,
            key_mapping=pairs.ORDERS_KEYS,
            threshold=0.05,
            notify_on_failure="Y",
        ),
        dict(
            job_name="orders_rules",
            source_type="query",
            source_query=on_files(pairs.ORDERS_SOURCE, sf_dir),
            target_type="query",
            target_query=on_files(pairs.TOTALS_TARGET, sf_dir),
            checks="business_rule",
            column_mapping="o_custkey:cust_id",
            rule_sql=pairs.RULE_TOTALS,
        ),
    ]
    rows = [tuple(job.get(name) for name in JOBS_SCHEMA.names) for job in jobs]
    return spark.createDataFrame(rows, JOBS_SCHEMA)


def suite_summary(spark, sf_dir):
    results = ac.run_suite(spark, suite_jobs(spark, sf_dir), run_id="suite")
    return results.drop("message")


def _with_folder(query):
    """For a local session without a shared folder, such as the driver's, one is made."""

    @wraps(query)
    def run(spark, sf_dir):
        context = spark.sparkContext
        unset = not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir())
        if unset and context.master.startswith("local"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="showcase-"))
        return query(spark, sf_dir)

    return run


QUERIES = {
    "src_csv": src_csv,
    "src_dat": src_dat,
    "src_malformed_lines": src_malformed_lines,
    "src_text": src_text,
    "src_parquet": src_parquet,
    "src_orc": src_orc,
    "src_json": src_json,
    "src_table": src_table,
    "src_by_extension": src_by_extension,
    "src_query": src_query,
    "job_lookup": job_lookup_,
    "audit_for_run": audit_for_run_,
    "parse_mappings": parse_mappings_,
    "explode_checks": explode_checks_,
    "align_target_to_source": align_target_to_source,
    "align_source_to_target": align_source_to_target,
    "key_projection": key_projection,
    "align_types": align_types,
    "null_aware_diff": null_aware_diff_,
    "s2t_cells": s2t_cells,
    "s2t_cells_of_text": s2t_cells_of_text,
    "s2t_cells_of_duplicates": s2t_cells_of_duplicates,
    "s2t_cells_of_hot_keys": s2t_cells_of_hot_keys,
    "cell_mismatch_summary": cell_mismatch_summary,
    "mismatch_detail_text": mismatch_detail_text,
    "duplicate_keys": duplicate_keys,
    "row_diff": row_diff,
    "row_diff_of_text": row_diff_of_text,
    "row_diff_of_documents": row_diff_of_documents,
    "row_diff_by_digests": row_diff_by_digests,
    "row_diff_of_own_names": row_diff_of_own_names,
    "row_diff_of_vectors": row_diff_of_vectors,
    "s2t_cells_of_own_names": s2t_cells_of_own_names,
    "s2t_cells_of_vectors": s2t_cells_of_vectors,
    "s2t_rows": s2t_rows,
    "diff_summary": diff_summary,
    "missing_extra_keys": missing_extra_keys,
    "missing_labels": missing_labels,
    "record_count": record_count,
    "threshold": threshold,
    "summary_diff": summary_diff,
    "schema_drift": schema_drift,
    "schema_drift_of_nested": schema_drift_of_nested,
    "rule_filter": rule_filter,
    "rule_join_agg": rule_join_agg,
    "rule_window": rule_window,
    "rule_vs_target": rule_vs_target,
    "mismatch_preview": mismatch_preview,
    "stratified_preview": stratified_preview,
    "tag_results": tag_results,
    "run_rollup": run_rollup,
    "run_report": run_report,
    "sink_table": sink_table,
    "sink_parquet": sink_parquet,
    "sink_orc": sink_orc,
    "sink_rerun": sink_rerun,
    "sink_audit": sink_audit,
    "suite_summary": suite_summary,
}
QUERIES = {name: _with_folder(query) for name, query in QUERIES.items()}
