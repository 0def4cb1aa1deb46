"""Sources, sinks and whole jobs."""

from unittest.mock import MagicMock

import pytest

import accordance as ac
from accordance.model import JOBS_SCHEMA, Job
from accordance.plans.workspace import new_folder, shared_dir
from accordance.sinks.results import write_results
from accordance.sources.jobs import audit_for_run
from accordance.sources.readers import format_of_path


def test_round_trip_of_every_format(spark):
    df = spark.range(20).selectExpr("CAST(id AS STRING) AS id", "concat('n|,', id) AS name")
    for kind, options in {
        "csv": {"header": "true"},
        "dat": {"header": "true", "delimiter": "|"},
        "parquet": {},
        "orc": {},
        "json": {},
    }.items():
        path = new_folder(spark, f"data.{kind}")
        df.write.format("csv" if kind == "dat" else kind).options(**options).save(path)
        for source_type in (kind, kind.upper(), "local"):
            if (source_type, kind) == ("local", "dat"):
                continue
            assert ac.row_diff(df, ac.read(spark, source_type, path)).count() == 0


def test_text_and_dat_by_extension(spark):
    path = new_folder(spark, "lines.txt")
    spark.range(3).selectExpr("CAST(id AS STRING) AS v").write.text(path)
    assert ac.read(spark, "local", path).columns == ["value"]
    path = new_folder(spark, "rows.dat")
    spark.range(3).selectExpr("id", "id AS v").write.csv(path, header=True, sep="|")
    assert ac.read(spark, "local", path).columns == ["id", "v"]


def test_schema_and_options_of_a_source(spark):
    path = new_folder(spark, "rows.csv")
    spark.range(3).selectExpr("id", "id AS v").write.csv(path, header=True, sep=";")
    df = ac.read(spark, "csv", path, schema="id long, v long", options={"delimiter": ";"})
    assert df.agg({"v": "sum"}).first()[0] == 3


def test_format_of_path():
    assert format_of_path("s3://b/x.y/data.CSV.gz") == "csv"
    assert format_of_path("/a/b.txt") == "text"
    for wrong in ("/a/b", "/a/b.xlsx", "/a.csv/b"):
        with pytest.raises(ac.ConfigError):
            format_of_path(wrong)


def test_wrong_sources_raise(spark):
    for arguments in (("nope", "/x"), (None, "/x"), ("csv", None), ("query",), ("jdbc", "t")):
        with pytest.raises(ac.ConfigError):
            ac.read(spark, *arguments)


def test_jdbc_is_read_in_partitions():
    spark = MagicMock()
    options = {
        "url": "jdbc:x",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "9",
        "numPartitions": "4",
    }
    ac.read(spark, "jdbc", "orders", options=options)
    spark.read.format.assert_called_with("jdbc")
    spark.read.format().options.assert_called_with(**options, dbtable="orders")
    for wrong in ({}, {"partitionColumn": "id"}):
        with pytest.raises(ac.ConfigError):
            ac.read(spark, "jdbc", "orders", options={"url": "jdbc:x", **wrong})


def test_shared_folder_is_the_session_s(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark).startswith((named or spark.sparkContext.getCheckpointDir()).rstrip("/"))


def test_unknown_target_type_raises(spark):
    with pytest.raises(ac.ConfigError):
        write_results(spark.range(1), "csv", "/nowhere")


EMPLOYEES = [
    ("1", "John Doe", "50000"),
    ("2", "Jane Smith", "60000"),
    ("3", "Peter Jones", "70000"),
    ("4", "Mary Williams", "80000"),
    ("5", "David Brown", "90000"),
]


@pytest.fixture
def employees(spark):
    path = new_folder(spark, "employees.csv")
    source = spark.createDataFrame(EMPLOYEES, "id string, name string, salary string")
    source.write.csv(path, header=True)
    target = source.selectExpr(
        "CAST(id AS INT) AS emp_id", "name AS emp_name", "CAST(salary AS INT) AS emp_salary"
    )
    name = "employees_" + path.split("/")[-2]
    target.write.option("path", new_folder(spark, "t")).saveAsTable(name)
    return Job(
        job_name="employees",
        source_type="Local",
        source_location=path,
        target_type="Hive",
        target_location=name,
        checks="source_to_target,record_count,s2t,missing_extra_records,threshold",
        column_mapping="id:emp_id,name:emp_name,salary:emp_salary",
        key_mapping="id:emp_id",
        notify_on_success="Y",
    )


def change(job, **values):
    return Job(**{**job.__dict__, **values})


def statuses(run):
    return {r["recon_type"]: r["status"] for r in run.check_results.collect()}


def test_agreeing_job(spark, employees):
    run = ac.run_job(spark, employees)
    assert set(statuses(run).values()) == {"SUCCESS"}
    report = run.report.collect()
    assert len(report) == 5 and all(r["should_notify"] for r in report)
    assert run.events.count() == 10 and not run.previews
    assert len(run.run_id) == 32 and ac.run_job(spark, employees).run_id != run.run_id


def test_differing_job_stores_results_and_audit(spark, employees):
    changed = new_folder(spark, "changed.parquet")
    spark.table(employees.target_location).selectExpr(
        "emp_id", "emp_name", "emp_salary + if(emp_id = 2, 1, 0) AS emp_salary"
    ).where("emp_id <> 3").write.parquet(changed)
    audit = "audit_" + changed.split("/")[-2]
    results = new_folder(spark, "results")
    job = change(
        employees,
        target_type="parquet",
        target_location=changed,
        threshold=0.4,
        write_results="Y",
        write_audit="Y",
    )
    run = ac.run_job(
        spark, job, "r1", results_type="hive", results_location=audit + "_r", audit_table=audit
    )
    assert statuses(run) == {
        "source_to_target": "FAILURE",
        "record_count": "FAILURE",
        "s2t": "FAILURE",
        "missing_extra_records": "FAILURE",
        "threshold": "SUCCESS",
    }
    stored = spark.table(audit + "_r")
    kinds = {(r["recon_type"], r["kind"], r["row_key"]) for r in stored.collect()}
    assert ("s2t", "value", '{"id":2}') in kinds
    assert ("s2t", "missing_in_target", '{"id":3}') in kinds
    assert ("missing_extra_records", "missing_in_target", '{"emp_id":3}') in kinds
    assert stored.where("recon_type = 'source_to_target'").count() == 3
    ac.run_job(
        spark, job, "r2", results_type="hive", results_location=audit + "_r", audit_table=audit
    )
    by_run = spark.table(audit + "_r").groupBy("run_id").count().collect()
    assert {r["run_id"]: r["count"] for r in by_run} == {"r1": len(kinds), "r2": len(kinds)}
    assert audit_for_run(spark.table(audit), "r1").count() == 10
    rolled = {r["run_id"]: r["status"] for r in ac.run_rollup(spark.table(audit)).collect()}
    assert rolled == {"r1": "FAILURE", "r2": "FAILURE"}
    assert run.previews["s2t"].count() == 2
    ac.run_job(spark, job, "r3", results_type="orc", results_location=results, audit_table=audit)
    by_check = {"source_to_target": 3, "s2t": 2, "missing_extra_records": 1}

    def stored_checks():
        rows = spark.read.orc(results).groupBy("job_name", "recon_type").count().collect()
        return {(r["job_name"], r["recon_type"]): r["count"] for r in rows}

    assert stored_checks() == {("employees", c): n for c, n in by_check.items()}
    other = change(job, job_name="a/b=c")
    ac.run_job(spark, other, "r4", results_type="orc", results_location=results, audit_table=audit)
    clean = change(employees, write_results="Y")
    ac.run_job(spark, clean, "r5", results_type="orc", results_location=results, audit_table=audit)
    assert stored_checks() == {("a/b=c", c): n for c, n in by_check.items()}


def test_one_check_s_error_does_not_stop_the_next(spark, employees):
    job = change(employees, checks="business_rule,record_count", rule_sql="SELECT nope FROM source_view")
    assert statuses(ac.run_job(spark, job)) == {"business_rule": "ERROR", "record_count": "SUCCESS"}
    job = change(employees, source_location="/nowhere/at/all.csv")
    run = ac.run_job(spark, job)
    assert set(statuses(run).values()) == {"ERROR"}
    assert not any(r["should_notify"] for r in run.report.collect())


def test_rules_of_a_job(spark, employees):
    job = change(employees, checks="sql", rule_sql="SELECT * FROM source_view WHERE salary > 65000")
    run = ac.run_job(spark, job)
    assert statuses(run) == {"sql": "FAILURE"} and run.previews["sql"].count() == 3
    job = change(job, target_type=None, target_location=None)
    assert statuses(ac.run_job(spark, job)) == {"sql": "FAILURE"}
    job = change(employees, checks="business_rule", rule_sql="SELECT * FROM source_view")
    assert statuses(ac.run_job(spark, job)) == {"business_rule": "SUCCESS"}


def test_drift_is_a_warning(spark, employees):
    job = change(employees, checks="schema_drift,source_to_target", column_mapping="id:emp_id,name:emp_name")
    run = ac.run_job(spark, job)
    assert statuses(run) == {"schema_drift": "WARNING", "source_to_target": "WARNING"}
    assert run.events.where("status = 'WARNING'").count() == 3
    assert {r["run_status"] for r in run.report.collect()} == {"WARNING"}


def test_nothing_staged_is_left(spark, employees):
    def staged():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark) + "/accordance")
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return {str(f.getPath()) for f in system.globStatus(path.suffix("/*/job"))}

    before = staged()
    changed = change(employees, column_mapping="id:emp_id,name:emp_name", checks="s2t,source_to_target,schema_drift")
    run = ac.run_job(spark, changed)
    assert staged() == before
    assert run.previews["schema_drift"].count() > 0


def test_columns_left_out_are_no_success(spark):
    folders = [new_folder(spark, f"{side}.parquet") for side in ("source", "target")]
    spark.createDataFrame([(1, 5, "a")], "id int, amount int, note string").write.parquet(folders[0])
    spark.createDataFrame([(1, 6)], "id int, total int").write.parquet(folders[1])
    job = Job(
        job_name="left_out",
        source_type="parquet",
        source_location=folders[0],
        target_type="parquet",
        target_location=folders[1],
        checks="source_to_target,threshold,business_rule",
        rule_sql="SELECT * FROM source_view",
    )
    run = ac.run_job(spark, job)
    assert statuses(run) == {
        "source_to_target": "WARNING",
        "threshold": "FAILURE",
        "business_rule": "FAILURE",
    }
    assert all("columns differ" in r["message"] for r in run.check_results.collect())


def test_a_failed_write_keeps_the_finding(spark, employees):
    job = change(employees, checks="record_count,s2t", column_mapping="id:emp_id,name:emp_salary", write_results="Y")
    taken = new_folder(spark, "file.txt")
    spark.range(1).selectExpr("CAST(id AS STRING)").coalesce(1).write.text(taken)
    inside = next(r.f for r in spark.read.text(taken).selectExpr("input_file_name() AS f").collect())
    run = ac.run_job(spark, job, results_type="parquet", results_location=inside)
    assert statuses(run) == {"record_count": "SUCCESS", "s2t": "FAILURE", "store_results": "ERROR"}


def test_options_of_each_side(spark):
    folders = [new_folder(spark, f"{side}.csv") for side in ("source", "target")]
    for folder, sep in zip(folders, ";|"):
        spark.range(3).selectExpr("id", "id AS v").write.csv(folder, header=True, sep=sep)
    job = Job(
        job_name="options",
        source_type="csv",
        source_location=folders[0],
        target_type="csv",
        target_location=folders[1],
        checks="source_to_target",
        source_options='{"sep": ";"}',
        target_options='{"sep": "|"}',
    )
    assert statuses(ac.run_job(spark, job)) == {"source_to_target": "SUCCESS"}
    with pytest.raises(ac.ConfigError):
        change(job, source_options="sep=;").validate()


def test_jobs_run_side_by_side(spark):
    from concurrent.futures import ThreadPoolExecutor

    def rule(n):
        views = {"source_view": spark.range(n)}
        return [ac.rule_violations(views, "SELECT * FROM source_view").count() for _ in range(5)]

    with ThreadPoolExecutor(2) as pool:
        assert [set(x) for x in pool.map(rule, (3, 4))] == [{3}, {4}]


def test_wrong_columns_raise_before_anything_runs(spark, employees):
    with pytest.raises(ac.ConfigError):
        ac.run_job(spark, change(employees, column_mapping="id:emp_id,name:nope"))


def test_suite_goes_on_after_a_wrong_job(spark, employees):
    jobs = [
        change(employees, job_name="good", checks="record_count"),
        change(employees, job_name="bad", checks="s2t", column_mapping="id:emp_id,name:nope"),
    ]
    rows = [tuple(j.__dict__[n] for n in JOBS_SCHEMA.names) for j in jobs]
    found = ac.run_suite(spark, spark.createDataFrame(rows, JOBS_SCHEMA)).collect()
    assert {(r["job_name"], r["status"]) for r in found} == {("bad", "ERROR"), ("good", "SUCCESS")}


def test_command_line(spark, employees):
    from accordance.__main__ import main, reader_options

    path = new_folder(spark, "jobs.parquet")
    good = change(employees, job_name="good", checks="record_count")
    rows = [tuple(good.__dict__[n] for n in JOBS_SCHEMA.names)]
    spark.createDataFrame(rows, JOBS_SCHEMA).write.parquet(path)
    table = "report_" + path.split("/")[-2]
    assert main(["parquet", path, "good", "--report-table", table]) == "SUCCESS"
    assert spark.table(table).count() == 1
    assert main(["local", path]) == "SUCCESS"
    assert reader_options(["jdbc.url=jdbc:x?a=b", "csv.delimiter=;"]) == {
        "jdbc": {"url": "jdbc:x?a=b"},
        "csv": {"delimiter": ";"},
    }


def test_repeated_key_of_one_side_gives_one_line(spark):
    folders = [new_folder(spark, f"{side}.parquet") for side in ("source", "target")]
    spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "c")], "k int, v string").write.parquet(
        folders[0]
    )
    spark.createDataFrame([(2, "d")], "k int, v string").write.parquet(folders[1])
    job = Job(
        job_name="one_side",
        source_type="parquet",
        source_location=folders[0],
        target_type="parquet",
        target_location=folders[1],
        checks="s2t",
        column_mapping="k:k,v:v",
        key_mapping="k",
    )
    rows = ac.run_job(spark, job).previews["s2t"].collect()
    assert [(r["k"], r["kind"], r["src_n"], r["tgt_n"]) for r in rows] == [
        (1, "missing_in_target", 3, 0),
        (2, "value", 1, 1),
    ]
