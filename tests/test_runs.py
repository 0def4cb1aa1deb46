"""What runs leave behind: stored results, audit events, and what later runs make of them."""

import pytest

import accordance as ac
from accordance.model import JOBS_SCHEMA, Job
from accordance.plans import runner
from accordance.plans.workspace import new_folder, shared_dir
from accordance.sources.jobs import audit_for_run


def written(spark, rows, schema="id int, v string"):
    path = new_folder(spark, "side.parquet")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    return path


def job_of(source, target, **values):
    given = dict(
        job_name="orders", source_type="parquet", source_location=source, target_type="parquet",
        target_location=target, checks="s2t,source_to_target", column_mapping="id:id,v:v", key_mapping="id",
        write_results="Y",
    )
    return Job(**{**given, **values})


def statuses(run):
    return {r["recon_type"]: r["status"] for r in run.check_results.collect()}


def stored(spark, kind, path):
    return {
        (r["job_name"], r["recon_type"], r["run_id"], r["kind"], r["row_key"])
        for r in ac.read_results(spark, kind, path).collect()
    }


def lines(spark, text, name="lines.csv"):
    path = new_folder(spark, name)
    spark.createDataFrame([(n, line) for n, line in enumerate(text)], "n int, value string").coalesce(1).sort("n").select(
        "value"
    ).write.text(path)
    return path


WRONG = ["2,y,LOST,MORE", "3", '4,"open', '"5,x', '13,"c,']
RIGHT = ["id,v", "1,x", '6,"a ""q"" b"', '7,5" pipe', '8,"a\\"b"', '9,"b" y', "10,", "", '11,"a,b"', '12,"a\\\\"']


def test_malformed_lines_are_found(spark):
    path = lines(spark, RIGHT[:2] + WRONG + RIGHT[2:])
    found = {r["line"]: r["reason"] for r in ac.malformed_lines(spark, "csv", path).collect()}
    assert found == {w: "open quote" if '"' in w else "fields" for w in WRONG}
    assert ac.malformed_lines(spark, "local", lines(spark, RIGHT)).isEmpty()
    piped = lines(spark, ["id|v", "1|x,y", "2|a|b", "# 3"], "lines.dat")
    assert [r["line"] for r in ac.malformed_lines(spark, "dat", piped, options={"comment": "#"}).collect()] == ["2|a|b"]
    plain = lines(spark, ["1;x", "2;x;y", "3"])
    options = {"header": "false", "SEP": ";"}
    found = ac.malformed_lines(spark, "csv", plain, schema="id int, v string", options=options)
    assert {r["line"] for r in found.collect()} == {"2;x;y", "3"}
    assert ac.malformed_lines(spark, "csv", lines(spark, ["id,v"])).isEmpty()
    with pytest.raises(ac.ConfigError):
        ac.malformed_lines(spark, "parquet", "/x")


@pytest.mark.parametrize("line, counterpart", [("2,y,LOST,MORE", "2,y"), ("2", "2,"), ('2,"y', "2,y")])
def test_malformed_lines_are_no_success(spark, line, counterpart):
    source, target = lines(spark, ["id,v", "1,x", line]), lines(spark, ["id,v", "1,x", counterpart])
    checks = "s2t,source_to_target,record_count,schema_drift"
    job = job_of(source, target, source_type="csv", target_type="local", checks=checks)
    results = new_folder(spark, "results")
    run = ac.run_job(spark, job, "r1", results_type="parquet", results_location=results)
    assert statuses(run) == dict.fromkeys(["malformed_lines", *checks.split(",")], "ERROR")
    assert [r["source_value"] for r in run.previews["malformed_lines"].collect()] == [line]
    kept = ac.read_results(spark, "parquet", results).where("recon_type = 'malformed_lines'").collect()
    assert [(r["kind"], r["source_value"], r["target_value"], r["src_n"]) for r in kept] == [("malformed", line, None, 1)]
    assert {r["run_status"] for r in run.report.collect()} == {"ERROR"}
    mended = job_of(target, target, source_type="csv", target_type="csv", checks=checks, write_results="N")
    assert set(statuses(ac.run_job(spark, mended)).values()) == {"SUCCESS"}


def test_records_of_several_lines_fail_where_they_are_wrong(spark):
    options = '{"multiLine": "true"}'
    good, bad = lines(spark, ["id,v", '1,"x', 'y"']), lines(spark, ["id,v", '1,"x', 'y"', "2"])
    for source, status in ((good, "SUCCESS"), (bad, "ERROR")):
        job = job_of(source, good, source_type="csv", target_type="csv", source_options=options, target_options=options)
        run = ac.run_job(spark, Job(**{**job.__dict__, "checks": "source_to_target", "write_results": "N"}))
        assert statuses(run)["source_to_target"] == status


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_results_are_replaced_check_by_check(spark, kind):
    path = new_folder(spark, "results")
    same, other = written(spark, [(1, "a"), (2, "b")]), written(spark, [(1, "a"), (2, "c")])
    where = dict(results_type=kind, results_location=path)
    ac.run_job(spark, job_of(same, other), "r1", **where)
    cell = ("orders", "s2t", "r1", "value", '{"id":2}')
    rows = {("orders", "source_to_target", "r1", k, '{"id":2,"v":"%s"}' % v) for k, v in (("source_only", "b"), ("target_only", "c"))}
    assert stored(spark, kind, path) == {cell} | rows
    # Every check errs: what the last complete run of each found stays, told by its run.
    broken = ac.run_job(spark, job_of(same, "/nowhere"), "r2", **where)
    assert set(statuses(broken).values()) == {"ERROR"} and stored(spark, kind, path) == {cell} | rows
    # One check errs and the other is clean: only the rows of the clean one go.
    rule = dict(checks="source_to_target,business_rule", rule_sql="SELECT id, CAST(raise_error('x') AS STRING) AS v FROM source_view")
    again = ac.run_job(spark, job_of(same, same, **rule), "r3", **where)
    assert statuses(again) == {"source_to_target": "SUCCESS", "business_rule": "ERROR"}
    assert stored(spark, kind, path) == {cell}
    # Another job, of a name that paths spell otherwise, and a run that is repeated.
    for _ in range(2):
        ac.run_job(spark, job_of(same, other, job_name="a/b=[c]", checks="s2t"), "r4", **where)
    assert stored(spark, kind, path) == {cell, ("a/b=[c]", "s2t", "r4", "value", '{"id":2}')}
    assert ac.read_results(spark, kind, path).count() == 2 == spark.read.format(kind).load(path).count()
    ac.run_job(spark, job_of(same, same), "r5", **where)
    assert {r[0] for r in stored(spark, kind, path)} == {"a/b=[c]"}


def test_a_run_that_breaks_off_leaves_the_earlier_one(spark, monkeypatch):
    from accordance.sinks import results

    path = new_folder(spark, "results")
    same, other, third = (written(spark, [(1, v)]) for v in "abc")
    where = dict(results_type="parquet", results_location=path)
    ac.run_job(spark, job_of(same, other, checks="s2t"), "r1", **where)
    monkeypatch.setattr(results, "_files", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        ac.run_job(spark, job_of(same, third, checks="s2t"), "r2", **where)
    monkeypatch.undo()
    assert {(r["run_id"], r["target_value"]) for r in ac.read_results(spark, "parquet", path).collect()} == {("r1", "b")}
    ac.run_job(spark, job_of(same, third, checks="s2t"), "r2", **where)
    assert {(r["run_id"], r["target_value"]) for r in ac.read_results(spark, "parquet", path).collect()} == {("r2", "c")}
    empty = new_folder(spark, "none")
    assert ac.read_results(spark, "orc", empty).count() == 0
    with pytest.raises(ac.ConfigError):
        ac.read_results(spark, "csv", empty)


def test_a_repeated_run_appends_nothing_twice(spark):
    name = "results_" + new_folder(spark, "t").split("/")[-2]
    same, other = written(spark, [(1, "a")]), written(spark, [(1, "b")])
    for run_id in ("r1", "r1", "r2"):
        ac.run_job(spark, job_of(same, other), run_id, results_location=name)
    found = spark.table(name).groupBy("run_id", "recon_type").count().collect()
    assert {(r["run_id"], r["recon_type"]): r["count"] for r in found} == {
        (r, c): n for r in ("r1", "r2") for c, n in (("s2t", 1), ("source_to_target", 2))
    }
    assert ac.read_results(spark, "hive", name).count() == 6


def test_a_wrong_place_for_results_is_told_first(spark):
    def folders():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark) + "/accordance")
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return {str(f.getPath()) for f in system.globStatus(path.suffix("/*/job"))}

    same, before = written(spark, [(1, "a")]), folders()
    audit = "audit_" + new_folder(spark, "t").split("/")[-2]
    job = job_of(same, same, write_audit="Y")
    with pytest.raises(ac.ConfigError):
        ac.run_job(spark, job, results_type="nope", audit_table=audit)
    rows = [tuple(job.__dict__[n] for n in JOBS_SCHEMA.names)]
    with pytest.raises(ac.ConfigError):
        ac.run_suite(spark, spark.createDataFrame(rows, JOBS_SCHEMA), results_type="nope")
    with pytest.raises(ac.ConfigError, match="more than once: 'orders'"):
        ac.run_suite(spark, spark.createDataFrame(rows * 2, JOBS_SCHEMA))
    assert not spark.catalog.tableExists(audit) and folders() == before


def test_an_aborted_run_is_resumed_after_its_ended_checks(spark, monkeypatch):
    name = "audit_" + new_folder(spark, "t").split("/")[-2]
    path = new_folder(spark, "results")
    same, other = written(spark, [(1, "a")]), written(spark, [(1, "b")])
    job = job_of(same, other, write_audit="Y", checks="s2t,record_count,source_to_target")
    where = dict(audit_table=name, results_type="parquet", results_location=path)
    ran = []

    def spied(check, fail=False):
        make = runner._RUNNERS[check]

        def planned(sides):
            plan = make(sides)

            def run():
                ran.append(check)
                if fail:
                    raise KeyboardInterrupt  # as if the driver died
                return plan()

            return run

        return planned

    with monkeypatch.context() as patch:
        patch.setattr(runner, "_RUNNERS", {c: spied(c, c == "record_count") for c in runner._RUNNERS})
        with pytest.raises(KeyboardInterrupt):
            ac.run_job(spark, job, "r1", **where)
    events = [(r["recon_type"], r["status"]) for r in audit_for_run(spark.table(name), "r1").orderBy("event_ts").collect()]
    assert events == [("s2t", "STARTED"), ("s2t", "FAILURE"), ("record_count", "STARTED")]
    assert ran == ["s2t", "record_count"] and len(stored(spark, "parquet", path)) == 1
    ran.clear()
    monkeypatch.setattr(runner, "_RUNNERS", {c: spied(c) for c in runner._RUNNERS})
    run = ac.run_job(spark, job, "r1", resume=True, **where)
    assert ran == ["record_count", "source_to_target"]
    assert statuses(run) == {"s2t": "FAILURE", "record_count": "SUCCESS", "source_to_target": "FAILURE"}
    assert len(stored(spark, "parquet", path)) == 3
    ran.clear()
    again = ac.run_job(spark, job, "r1", resume=True, **where)
    assert ran == [] and statuses(again) == statuses(run)
    assert set(statuses(ac.run_job(spark, job, "r2", resume=True, **where))) == set(ran)
    with pytest.raises(ac.ConfigError):
        ac.run_job(spark, job, resume=True, **where)


def test_a_check_that_erred_or_was_not_stored_is_run_again(spark):
    name = "audit_" + new_folder(spark, "t").split("/")[-2]
    same, other = written(spark, [(1, "a")]), written(spark, [(1, "b")])
    job = job_of(same, other, write_audit="Y", checks="s2t,record_count,business_rule", rule_sql="SELECT id, CAST(raise_error('x') AS STRING) AS v FROM source_view")
    taken = new_folder(spark, "file.txt")
    spark.range(1).selectExpr("CAST(id AS STRING)").coalesce(1).write.text(taken)
    inside = next(r.f for r in spark.read.text(taken).selectExpr("input_file_name() AS f").collect())
    run = ac.run_job(spark, job, "r1", audit_table=name, results_type="orc", results_location=inside)
    assert statuses(run) == {"s2t": "FAILURE", "record_count": "SUCCESS", "business_rule": "ERROR", "store_results": "ERROR"}
    found = ac.run_job(spark, job, "r1", audit_table=name, results_type="orc", results_location=new_folder(spark, "x"), resume=True)
    events = [r["recon_type"] for r in audit_for_run(spark.table(name), "r1").where("status = 'STARTED'").collect()]
    assert sorted(events) == sorted(["s2t", "record_count", "business_rule"] * 2)
    assert statuses(found)["s2t"] == "FAILURE" and "store_results" not in statuses(found)


def test_jobs_of_a_suite_run_side_by_side(spark):
    same, other = written(spark, [(n, "a") for n in range(50)]), written(spark, [(n, "a") for n in range(40)])
    jobs = [
        job_of(same, other if n % 2 else same, job_name=f"job{n}", checks="sql,business_rule,record_count",
               rule_sql=f"SELECT * FROM source_view WHERE id < {n}", write_results="N")
        for n in range(8)
    ]
    frame = spark.createDataFrame([tuple(j.__dict__[n] for n in JOBS_SCHEMA.names) for j in jobs], JOBS_SCHEMA)
    spark.range(3).createOrReplaceTempView("source_view")
    try:
        one, many = (
            [tuple(r) for r in ac.run_suite(spark, frame, "r", side_by_side=n).collect()] for n in (1, 4)
        )
        assert spark.table("source_view").count() == 3
    finally:
        spark.catalog.dropTempView("source_view")
    assert one == many and len(one) == 24
    assert [r[-1] for r in one if r[2] == "sql"][5] == "5 rows violate the rule"


def test_sides_are_looked_at_once_for_keys(spark, monkeypatch):
    """Keys that are missing or not unique come from one stored look at the key columns, for both checks."""
    staged = []
    real = runner.stage
    monkeypatch.setattr(runner, "stage", lambda df, name, folder=None: staged.append(name) or real(df, name, folder))
    same, other = written(spark, [(1, "a"), (1, "b"), (2, "c")]), written(spark, [(1, "a"), (3, "c")])
    run = ac.run_job(spark, job_of(same, other, checks="s2t,missing_extra_records,threshold,source_to_target", write_results="N"))
    assert staged == ["odd_keys", "cells", "digests", "rows"]
    counts = {r["recon_type"]: (r["source_only"], r["target_only"]) for r in run.check_results.collect()}
    assert counts["missing_extra_records"] == (1, 1) and counts["source_to_target"] == counts["threshold"] == (2, 1)
    staged.clear()
    run = ac.run_job(spark, job_of(same, same, checks="source_to_target,threshold", write_results="N"))
    assert staged == ["digests"] and set(statuses(run).values()) == {"SUCCESS"}
