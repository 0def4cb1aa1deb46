"""Checks, rules, reports and the parsing of jobs."""

import pytest
from pyspark.errors import AnalysisException, ParseException

import accordance as ac
from accordance.functions.job_text import explode_checks, parse_mappings
from accordance.model import Job, JOBS_SCHEMA
from accordance.sources.jobs import job_lookup, load_job, normalize_jobs


def test_parse_mapping():
    assert ac.parse_mapping(" a : b ,c:d") == [("a", "b"), ("c", "d")]
    assert ac.parse_mapping(None) == ac.parse_mapping("  ") == []
    for wrong in ("a", "a:", ":b", "a:b:c", "a:b,,c:d", "a:x,b:x", "a:x,a:y"):
        with pytest.raises(ac.ConfigError):
            ac.parse_mapping(wrong)


def test_names_are_compared_without_case():
    assert ac.parse_keys("ID", [("id", "cust")]) == [("ID", "cust")]
    with pytest.raises(ac.ConfigError):
        ac.parse_mapping("a:x,A:y")


def test_parse_keys():
    mapping = ac.parse_mapping("id:cust_id,name:n")
    assert ac.parse_keys("id", mapping) == [("id", "cust_id")]
    assert ac.parse_keys("id:other, name, more", mapping) == [
        ("id", "other"),
        ("name", "n"),
        ("more", "more"),
    ]


def test_mapping_text_of_a_table_agrees_with_the_parser(spark):
    texts = [None, "", "a:b", " a : b ,c:d", "a", "a:", ":b", "a:b:c"]
    jobs = spark.createDataFrame(
        [(str(i), text) for i, text in enumerate(texts)], "job_name string, column_mapping string"
    )
    found = {}
    for row in parse_mappings(jobs).orderBy("job_name", "pos").collect():
        found.setdefault(row["job_name"], []).append((row["src"], row["tgt"], row["valid"]))
    for i, text in enumerate(texts):
        lines = found.get(str(i), [])
        try:
            assert [(s, t, True) for s, t in ac.parse_mapping(text)] == lines
        except ac.ConfigError:
            assert not all(valid for _, _, valid in lines)


def test_explode_checks(spark):
    jobs = spark.createDataFrame([("j", " S2T, record_count")], "job_name string, checks string")
    assert [tuple(r) for r in explode_checks(jobs).collect()] == [
        ("j", 0, "s2t"),
        ("j", 1, "record_count"),
    ]


def test_record_count_and_threshold(spark):
    s, t = spark.range(10).toDF("n"), spark.range(1, 11).toDF("n")
    assert tuple(ac.record_count(s, t).first()) == (10, 10, "SUCCESS")
    assert ac.record_count(s, t.limit(3)).first()["status"] == "FAILURE"
    found = ac.threshold(s, t, limit=0.1).first()
    assert (found["source_only"], found["mismatch_ratio"], found["status"]) == (1, 0.1, "SUCCESS")
    more = ac.threshold(s, spark.range(1000).toDF("n")).first()
    assert (more["target_only"], more["status"]) == (990, "FAILURE")
    assert ac.threshold(s.where("false"), t).first()["status"] == "FAILURE"
    assert ac.threshold(s, t).first()["status"] == "FAILURE"
    assert ac.threshold(s, s).first()["status"] == "SUCCESS"


def test_schema_drift(spark):
    s = spark.sql("SELECT '1' AS a, 300 AS b, 1 AS c, true AS d UNION ALL SELECT 'z', 1, 1, true")
    t = spark.sql("SELECT 1 AS a, CAST(1 AS TINYINT) AS b, 1 AS c, 1.5D AS e")
    assert {tuple(r) for r in ac.schema_drift(s, t).collect()} == {
        ("d", "only_in_source", "boolean", None, None),
        ("e", "only_in_target", None, "double", None),
        ("a", "type_differs", "string", "int", 1),
        ("b", "type_differs", "int", "tinyint", 1),
    }
    assert ac.schema_drift(s, s).count() == 0
    arrays = [spark.sql(f"SELECT array({x}) AS a") for x in ("1", "CAST(NULL AS INT)")]
    assert ac.schema_drift(*arrays).count() == 0
    assert ac.schema_drift(s, s).columns == ac.schema_drift(s, t).columns


ORDERS = [
    ("101", "cust-001", "1200", "2023-01-15"),
    ("102", "cust-002", "800", "2023-01-16"),
    ("103", "cust-001", "1500", "2023-01-17"),
    ("104", "cust-003", "950", "2023-01-18"),
    ("105", "cust-002", "2100", "2023-01-19"),
]


def sample_orders(spark):
    return spark.createDataFrame(
        ORDERS, "order_id string, customer_id string, amount string, order_date string"
    )


def test_rule_of_sample_orders(spark):
    views = {"source_view": sample_orders(spark)}
    found = ac.rule_violations(views, "SELECT * FROM source_view WHERE amount > 1000; ")
    assert sorted(r["order_id"] for r in found.collect()) == ["101", "103", "105"]
    # The view is gone, and what was read through it stays readable.
    assert not spark.catalog.tableExists("source_view")
    assert found.count() == 3


def test_rule_keeps_an_earlier_view(spark):
    spark.range(7).createOrReplaceTempView("source_view")
    ac.rule_violations({"source_view": spark.range(2)}, "SELECT * FROM source_view")
    assert spark.table("source_view").count() == 7
    spark.catalog.dropTempView("source_view")


def test_rule_of_a_common_table_expression_with_comment(spark):
    views = {"source_view": spark.range(5)}
    sql = "WITH few AS (SELECT id FROM source_view WHERE id < 2) SELECT * FROM few -- the few"
    assert ac.rule_violations(views, sql).count() == 2


def test_only_queries_are_rules(spark):
    views = {"source_view": spark.range(5)}
    for wrong in ("DROP TABLE x", "INSERT INTO x VALUES (1)", "SELECT 1) ; DROP TABLE x --"):
        with pytest.raises(ParseException):
            ac.rule_violations(views, wrong)
    with pytest.raises(AnalysisException):
        ac.rule_violations(views, "SELECT nope FROM source_view")
    with pytest.raises(ac.ConfigError):
        ac.rule_violations(views, " ")


def test_rule_vs_target(spark):
    views = {"source_view": sample_orders(spark)}
    sql = "SELECT customer_id, count(*) AS n FROM source_view GROUP BY customer_id"
    target = spark.createDataFrame(
        [(2, "cust-001"), (2, "cust-002"), (2, "cust-003")], "n long, customer_id string"
    )
    diff = ac.rule_vs_target(views, sql, target)
    assert {tuple(r) for r in diff.collect()} == {(1, "cust-003", 1, 0), (2, "cust-003", 0, 1)}


def test_roll_up_takes_the_worst_status(spark):
    events = spark.createDataFrame(
        [
            ("j", "1", "STARTED"),
            ("j", "1", "SUCCESS"),
            ("j", "2", "SUCCESS"),
            ("j", "2", "WARNING"),
            ("j", "3", "FAILURE"),
            ("j", "3", "ERROR"),
            ("j", "4", "ERROR"),
            ("j", "5", "FAILURE"),
        ],
        "job_name string, run_id string, status string",
    )
    found = {r["run_id"]: r["status"] for r in ac.run_rollup(events).collect()}
    assert found == {"1": "SUCCESS", "2": "WARNING", "3": "ERROR", "4": "ERROR", "5": "FAILURE"}


def test_report_tells_whom_to_notify(spark):
    checks = spark.createDataFrame(
        [("good", "1", "s2t", "SUCCESS"), ("bad", "1", "s2t", "FAILURE")],
        "job_name string, run_id string, recon_type string, status string",
    )
    for on_success, on_failure in ("YN", "NY", "YY", "NN"):
        flags = spark.createDataFrame(
            [(n, on_success, on_failure) for n in ("good", "bad")],
            "job_name string, notify_on_success string, notify_on_failure string",
        )
        found = {r["job_name"]: r["should_notify"] for r in ac.run_report(checks, flags).collect()}
        assert found == {"good": on_success == "Y", "bad": on_failure == "Y"}


def test_report_keeps_checks_without_ids_and_of_jobs_listed_twice(spark):
    checks = spark.createDataFrame(
        [(None, None, "s2t", "FAILURE"), ("twice", "1", "s2t", "FAILURE")],
        "job_name string, run_id string, recon_type string, status string",
    )
    flags = spark.createDataFrame(
        [("twice", "N", "N"), ("twice", "N", "Y")],
        "job_name string, notify_on_success string, notify_on_failure string",
    )
    found = {r["job_name"]: r["should_notify"] for r in ac.run_report(checks, flags).collect()}
    assert found == {None: False, "twice": True}


def test_tags(spark):
    df = spark.range(3).toDF("n")
    row = ac.tag_results(df, "j", "s2t", "FAILURE", 1_700_000_000_999, 1_700_000_002_998, 10).first()
    assert (row["record_count"], row["mismatch_count"], row["source_count"]) == (3, 1, 10)
    assert row["total_time_taken_for_execution"] == 1
    assert row["start_time"].microsecond == 0


def test_preview_is_ordered(spark):
    df = spark.range(100).selectExpr("99 - id AS n", "id AS m")
    assert [r["n"] for r in ac.preview(df, 3, ["n"]).collect()] == [0, 1, 2]


def test_job_lookup_takes_the_name_as_a_value(spark):
    jobs = spark.createDataFrame(
        [("a",), ("b",), ("b",)], "job_name string"
    ).selectExpr("job_name", "'csv' AS source_type", "'s2t' AS checks")
    assert job_lookup(jobs, "' OR '1' = '1").count() == 0
    assert load_job(jobs, "a").source_type == "csv"
    for wrong in ("nope", "b"):
        with pytest.raises(ac.ConfigError):
            load_job(jobs, wrong)


def test_flat_layout_of_jobs(spark):
    jobs = spark.createDataFrame(
        [("j", "csv", "/s", "csv", "/t", "id:cust_id", "id", "S2T", None, "x@y", None, "Y", "N")],
        "job_name string, source_type string, source_location string, target_type string,"
        " target_location string, column_mapping string, key_mapping string, recon_type string,"
        " sql_query string, email_to string, email_cc string, notify_on_success string,"
        " notify_on_failure string",
    )
    job = load_job(jobs, "j")
    assert (job.checks, job.keys, job.target_location) == ("s2t", [("id", "cust_id")], "/t")
    assert normalize_jobs(jobs).schema.names == JOBS_SCHEMA.names


def test_camel_case_layout_of_jobs(spark):
    jobs = spark.sql(
        """SELECT 'j' AS jobName, 'Local' AS sourceType, '/s.csv' AS sourcePath,
                  CAST(NULL AS STRING) AS sourceTable, CAST(NULL AS STRING) AS sourceQuery,
                  'Hive' AS targetType, CAST(NULL AS STRING) AS targetPath,
                  'db.t' AS targetTable, 'source_to_target, record_count' AS reconTypes,
                  'id:emp_id' AS columnMapping, 'id:emp_id' AS primaryKeyMapping,
                  0.05D AS threshold, CAST(NULL AS STRING) AS businessRuleSQL,
                  'Y' AS notifyOnSuccess, 'N' AS notifyOnFailure, 'Y' AS writeToHiveFlag,
                  'Y' AS auditFlag"""
    )
    job = load_job(jobs, "j").validate()
    assert job.check_names == ["source_to_target", "record_count"]
    assert (job.source_location, job.target_location) == ("/s.csv", "db.t")
    assert (job.threshold, job.write_audit) == (0.05, "Y")


@pytest.mark.parametrize(
    "changes",
    [
        {"checks": ""},
        {"checks": "nope"},
        {"checks": "s2t,s2t"},
        {"target_type": None},
        {"key_mapping": None},
        {"column_mapping": "a"},
        {"checks": "sql"},
        {"checks": "business_rule"},
    ],
)
def test_wrong_jobs_raise(changes):
    good = dict(
        job_name="j",
        source_type="csv",
        source_location="/s",
        target_type="csv",
        target_location="/t",
        checks="s2t",
        column_mapping="a:b",
        key_mapping="a",
    )
    Job(**good).validate()
    with pytest.raises(ac.ConfigError):
        Job(**{**good, **changes}).validate()
