"""Partition summaries: what changed is found, and nothing else is read."""

import pytest

import accordance as ac
from accordance.plans.workspace import new_folder, stage
from tests.test_rows_and_keys import plan_of


def stored(spark, condition="true", price="id * 1.5D"):
    path = new_folder(spark, "table")
    rows = spark.range(4000).selectExpr("id", f"{price} AS price", "if(id % 7 = 3, NULL, concat('p ', id % 7)) AS part", "array(id, NULL) AS tags")
    rows.where(condition).repartition(3).write.partitionBy("part").parquet(path)
    return path


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_summaries_find_the_partitions_that_differ(spark):
    one, other = stored(spark), stored(spark, "id % 7 <> 5", "if(id = 1234, 0, id * 1.5D)")
    s, t = spark.read.parquet(one), spark.read.parquet(other)
    before = stage(ac.partition_summary(s, ["part"]), "before")
    assert before.count() == 7 and before.agg({"n_rows": "sum"}).first()[0] == 4000
    same = ac.partition_summary(spark.read.parquet(stored(spark)), ["part"])
    assert ac.summary_diff(before, same, ["part"]).isEmpty()
    found = ac.summary_diff(before, ac.partition_summary(t, ["part"]), ["part"])
    assert as_set(found) == {("p 2", "value", 572, 572), ("p 5", "missing_in_target", 571, 0)}
    rows = [ac.rows_of_partitions(df, found, ["part"]) for df in (s, t)]
    assert as_set(ac.row_diff(*rows).select("id", "src_n").where("id = 1234")) == {(1234, 1), (1234, 0)}
    assert {r["part"] for r in rows[1].collect()} == {"p 2"}


def test_a_later_run_reads_changed_partitions_only(spark):
    path = stored(spark)
    before = stage(ac.partition_summary(spark.read.parquet(path), ["part"]), "before")
    changed = spark.createDataFrame([(7 * 9 + 3, 0.0), (7 * 9 + 4, 0.0)], "id long, price double")
    changed = changed.selectExpr("id", "price", "if(id % 7 = 3, NULL, concat('p ', id % 7)) AS part", "array(id, NULL) AS tags")
    changed.write.mode("append").partitionBy("part").parquet(path)  # the null partition and p 4 get a row
    now = spark.read.parquet(path)
    later = ac.partition_summary(now, ["part"], before)
    assert "dynamicpruning" in plan_of(later)
    assert as_set(later) == as_set(ac.partition_summary(now, ["part"]))
    assert {r["part"] for r in ac.summary_diff(before, later, ["part"]).collect()} == {None, "p 4"}
    # What is stored of partitions whose files are the same is believed, so they have not been read.
    wrong = before.withColumn("n_rows", before.n_rows + 1000000)
    counts = {r["part"]: r["n_rows"] for r in ac.partition_summary(now, ["part"], wrong).collect()}
    assert {p for p, n in counts.items() if n < 1000000} == {None, "p 4"} and len(counts) == 7
    nothing = ac.partition_summary(now.where("false"), ["part"], before)
    assert nothing.isEmpty()
    with pytest.raises(ac.ConfigError):
        ac.partition_summary(now.withColumnRenamed("part", "kind"), ["kind"])
