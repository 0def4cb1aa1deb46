"""A key with a third of all rows is split by adaptive execution."""

import pytest

import accordance as ac
from accordance.plans.workspace import stage


@pytest.fixture
def shuffled_joins(spark):
    changes = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "48",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    before = {name: spark.conf.get(name) for name in changes}
    for name, value in changes.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_hot_key_is_split(spark, shuffled_joins):
    rows = stage(
        spark.range(0, 120000, 1, 16).selectExpr(
            "if(id % 3 = 0, -1, id) AS k", "CAST(id % 977 AS STRING) AS v", "sha1(string(id)) AS x"
        ),
        "hot",
    )
    changed = rows.selectExpr("k", "if(v = '5', 'five', v) AS v", "x")
    mapping = [(c, c) for c in rows.columns]
    cells = ac.cell_diff(rows, changed, mapping, mapping[:1])
    totals = cells.groupBy("kind", "column_name").sum("joined_rows")
    found = {tuple(r)[:2]: r[2] for r in totals.collect()}
    assert found["value", "x"] == 40000 * 40000 - 40000
    plan = totals._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in plan
