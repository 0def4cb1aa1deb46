"""Previews and drift of nested columns."""

import accordance as ac


def test_a_frequent_kind_hides_no_rare_one(spark):
    rows = spark.range(5000).selectExpr("id AS k", "if(id = 4321, 'rare', 'often') AS kind", "'v' AS column_name").repartition(7)
    found = ac.stratified_preview(rows, 2, by=["k"])
    assert [tuple(r) for r in found.collect()] == [(0, "often", "v"), (1, "often", "v"), (4321, "rare", "v")]
    assert found.columns == rows.columns
    plan = found._jdf.queryExecution().executedPlan().toString()
    limits = [n for n, line in enumerate(plan.splitlines()) if "WindowGroupLimit" in line]
    shuffle = next(n for n, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in line)
    assert limits and max(limits) > shuffle  # also below the shuffle, so before it
    assert ac.stratified_preview(rows.where("false")).isEmpty()


def test_drift_goes_through_structs_arrays_and_maps(spark):
    s = spark.sql("""
        SELECT 1 AS same, named_struct('a', '1', 'b', array(named_struct('c', 'x', 'd', 1))) AS s, map('k', array('1', 'y')) AS m
        UNION ALL SELECT 2, NULL, NULL
        UNION ALL SELECT 3, named_struct('a', NULL, 'b', array(NULL, named_struct('c', '5', 'd', 2))), map('3', NULL)""")
    t = spark.sql("SELECT 1 AS same, named_struct('a', 1, 'b', array(named_struct('c', 1, 'e', 1))) AS s, map(1, array(1)) AS m")
    found = {r["column_name"]: (r["drift"], r["source_type"], r["target_type"], r["unreadable_rows"]) for r in ac.schema_drift(s, t).collect()}
    assert found == {
        "s.a": ("type_differs", "string", "int", 0),
        "s.b[].c": ("type_differs", "string", "int", 1),
        "s.b[].d": ("only_in_source", "int", None, None),
        "s.b[].e": ("only_in_target", None, "int", None),
        "m{key}": ("type_differs", "string", "int", 1),
        "m{value}[]": ("type_differs", "string", "int", 1),
    }
    assert ac.schema_drift(s, s).isEmpty()
    odd = ac.schema_drift(s.select("s"), t.selectExpr("array(1) AS s")).collect()
    assert [(r["drift"], r["unreadable_rows"]) for r in odd] == [("type_differs", None)]
    assert {r["unreadable_rows"] for r in ac.schema_drift(s.where("false"), t).collect()} == {0, None}
