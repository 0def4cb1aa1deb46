"""Row and key differences: fixtures, properties and the shape of their plans."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import accordance as ac
from accordance.plans import workspace

SCHEMA = "a int, b string"
ROWS = st.lists(
    st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, "x", "y"])), max_size=8
)
SETTINGS = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@SETTINGS
@given(left=ROWS, right=ROWS)
def test_row_diff_properties(spark, left, right):
    s, t = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    found = ac.diff_summary(s, t).first()
    turned = ac.diff_summary(t, s).first()
    assert (found["source_only"], found["target_only"]) == (
        turned["target_only"],
        turned["source_only"],
    )
    assert found["source_only"] - found["target_only"] == len(left) - len(right)
    assert found["source_only"] == s.exceptAll(t).count()
    assert found["target_only"] == t.exceptAll(s).count()
    assert ac.row_diff(s, s).count() == 0


@SETTINGS
@given(left=ROWS, right=ROWS)
def test_key_diff_equals_two_excepts(spark, left, right):
    s, t = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    keys = [("a", "a"), ("b", "b")]
    rows = ac.key_diff(s, t, keys).collect()
    for kind, one, other in (("missing_in_target", s, t), ("missing_in_source", t, s)):
        expected = {tuple(r) for r in one.subtract(other).collect()}
        assert {(r["a"], r["b"]) for r in rows if r["kind"] == kind} == expected


def test_rows_are_matched_by_name(spark):
    s = spark.sql("SELECT 1 AS a, 'x' AS b")
    t = spark.sql("SELECT 'x' AS b, 1 AS a")
    assert ac.row_diff(s, t).count() == 0


def test_swapped_names(spark):
    s = spark.sql("SELECT 1 AS a, 2 AS b")
    t = spark.sql("SELECT 2 AS a, 1 AS b")
    assert ac.row_diff(s, t, [("a", "b"), ("b", "a")]).count() == 0
    renamed = ac.align_target_to_source(t, [("a", "b"), ("b", "a")]).first().asDict()
    assert renamed == {"b": 2, "a": 1}


def test_special_floats(spark):
    s = spark.sql("SELECT double('NaN') AS d, -0.0D AS z")
    t = spark.sql("SELECT double('NaN') AS d, 0.0D AS z")
    assert ac.row_diff(s, t).count() == 0


def test_unreadable_text_never_equals_null(spark):
    s = spark.sql("SELECT 'z' AS n")
    t = spark.sql("SELECT CAST(NULL AS INT) AS n")
    assert ac.row_diff(s, t).count() == 2
    assert [r["uncastable"] for r in ac.row_diff(s, t).collect() if r["src_n"]] == [("z",)]
    assert ac.key_diff(s, t, [("n", "n")]).count() == 2


def test_wider_types(spark):
    s = spark.sql("SELECT 1 AS n, DATE'2020-01-01' AS d, CAST(1.5 AS DECIMAL(5,1)) AS x")
    t = spark.sql("SELECT 1L AS n, TIMESTAMP'2020-01-01 00:00:00' AS d, 1.50 AS x")
    assert ac.row_diff(s, t).count() == 0
    assert ac.cell_diff(s, t, [(c, c) for c in "ndx"], [("n", "n")]).count() == 0


def test_empty_sides(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert tuple(ac.diff_summary(empty, empty).first()) == (0, 0, 0, 0)
    assert ac.threshold(empty, empty).first()["status"] == "SUCCESS"
    assert ac.record_count(empty, empty).first()["status"] == "SUCCESS"


@pytest.mark.parametrize(
    "mapping", [[("nope", "a")], [("a", "b")], [("a", "c"), ("b", "c")]]
)
def test_wrong_mappings_raise(spark, mapping):
    df = spark.createDataFrame([(1, "x")], SCHEMA)
    with pytest.raises(ac.ConfigError):
        ac.row_diff(df, df, mapping)


def test_any_column_name_is_compared(spark):
    """Names that results use themselves are shown with an underscore after them; column_name tells the real one."""
    names = ["kind", "kind_", "src_n", "SRC_TOTAL", "uncastable", "__row", "__digest", "repeated", "s", "column_name", "__in_source"]
    own = ["kind__", "kind_", "src_n_", "SRC_TOTAL_", "uncastable_", "__row_", "__digest_", "repeated_", "s", "column_name_", "__in_source_"]
    s = spark.createDataFrame([[str(n)] * len(names) for n in (1, 2, 3)], ", ".join(f"`{c}` string" for c in names))
    t = s.selectExpr(*[f"`{c}`" for c in names[:-1]], "if(kind = '2', NULL, __in_source) AS __in_source").where("kind <> '3'")
    for digests in (None, ac.digest_diff(s, t)):
        diff = ac.row_diff(s, t, digests=digests)
        assert diff.columns == [*own, "src_n", "tgt_n"]
        assert {(r["kind__"], r["src_n"], r["tgt_n"]) for r in diff.collect()} == {("2", 1, 0), ("2", 0, 1), ("3", 1, 0)}
    pairs = [(c, c) for c in names]
    for keys in (pairs[:1], pairs[2:4]):
        cells = ac.cell_diff(s, t, pairs, keys).collect()
        assert {(r["kind"], r["column_name"], r["source_value"]) for r in cells} == {
            ("missing_in_target", None, None), ("null_vs_value", "__in_source", "2")
        }
    assert [tuple(r) for r in ac.key_diff(s, t, pairs[:1]).collect()] == [("3", "missing_in_target")]
    assert ac.key_diff(s, t, pairs[:1]).columns == ["kind_", "kind"]
    assert [r["mismatch_details"] for r in ac.mismatch_details(s, t, pairs, pairs[:1]).where("src_n = tgt_n").collect()] == ["__in_source:2!=NULL"]
    typed = s.selectExpr("CAST(kind AS INT) AS kind", "if(kind = '1', 'x', kind) AS src_n")
    left = s.select("kind", "src_n")
    assert {(r["column_name"], r["kind"]) for r in ac.cell_diff(left, typed, pairs[:1] + pairs[2:3], pairs[:1]).collect()} == {("src_n", "value")}


@SETTINGS
@given(left=ROWS, right=ROWS)
def test_digests_tell_the_same_as_rows(spark, left, right):
    s, t = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    digests = ac.digest_diff(s, t)
    rows = sorted(map(str, ac.row_diff(s, t).collect()))
    assert sorted(map(str, ac.row_diff(s, t, digests=digests).collect())) == rows


def test_equal_rows_have_equal_digests_and_others_have_not(spark):
    values = [
        "named_struct('a', 1, 'b', -0.0D) AS x, array(1, NULL) AS y, 'a;1:b' AS z, map('k', 1.50) AS m, X'00FF' AS b",
        "named_struct('a', 1, 'b', 0.0D) AS x, array(1, NULL) AS y, 'a;1:b' AS z, map('k', 1.50) AS m, X'00FF' AS b",
        "named_struct('a', 1, 'b', double('NaN')) AS x, array(NULL, 1) AS y, '-' AS z, map('k', NULL) AS m, NULL AS b",
        "named_struct('a', NULL, 'b', 0.0D) AS x, array() AS y, NULL AS z, NULL AS m, X'00' AS b",
        "NULL AS x, NULL AS y, '' AS z, map() AS m, X'' AS b",
    ]
    zero, minus, nan = (spark.sql(f"SELECT {v} AS d, CAST({v} AS FLOAT) AS f") for v in ("0.0D", "-0.0D", "double('NaN')"))
    assert ac.digest_diff(zero, minus).isEmpty() and ac.digest_diff(nan, nan).isEmpty() and ac.digest_diff(nan, zero).count() == 2
    many = spark.range(1).selectExpr(*[f"if(id = 0, NULL, id) AS c{n}" for n in range(130)])
    assert ac.digest_diff(many, many.withColumn("c125", many.c0 + 1).fillna(0, ["c7"])).count() == 2
    frames = [spark.sql(f"SELECT {v}") for v in values]
    schema = "x struct<a: int, b: double>, y array<int>, z string, m map<string, decimal(3,2)>, b binary"
    frames = [f.to(spark.createDataFrame([], schema).schema) for f in frames]
    for i, s in enumerate(frames):
        for j, t in enumerate(frames):
            same = i == j or {i, j} == {0, 1}
            assert ac.digest_diff(s, t).isEmpty() == same == ac.row_diff(s, t).isEmpty()
    for row, other in ((("1", "2;"), ("1;", "2")), ((None, "-"), ("-", None)), (("", None), (None, ""))):
        s, t = (spark.createDataFrame([v], SCHEMA.replace("int", "string")) for v in (row, other))
        assert ac.digest_diff(s, t).count() == 2


def test_texts_equal_by_collation(spark):
    s = spark.sql("SELECT 'A' COLLATE UTF8_LCASE AS a")
    t = spark.sql("SELECT 'a' COLLATE UTF8_LCASE AS a")
    assert ac.row_diff(s, t).count() == ac.digest_diff(s, t).count() == 0
    assert tuple(ac.diff_summary(s, t).first()) == (1, 1, 0, 0)


def test_nearly_equal_wide_tables_shuffle_digests_only(spark, monkeypatch):
    """Of the rows only those that differ are moved: the others are joined with a broadcast of their digests."""
    wide = spark.range(3000).selectExpr("id", *[f"repeat(CAST(id AS STRING), 40) AS c{n}" for n in range(12)])
    changed = wide.withColumn("c3", ac_when("id % 1000 = 7", "c3"))
    diff, digests = ac.stage_row_diff(wide, changed)
    assert digests.count() == 6 and diff.count() == 6
    first = plan_of(ac.digest_diff(wide, changed))
    exchanges = [line for line in first.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("__digest" in line and "c3" not in line for line in exchanges)
    second = plan_of(diff)
    assert "BroadcastHashJoin" in second and "SortMergeJoin" not in second
    monkeypatch.setattr(workspace, "FEW_DIGESTS", 5)  # beyond, the rows themselves are grouped
    assert "Join" not in plan_of(ac.stage_row_diff(wide, changed)[0])
    assert ac.row_diff(wide, changed).count() == 6


def ac_when(condition, column):
    from pyspark.sql import functions as F

    return F.expr(f"if({condition}, 'other', {column})")


def test_null_keys_match_and_duplicates_are_seen(spark):
    s = spark.createDataFrame([(None, "x"), (None, "y"), (1, "x")], SCHEMA)
    t = spark.createDataFrame([(None, "z"), (1, "x")], SCHEMA)
    assert ac.key_diff(s, t, [("a", "a")]).count() == 0
    assert [tuple(r) for r in ac.duplicate_keys(s, t, [("a", "a")]).collect()] == [(None, 2, 1, 2)]


def test_counts_of_the_perturbed_orders(spark, sf_dir):
    from showcase import queries as q

    found = ac.diff_summary(*q.orders_pair(spark, sf_dir), q.ORDERS_MAPPING).first()
    if sf_dir.endswith("sf0.01"):
        assert tuple(found) == (15000, 15025, 498, 523)
        kinds = {r["kind"]: r["n"] for r in q.missing_extra_keys(spark, sf_dir).groupBy("kind")
                 .count().withColumnRenamed("count", "n").collect()}
        assert kinds == {"missing_in_target": 154, "missing_in_source": 149}
        cells = q.s2t_cells(spark, sf_dir).groupBy("kind").sum("joined_rows").collect()
        assert {tuple(r) for r in cells} == {
            ("value", 165),
            ("null_vs_value", 179),
            ("missing_in_target", 154),
            ("missing_in_source", 149),
        }


def test_plan_of_row_diff(spark, sf_dir):
    from showcase import queries as q

    plan = plan_of(ac.row_diff(*q.lines_pair(spark, sf_dir)))
    assert plan.count("Exchange hashpartitioning") == 1
    # Copies are counted on both sides of the one shuffle.
    assert plan.count("HashAggregate") == 2
    assert "Python" not in plan


def test_plan_of_key_diff_reads_keys_only(spark, sf_dir):
    from showcase import queries as q

    plan = plan_of(ac.key_diff(*q.orders_pair(spark, sf_dir), q.ORDERS_KEYS))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    assert "o_totalprice" not in plan


def test_plan_of_unique_keys_is_one_join(spark, sf_dir):
    from showcase import queries as q

    pair = q.orders_pair(spark, sf_dir)
    plan = plan_of(ac.cell_diff(*pair, q.ORDERS_MAPPING, q.ORDERS_KEYS, unique_keys=True))
    assert plan.count("SortMergeJoin") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_plan_of_cells_combines_before_the_shuffle(spark, sf_dir):
    from showcase import queries as q

    plan = plan_of(q.s2t_cells(spark, sf_dir))
    assert "partial_sum" in plan and "SortAggregate" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan
