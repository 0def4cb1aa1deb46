"""Cell comparison on small fixtures, and against brute force."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import accordance as ac
from accordance.operators import cells as cells_module
from accordance.operators.cells import keys_not_unique

SCHEMA = "k int, v string, x double"
SAME = [("k", "k"), ("v", "v"), ("x", "x")]
KEY = [("k", "k")]

SETTINGS = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)

ROWS = st.lists(
    st.tuples(
        st.sampled_from([None, 1, 2, 3]),
        st.sampled_from([None, "a", "b"]),
        st.sampled_from([None, 0.0, -0.0, 1.5, float("nan")]),
    ),
    max_size=7,
)


def norm(value):
    if isinstance(value, float):
        return "nan" if value != value else value + 0.0
    return value


def joined_cells(source, target):
    """Per key and column, how many rows of the full outer join differ, by nested loops."""
    counts = Counter()
    for s in source:
        for t in target:
            if s[0] == t[0]:
                for i, name in ((1, "v"), (2, "x")):
                    if norm(s[i]) != norm(t[i]):
                        counts[s[0], name] += 1
    for own, other, kind in (
        (source, target, "missing_in_target"),
        (target, source, "missing_in_source"),
    ):
        for row in own:
            if row[0] not in {o[0] for o in other}:
                counts[row[0], kind] += 1
    return counts


def counted(cells):
    counts = Counter()
    for row in cells.collect():
        missing = row["kind"].startswith("missing")
        counts[row["k"], row["kind"] if missing else row["column_name"]] += row["joined_rows"]
    return +counts


@SETTINGS
@given(source=ROWS, target=ROWS)
def test_joined_rows_equal_nested_loops(spark, source, target):
    s, t = spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA)
    expected = joined_cells(source, target)
    assert counted(ac.cell_diff(s, t, SAME, KEY)) == expected
    stored = keys_not_unique(s, t, SAME, KEY)
    assert counted(ac.cell_diff(s, t, SAME, KEY, duplicates=stored)) == expected
    # The join gives one line per joined row, so it agrees whatever the keys.
    assert counted(ac.cell_diff(s, t, SAME, KEY, unique_keys=True)) == expected


def test_sample_customers(spark):
    source = spark.createDataFrame(
        [
            ("1", "John Doe", "john.doe@example.com"),
            ("2", "Jane Smith", "jane.smith@example.com"),
            ("3", "Peter Jones", "peter.jones@example.com"),
        ],
        "id string, name string, email string",
    )
    target = source.selectExpr(
        "id AS cust_id",
        "name AS cust_name",
        "if(id = '2', 'jane.s@example.com', email) AS cust_email",
    )
    mapping = ac.parse_mapping("id:cust_id,name:cust_name,email:cust_email")
    keys = ac.parse_keys("id", mapping)
    assert [tuple(r) for r in ac.cell_diff(source, target, mapping, keys).collect()] == [
        ("2", "email", "jane.smith@example.com", "jane.s@example.com", "value", False, 1, 1, 1)
    ]
    details = ac.mismatch_details(source, target, mapping, keys).collect()
    assert details[0]["mismatch_details"] == "email:jane.smith@example.com!=jane.s@example.com"


def test_kinds(spark):
    source = spark.createDataFrame([(1, "a", None), (2, None, 1.0), (None, "n", 0.0)], SCHEMA)
    target = spark.createDataFrame([(1, "a", 2.5), (3, None, 1.0), (None, "m", -0.0)], SCHEMA)
    for options in ({}, {"unique_keys": True}):
        cells = ac.cell_diff(source, target, SAME, KEY, **options).collect()
        assert {(r["k"], r["column_name"], r["kind"]) for r in cells} == {
            (1, "x", "null_vs_value"),
            (2, None, "missing_in_target"),
            (3, None, "missing_in_source"),
            (None, "v", "value"),
        }


def test_text_is_read_as_the_other_type(spark):
    source = spark.createDataFrame(
        [("1", "5"), ("2", "z"), ("3", None), ("x", "1")], "id string, n string"
    )
    target = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "id int, n int")
    mapping = [("id", "id"), ("n", "n")]
    for options in ({}, {"unique_keys": True}):
        cells = ac.cell_diff(source, target, mapping, mapping[:1], **options).collect()
        assert {tuple(r)[:5] for r in cells} == {
            (2, "n", "z", None, "uncastable"),
            (3, "n", None, "7", "null_vs_value"),
            (None, "id", "x", None, "uncastable"),
        }
    details = ac.mismatch_details(source, target, mapping, mapping[:1]).collect()
    assert {r["mismatch_details"] for r in details} == {
        "n:z!=NULL",
        "n:NULL!=7",
        "uncastable,id:x",
    }
    # The other way round the text is the target's.
    turned = ac.cell_diff(target, source, mapping, mapping[:1]).collect()
    assert (2, "n", None, "z", "uncastable") in {tuple(r)[:5] for r in turned}


def test_nested_values(spark):
    def frame(expressions):
        return spark.range(1).selectExpr("id AS k", *expressions)

    source = frame(
        [
            "map('b', 2, 'a', 1) AS m",
            "array(named_struct('d', 1.5D)) AS a",
            "parse_json('{\"y\": 1, \"x\": 2}') AS j",
            "named_struct('m', map(1, 'a')) AS s",
            "X'CAFE' AS b",
        ]
    )
    same = frame(
        [
            "map('a', 1, 'b', 2) AS m",
            "array(named_struct('d', 1.5D)) AS a",
            "parse_json('{\"x\": 2, \"y\": 1}') AS j",
            "named_struct('m', map(1, 'a')) AS s",
            "X'CAFE' AS b",
        ]
    )
    other = frame(
        [
            "map('a', 1, 'b', 3) AS m",
            "array(named_struct('d', 2.5D)) AS a",
            "parse_json('{\"x\": 3, \"y\": 1}') AS j",
            "named_struct('m', map(2, 'a')) AS s",
            "X'CAFF' AS b",
        ]
    )
    mapping = [(c, c) for c in "kmajsb"]
    assert ac.cell_diff(source, same, mapping, mapping[:1]).count() == 0
    assert ac.row_diff(source, same).count() == 0
    cells = ac.cell_diff(source, other, mapping, mapping[:1]).collect()
    assert {r["column_name"] for r in cells} == set("majsb")
    doubled = source.unionAll(source)
    many = ac.cell_diff(doubled, other, mapping, mapping[:1]).collect()
    assert {r["column_name"] for r in many if r["joined_rows"]} == set("majsb")


def test_only_keys_are_mapped(spark):
    source = spark.createDataFrame([(1,), (2,)], "k int")
    target = spark.createDataFrame([(2,), (2,), (3,)], "k int")
    for options in ({}, {"unique_keys": True}):
        cells = ac.cell_diff(source, target, KEY, KEY, **options).collect()
        assert sorted((r["k"], r["kind"]) for r in cells) == [
            (1, "missing_in_target"),
            (3, "missing_in_source"),
        ]


def test_names_with_dots_and_quotes(spark):
    source = spark.createDataFrame([(1, "a")], ["the.key", "it's `odd`"])
    target = spark.createDataFrame([(1, "b")], ["the.key", "it's `odd`"])
    mapping = [(c, c) for c in source.columns]
    cells = ac.cell_diff(source, target, mapping, mapping[:1]).collect()
    assert [(r["the.key"], r["column_name"]) for r in cells] == [(1, "it's `odd`")]


def test_empty_sides(spark):
    empty = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    assert ac.cell_diff(empty, empty, SAME, KEY).count() == 0
    assert [r["kind"] for r in ac.cell_diff(one, empty, SAME, KEY).collect()] == [
        "missing_in_target"
    ]


def test_hot_key_is_not_multiplied(spark):
    """A third of the rows under one key: the product would have 10**8 rows."""
    rows = spark.range(30000).selectExpr(
        "if(id % 3 = 0, -1, id) AS k", "CAST(id % 977 AS STRING) AS v", "CAST(id AS DOUBLE) AS x"
    )
    changed = rows.selectExpr("k", "if(v = '5', 'five', v) AS v", "x")
    cells = ac.cell_diff(rows, changed, SAME, KEY).where("k = -1")
    by_column = {
        r["column_name"]: r
        for r in cells.groupBy("column_name").agg({"joined_rows": "sum", "*": "count"}).collect()
    }
    assert by_column["x"]["count(1)"] == 10000
    assert by_column["x"]["sum(joined_rows)"] == 10000 * 10000 - 10000


@pytest.mark.parametrize("keys", [[], [("k", "k"), ("k", "k")], [("nope", "nope")]])
def test_wrong_keys_raise(spark, keys):
    one = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    with pytest.raises(ac.ConfigError):
        ac.cell_diff(one, one, SAME, keys)


@pytest.mark.parametrize("copies", [2, 31, 32, 400])
def test_repeated_keys_have_one_form_and_real_kinds(spark, copies):
    """However many rows a key has: a line per distinct value, of that value's kind."""
    source = spark.range(copies).selectExpr("1 AS k", "if(id = 0, NULL, 'a') AS v", "'5' AS x")
    target = spark.range(copies).selectExpr("1 AS k", "'b' AS v", "if(id = 0, 6, 5) AS x")
    source = source.selectExpr("k", "v", "if(v IS NULL, 'z', x) AS x")
    for stored in (None, keys_not_unique(source, target, SAME, KEY)):
        lines = ac.cell_diff(source, target, SAME, KEY, duplicates=stored).collect()
        assert all(r["repeated"] for r in lines)
        found = {tuple(r)[1:5]: (r["src_n"], r["tgt_n"], r["joined_rows"]) for r in lines}
        n = copies
        assert found == {
            ("v", None, None, "null_vs_value"): (1, 0, n),
            ("v", "a", None, "value"): (n - 1, 0, (n - 1) * n),
            ("v", None, "b", "value"): (0, n, 0),
            ("x", "z", None, "uncastable"): (1, 0, n),
            ("x", "5", "5", "value"): (n - 1, n - 1, n - 1),
            ("x", None, "6", "value"): (0, 1, 0),
        }


def test_rows_are_dealt_to_as_many_tasks_as_they_need(spark, monkeypatch):
    """A task gets no more rows of larger tables, and lines of repeated keys are counted where the rows are."""
    monkeypatch.setattr(cells_module, "SHARE", 10)
    rows = spark.range(300).selectExpr("CAST(id % 200 AS INT) AS k", "CAST(id AS STRING) AS v", "1.5D AS x")
    for df in (ac.cell_diff(rows, rows, SAME, KEY), ac.mismatch_details(rows, rows, SAME, KEY)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert dealt and all(", 60)" in line or ", 60," in line for line in dealt)
        assert df.count() == 2 * 100


@pytest.mark.parametrize("heavy", [0, 3, 100])
def test_spread_keys_have_the_same_lines(spark, monkeypatch, heavy):
    """Whether all parts are too large for a task, some or none."""
    shape = "if(id % 7 = 0, NULL, id % {}) AS k", "if(id % 5 = {}, NULL, CAST(id % 3 AS STRING)) AS v", "CAST(id % {} AS DOUBLE) AS x"
    source = spark.range(40).selectExpr(*(x.format(n) for x, n in zip(shape, (11, 0, 4))))
    target = spark.range(5, 47).selectExpr(*(x.format(n) for x, n in zip(shape, (13, 1, 3))))
    for compare in (ac.cell_diff, ac.mismatch_details):
        expected = Counter(map(tuple, compare(source, target, SAME, KEY).collect()))
        with monkeypatch.context() as m:
            m.setattr(cells_module, "HEAVY", heavy)
            assert Counter(map(tuple, compare(source, target, SAME, KEY).collect())) == expected
    stored = keys_not_unique(source, target, SAME, KEY)
    expected = Counter(map(tuple, ac.cell_diff(source, target, SAME, KEY).collect()))
    monkeypatch.setattr(cells_module, "HEAVY", heavy)
    assert Counter(map(tuple, ac.cell_diff(source, target, SAME, KEY, duplicates=stored).collect())) == expected


def test_no_plan_sorts_to_aggregate(spark):
    """Rows are counted by hash, and no pairs are built."""
    rows = spark.range(100).selectExpr("id % 50 AS k", "CAST(id AS STRING) AS v", "1.5D AS x")
    plan = ac.cell_diff(rows, rows, SAME, KEY)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "CartesianProduct" not in plan


def test_contradictory_mapping_raises(spark):
    one = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    with pytest.raises(ac.ConfigError):
        ac.cell_diff(one, one, [("k", "x"), ("v", "v")], KEY)


def test_what_a_type_cannot_hold_is_reported(spark):
    source = spark.sql(
        """SELECT 1 AS k, '1.239' AS a, '2024-01-01 10:00:00' AS b, 9007199254740993 AS c, '9007199254740993' AS d
           UNION ALL SELECT 2, '1.24', '2024-01-01', 9007199254740992, '7'"""
    )
    target = spark.sql(
        """SELECT k, CAST(1.24 AS DECIMAL(18,2)) AS a, DATE'2024-01-01' AS b, 9007199254740992D AS c,
                  if(k = 1, 9007199254740992D, 7D) AS d FROM VALUES (1), (2) AS t(k)"""
    )
    mapping = [(c, c) for c in "kabcd"]
    for options in ({}, {"unique_keys": True}):
        lines = ac.cell_diff(source, target, mapping, KEY, **options).collect()
        assert {(r["k"], r["column_name"], r["source_value"], r["kind"]) for r in lines} == {
            (1, "a", "1.239", "uncastable"),
            (1, "b", "2024-01-01 10:00:00", "uncastable"),
            (1, "c", "9007199254740993", "uncastable"),
            (1, "d", "9007199254740993", "uncastable"),
        }
    drift = {r["column_name"]: r["unreadable_rows"] for r in ac.schema_drift(source, target).collect()}
    assert drift == {"a": 1, "b": 1, "c": 1, "d": 1}
    zoned = spark.sql("SELECT 1 AS k, TIMESTAMP'2024-01-01 00:00:00' AS t")
    plain = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS t")
    with pytest.raises(ac.ConfigError):
        ac.cell_diff(zoned, plain, [("k", "k"), ("t", "t")], KEY)
