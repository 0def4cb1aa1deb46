import random

from accordance.llm.op9_lsh_forest import prefix_length, similar_classes
from accordance.llm.queries import op9_lsh_forest
from tests.llm import brute

SCHEMA = "doc_id long, text string, node string, key string"


def found(df):
    return sorted((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in df.collect())


def test_all_links_of_the_table_are_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(op9_lsh_forest(spark, sf_dir)) == brute.classes(rows)


def test_one_large_group_is_compared_in_tiles(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for n in range(700):
        own = list(base)
        own[rng.randrange(120)] = f"x{n}"
        rows.append((n, " ".join(own), None, None))
    got = found(similar_classes(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute.classes([r[:2] for r in rows])
    assert {r[1] for r in got} == {0} and {r[2] for r in got} == {699}


def test_nulls_short_and_repeated_texts(spark):
    long = " ".join(f"a{n}" for n in range(30_000))
    rows = [
        (1, None), (2, ""), (3, "..."), (4, "one two"), (5, "One, two!"), (6, "one two three"),
        (7, long), (8, long + " end"), (None, "some words that no other text has here"), (None, None),
        (4, "one two"), (9, "ÀÉ x y z q r"), (10, "àé x y z q r"),
    ]
    df = spark.createDataFrame([(*r, "n", "k") for r in rows], SCHEMA)
    got = {}
    for r in similar_classes(df).collect():
        got.setdefault(r.doc_id, []).append((r.class_id, r.n_links, r.n_copies))
    assert got[1] == [(1, 0, 1)] and got[2] == [(2, 0, 1)] and got[3] == [(3, 0, 1)]
    assert got[4] == [(4, 0, 3)] * 2 and got[5] == [(4, 0, 3)] and got[6] == [(6, 0, 1)]
    assert got[7] == [(7, 1, 1)] and got[8] == [(7, 1, 1)]
    assert sorted(got[None], key=str) == [(None, 0, 1)] * 2
    assert got[9] == [(9, 0, 2)] and got[10] == [(9, 0, 2)]
    assert similar_classes(df.where("false")).count() == 0


def test_the_prefix_is_shortened_until_the_recall_is_reached():
    assert prefix_length(0.8) == 5
    assert prefix_length(0.8, recall=0.9) == 6
    assert prefix_length(0.8, trees=4) == 1
