import math
from collections import Counter, defaultdict

import pytest

from accordance.llm import op1_mixing as m
from accordance.llm.queries import op1_temperature_mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int"


def rows_of(df):
    return [(r.doc_id, r.source, r.n_tokens, r.epoch, r.place) for r in df.collect()]


def weights(shares, a):
    z = sum(p**a for p in shares.values())
    return {s: p**a / z for s, p in shares.items()}


def test_the_table_is_mixed_to_its_weights(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    tokens = {r.doc_id: len((r.text or "").split()) for r in docs}
    source = {r.doc_id: r.source for r in docs}
    totals = Counter()
    for i, n in tokens.items():
        totals[source[i]] += n
    got = rows_of(op1_temperature_mixing(spark, sf_dir))
    assert {(r[0], r[1], r[2]) for r in got} == {(i, source[i], tokens[i]) for i in tokens}
    assert len({(r[0], r[3]) for r in got}) == len(got)
    # The exponent at which the smallest source passes 1.5 times, and the budgets at it.
    shares = {s: n / sum(totals.values()) for s, n in totals.items()}
    low, high = min(shares.values()), max(shares.values())
    a = 1 - math.log(1.5) / math.log(high / low)
    w = weights(shares, a)
    spent = Counter()
    for r in got:
        spent[r[1]] += r[2]
    longest = max(tokens.values())
    for s in totals:
        budget = totals[s] * w[s] / shares[s] / (w[max(shares, key=shares.get)] / high)
        assert budget - 2 <= spent[s] <= budget + longest + totals[s] * 1e-4
    assert all(0 <= r[4] < 1 or r[2] == 0 for r in got)


def test_the_entropy_is_met(spark):
    rows = [(n, "a b c d", None, f"s{min(n % 40, 4)}", 7, 0) for n in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    narrow = docs.select(m.F.length("text").alias("mix_tokens"), m.F.col("source").alias("mix_source"))
    totals = m.source_totals(narrow)
    shares = {r.mix_source: r.p for r in totals.collect()}
    a = m.find_exponent(totals, entropy=1.2)
    w = weights(shares, a)
    assert -sum(x * math.log(x) for x in w.values()) == pytest.approx(1.2, abs=1e-4)
    assert m.find_exponent(totals, entropy=9.0) == 0.0


def test_passes_are_whole_permutations_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_ROWS", 16)
    rows = [(n, "a " * (n % 7 + 1), None, "big" if n % 10 else "small", 0, 0) for n in range(1000)]
    got = m.mixed(spark.createDataFrame(rows, SCHEMA), max_passes=3.5).collect()
    passes = defaultdict(set)
    for r in got:
        passes[r.row.source, r.mix_epoch].add(r.row.doc_id)
    big, small = {n for n in range(1000) if n % 10}, {n for n in range(1000) if not n % 10}
    assert passes["big", 1] == big and ("big", 2) not in passes
    assert passes["small", 1] == passes["small", 2] == passes["small", 3] == small
    assert 0 < len(passes["small", 4]) < len(small)
    orders = [[r.row.doc_id for r in sorted(got, key=lambda r: r.mix_place) if (r.row.source, r.mix_epoch) == ("small", e)] for e in (1, 2)]
    assert orders[0] != orders[1]


def test_nulls_empty_and_repeated_rows(spark):
    rows = [(1, None, None, None, None, 1), (2, "", None, "x", 0, 1), (3, "a b", None, "x", 3, 1), (3, "a b", None, "x", 3, 1), (None, "c", None, "", 1, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = Counter((r.row.doc_id, r.row.text) for r in m.mixed(df, max_passes=1.0).collect())
    assert got == Counter((r[0], r[1]) for r in rows)
    assert m.mixed(df.where("false")).count() == 0
    assert m.mixed(df.where("doc_id = 2")).count() == 1


def test_token_count(spark):
    texts = ["a b", " a\n\tb  c ", "", None, "  ", "é"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(m.token_count(m.F.col("t"))).collect()] == [2, 3, 0, 0, 0, 1]
