import math
from collections import Counter

import numpy as np
import pytest

from accordance.llm import op3_cross_entropy as o
from accordance.llm.queries import op3_cross_entropy
from tests.llm import brute

SCHEMA = "doc_id long, text string, value long, n string"


def brute_scores(docs, target):
    """By dictionaries of words."""
    split = lambda t: [brute.fold(w) for w in brute.words(t)]

    def grams(text):
        words = split(text)
        return list(zip(["<s>", *words[:-1]], words, strict=True)) if words else []

    size = len({w for _, t in docs for w in split(t)})
    models = []
    for texts in (target, [t for _, t in docs]):
        found, context, single, kinds = Counter(g for t in texts for g in grams(t)), Counter(), Counter(), Counter()
        for (a, b), n in found.items():
            context[a] += n
            single[b] += n
            kinds[a] += 1
        models.append((found, context, single, kinds, sum(single.values())))

    def chance(model, a, b):
        found, context, single, kinds, whole = model
        alone = (single[b] + 0.5) / (whole + 0.5 * (size + 1))
        if not context[a]:
            return alone
        return max(found[a, b] - 0.75, 0) / context[a] + 0.75 * kinds[a] / context[a] * alone

    out = {}
    for i, t in docs:
        g = grams(t)
        losses = [-sum(math.log(chance(m, *x)) for x in g) / max(len(g), 1) for m in models]
        out[i] = (len(g), *losses, losses[0] - losses[1])
    return out


def same(got, expected):
    assert got.keys() == expected.keys()
    for i, row in expected.items():
        assert got[i][0] == row[0]
        assert got[i][1:] == pytest.approx(row[1:], abs=1e-4)


def scores(df):
    return {r.doc_id: (r.n_words, r.target_loss, r.background_loss, r.score) for r in df.collect()}


def test_the_query_is_scored_as_by_dictionaries(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    good = {
        r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()
    }
    rows = [(r.doc_id, r.text) for r in docs]
    expected = brute_scores(rows, [t for i, t in rows if i in good])
    same(scores(op3_cross_entropy(spark, sf_dir)), expected)


def test_without_target_or_documents(spark):
    df = spark.createDataFrame([(1, "a b", 0, ""), (None, None, None, None)], SCHEMA)
    assert o.cross_entropy_difference(df, df.where("false")).count() == 2
    assert o.cross_entropy_difference(df.where("false"), df.where("false")).count() == 0
    assert scores(o.cross_entropy_difference(df, df))[None] == (0, 0.0, 0.0, 0.0)


def test_what_is_looked_up_is_bounded(spark, monkeypatch):
    """Also where every count is high: the most frequent rows, ties by value."""
    monkeypatch.setattr(o, "LOOKED_UP", 10)
    counts = spark.range(100).selectExpr("id AS value", "CAST(70000 + id % 2 AS LONG) AS all")
    assert sorted(r.value for r in o._most(counts, o.F.col("all"), "value").collect()) == list(range(1, 20, 2))
    monkeypatch.setattr(o, "BITS", 2)
    df = spark.createDataFrame([(1, "a b c d e f g", 0, "")], SCHEMA)
    with pytest.raises(ValueError, match="do not fit"):
        o.cross_entropy_difference(df, df)


@pytest.mark.parametrize("looked_up", [0, 3, 40, 1 << 20])
def test_all_words_and_pairs_count_however_they_are_looked_up(spark, monkeypatch, looked_up):
    monkeypatch.setattr(o, "LOOKED_UP", looked_up)
    texts = ["a b a c a b", "a b c", "x y a b", "", None, "b b b b a", "A, b! c?", "a b a c a b", "q r s t u v w q r"]
    docs = [(n, t) for n, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, 1, "n") for i, t in docs], SCHEMA)
    got = scores(o.cross_entropy_difference(df, df.where("doc_id IN (0, 5, 8)")))
    marked = df.withColumn("is_target", o.F.expr("if(doc_id IN (0, 5, 8), true, if(doc_id = 1, NULL, false))"))
    same(scores(o.cross_entropy_difference(df, is_target=marked)), got)
    same(got, brute_scores(docs, [texts[k] for k in (0, 5, 8)]))


def test_the_query_tells_apart_all_words_and_pairs(spark):
    """More words than any fixed vocabulary had: 2^14 common ones, then two rare ones of the target and the rest."""
    common = " ".join(f"w{n}" for n in range(1 << 14))
    rows = [(0, common, 0, ""), (1, common, 0, ""), (2, "rare rare", 0, ""), (3, "other other", 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = scores(o.cross_entropy_difference(df, df.where("doc_id = 2")))
    assert got[2][3] < got[3][3] - 1
    same(got, brute_scores([r[:2] for r in rows], ["rare rare"]))


def test_parts_of_pairs_hold_what_was_packed():
    rng = np.random.default_rng(3)
    key = np.unique(np.append(rng.integers(-(1 << 63), 0, 3000), rng.integers(0, 1 << 42, 3000)))
    before = np.where(key < 0, rng.integers(-(1 << 63), 1 << 21, len(key)), key >> o.BITS)
    word = np.where(key < 0, rng.integers(-(1 << 63), 1 << 21, len(key)), key & ((1 << o.BITS) - 1))
    own, both = rng.integers(0, 1 << 40, (2, len(key)))
    batch = o.packed(key, before, word, own, both)
    assert len(set(batch.column("part").to_pylist())) == batch.num_rows
    got = [row for some in o._of_parts(iter([batch, batch])) for row in some.to_pylist()]
    kept = {r["key"]: (r["before"], r["word"], r["own"], r["all"]) for r in got}
    expected = {}
    for k, *row in zip(*(x.tolist() for x in (key, before, word, 2 * own, 2 * both)), strict=True):
        expected[k] = (*(row[:2] if k < 0 else (None, None)), *row[2:])
    assert kept == expected


def test_pairs_are_shuffled_in_parts(spark):
    docs = spark.createDataFrame([(1, "a b a b c", 1, 1)], "doc_id long, text string, own long, all long")
    known = spark.sparkContext.broadcast(o.Known(np.zeros(0, np.int64), np.zeros(0, np.int32)))
    pairs = o._pair_counts(docs, known)
    assert "pairs" in pairs._jdf.queryExecution().toString()
    assert sorted(r["all"] for r in pairs.collect()) == [1, 1, 1, 2]
