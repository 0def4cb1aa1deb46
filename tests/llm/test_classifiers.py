import tracemalloc
import zlib

import numpy as np
import pytest

from accordance.llm import features
from accordance.llm import op2_nbsvm as nb
from accordance.llm import op6_weak_toxicity as weak
from accordance.llm.features import SLOTS, scored, toxic_slots
from accordance.llm.queries import op2_nbsvm_quality, op6_weak_toxicity
from accordance.llm.tables import bounded_batches

SCHEMA = "doc_id long, text string, y int, score string"


def remainder(doc_id, of):
    return zlib.crc32(str(doc_id).encode()) % of


@pytest.mark.parametrize(
    ("query", "label", "of", "held", "least"),
    [(op2_nbsvm_quality, "quality", 4, 2, 0.95), (op6_weak_toxicity, "toxic", 5, 0, 0.95)],
)
def test_held_out_labels_are_predicted(spark, query, label, of, held, least):
    folder = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in query(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    right = [rows[r.doc_id].predicted == r[label] for r in labels if rows[r.doc_id].held_out]
    assert np.mean(right) > least
    limit = 0.7 if label == "quality" else 0.5
    for r in rows.values():
        assert r.held_out == (remainder(r.doc_id, of) == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= limit)


def test_labels_of_held_out_documents_are_not_used(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    turned = labels.withColumn(
        "toxic",
        features.F.when(features.bucket(features.F.col("doc_id"), 5) == 0, 1 - features.F.col("toxic")).otherwise(
            features.F.col("toxic")
        ),
    )
    first, second = (
        {r.doc_id: r.score for r in weak.toxicity_scores(docs, some).collect()} for some in (labels, turned)
    )
    assert first == second


def odd(spark):
    rows = [(1, None, 1, "a"), (2, "", 0, "b"), (3, "...", 1, None), (None, "no id", None, None), (4, "same text", 0, ""), (4, "same text", 0, "")]
    return spark.createDataFrame([*rows, (5, "word " * 60_000, 1, "")], SCHEMA)


@pytest.mark.parametrize("scores", [nb.quality_scores, weak.toxicity_scores])
def test_odd_rows_and_tables(spark, scores):
    docs = odd(spark)
    for text in (
        "VALUES (1, 1, 0), (2, 0, 1), (4, 1, 0), (4, 0, 1), (5, NULL, NULL), (NULL, 1, 1), (99, 0, 0)",
        "VALUES (1, 1, 1)",
        "VALUES (1, NULL, NULL)",
    ):
        labels = spark.sql(f"SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(quality AS INT) AS quality, CAST(toxic AS INT) AS toxic FROM {text} AS t(doc_id, quality, toxic)")
        got = scores(docs, labels).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in docs.select("doc_id").collect())
        assert all(0 <= r.score <= 1 for r in got)
        same = [r.score for r in got if r.doc_id == 4]
        assert same[0] == same[1]
        assert [r.held_out for r in got if r.doc_id is None] == [False]
        assert scores(docs.where("false"), labels).count() == 0


def test_log_count_ratios_and_weights_follow_the_classes():
    y = np.array([1, 1, 1, 0, 0, 0] * 5)
    x = [np.array([7, 9] if label else [8, 9]) for label in y]
    r = nb.log_count_ratios(y, x)
    assert r[7] > 0 > r[8] and abs(r[9]) < 1e-9 and r[1] == 0
    w, bias = nb.dual_coordinate_descent(y, x, r, 1.0, 20)
    weights = w * r
    assert all((weights[row].sum() + bias > 0) == bool(label) for label, row in zip(y, x, strict=True))


def test_dual_coordinate_descent_reaches_the_optimum():
    """The duality gap closes."""
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 60)
    x = [np.unique(np.append(rng.integers(0, 40, 8), 50 + label * rng.integers(0, 2))) for label in y]
    r = np.where(np.arange(features.SLOTS) < 60, 1.0, 0.0)
    values = [r[row] / np.sqrt(len(row)) for row in x]
    signs = np.where(y > 0, 1.0, -1.0)
    each = 1.0 / (2 * np.where(y > 0, (y > 0).mean(), (y == 0).mean()))

    def primal(w, bias):
        hinge = [max(0, 1 - s * (w[row] @ v + bias)) for s, row, v in zip(signs, x, values, strict=True)]
        return (w @ w + bias**2) / 2 + (each * np.array(hinge)).sum()

    w, bias = nb.dual_coordinate_descent(y, x, r, 1.0, 400)
    best = primal(w, bias)
    for _ in range(50):
        assert primal(w + rng.normal(0, 0.01, len(w)) * (r > 0), bias + rng.normal(0, 0.01)) >= best - 1e-3


def test_voters_that_copy_each_other_count_less():
    """A block of copies of one weak voter does not outvote independent ones; few labels tie the classes."""
    rng = np.random.default_rng(6)
    n = 4000
    truth = rng.random(n) < 0.3
    answer = lambda right: np.where(rng.random(n) < right, truth, ~truth)
    weak_voter = answer(0.65)
    says = np.stack([answer(0.85), answer(0.85), answer(0.85), *[weak_voter] * 6], 1)
    v = np.hstack([says, ~says]).astype(float)
    model = weak.first_model(truth[:200].astype(int), v[:200])
    for _ in range(20):
        model = weak.estimated(weak.moments(v, np.ones(n), model) / weak.STEPS)
    post = model.posterior(v)
    assert ((post > 0.5) == truth).mean() > 0.9
    assert abs(model.chance[0, :3] - 0.85).max() < 0.08 and (model.alike[3, 4:9] > 0.9).all()


def test_silence_and_lexicon_vote():
    words = [weak.word_slot("idiot"), weak.word_slot("tree")]
    x = [np.sort(words), np.array([words[1]])]
    slots = weak.voters(np.array([1, 0]), x)
    v = weak.votes(x, slots)
    assert v[:, -1].tolist() == [0, 1] and v[0, :-1].sum() == 1 and v[1, :-1].sum() == 0
    assert words[0] in slots and words[1] not in slots


def test_mined_voters_cover_documents_that_no_other_is_in():
    lexicon, copied, rare = np.array([5]), list(range(100, 150)), 200
    x = [np.array([5, 9])] * 20 + [np.array([9, *copied])] * 6 + [np.array([9, rare])] * 4 + [np.array([9])] * 200
    y = np.array([1] * 30 + [0] * 200)
    mined = weak.mined_voters(y, x, lexicon, covers=1)
    assert sorted(mined) == [copied[0], rare]
    assert len(weak.mined_voters(y, x, lexicon)) == 4  # no more than three of the copied words
    assert len(weak.mined_voters(np.zeros(0, int), [], lexicon)) == 0


def test_the_driver_holds_votes_part_by_part_and_counts_of_few_slots():
    rng = np.random.default_rng(9)
    x = [np.unique(rng.integers(0, features.SLOTS, 40)).astype(np.int32) for _ in range(6000)]
    y = (np.arange(6000) % 4 == 0).astype(int)
    for n in range(0, 6000, 4):
        x[n] = np.unique(np.append(x[n], 1000 + n // 4 % 60)).astype(np.int32)
    slots = np.append(np.arange(1000, 1240), weak.TONES)
    v = weak.votes(x, slots)
    model = weak.first_model(y, v)
    assert np.allclose(weak.posteriors(model, x, slots), model.posterior(v), rtol=1e-12, atol=0)
    same = weak.first_model_of(y, x, slots)
    assert same.prior == model.prior and np.array_equal(same.chance, model.chance) and np.array_equal(same.alike, model.alike)
    del v

    def peak(call):
        tracemalloc.start()
        call()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most / 1e6

    assert peak(lambda: weak.posteriors(model, x, slots)) < 10
    assert peak(lambda: weak.first_model_of(y, x, slots)) < 12
    # Counts of all slots are two arrays of 8 MB.
    assert peak(lambda: weak.mined_voters(y, x, np.array([5]))) < 30
    assert peak(lambda: weak.train(y.astype(float), x, epochs=1)) < 50


def test_patterns_and_moments_cover_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [r.text for r in docs.select("text").collect()] + [None, ""]
    x = features._lists(texts, features.toxic_slots)
    slots = weak.voters(np.array([1, 0]), x[:2])
    v = weak.votes(x, slots)
    more = docs.select("text").unionByName(spark.createDataFrame([(None,), ("",)], "text string"))
    counted = weak.patterns(more.repartition(5), slots)
    assert counted.agg({"n": "sum"}).first()[0] == len(texts)
    chance = np.linspace(0.1, 0.6, 2 * v.shape[1]).reshape(2, -1)
    model = weak.LabelModel(0.3, chance, np.full((v.shape[1], v.shape[1]), 0.01))
    expected = weak.moments(v, np.ones(len(v)), model) / weak.STEPS
    assert np.array_equal(weak.summed_moments(counted, model), expected)
    none = weak.summed_moments(counted.where("false"), model)
    assert not none.any() and np.isfinite(weak.estimated(none).posterior(v)).all()


def test_repeated_rows_do_not_grow_the_sample(spark):
    docs = spark.range(3000).selectExpr("id % 3 AS doc_id", "concat('text ', id % 7) AS text")
    labels = spark.sql("SELECT CAST(id AS BIGINT) AS doc_id, 1 AS toxic FROM range(3)")
    y, x = features.labelled_sample(docs, labels, "toxic", 10, features.toxic_slots)
    assert len(y) == len(x) == 3
    again = features.labelled_sample(docs.repartition(4), labels, "toxic", 10, features.toxic_slots)
    assert all((a == b).all() for a, b in zip(x, again[1], strict=True))


def test_columns_named_as_the_score_stay(spark):
    docs = spark.createDataFrame([(1, "a", 1, 2), (2, None, 3, 4)], "doc_id long, text string, Score int, score_text int")
    labels = spark.sql("SELECT CAST(1 AS BIGINT) AS doc_id, 0 AS toxic")
    kept = weak.without_toxic(docs, labels)
    assert kept.columns == docs.columns and sorted(r.Score for r in kept.collect()) == [1, 3]


def test_tasks_get_texts_once_and_in_bounded_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    docs = spark.createDataFrame([(i, "a" * 20_000) for i in range(1000)], "doc_id long, text string").coalesce(1)
    bounded_batches(spark)
    try:
        counted = docs.mapInArrow(lambda batches: (b.select(["doc_id"]).slice(0, 1) for b in batches), "doc_id long")
        assert counted.count() > 1
        weights = np.zeros(SLOTS)
        out = scored(docs, weights, 0.0, 1.0, 0.0, toxic_slots, ["text", "doc_id"])
        assert out.columns == ["text", "doc_id", "score"]
        assert {(len(r.text), r.score) for r in out.collect()} == {(20_000, 0.5)}
        assert "score_text" not in out._jdf.queryExecution().toString()
        spark.conf.set(key, "1m")
        bounded_batches(spark)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)
