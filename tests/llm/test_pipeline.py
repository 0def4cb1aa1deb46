from collections import Counter

import corpus_pipeline as p
from accordance.llm import op1_mixing
from accordance.llm.queries import op6_weak_toxicity
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n long"


def clean_of(rows, items):
    windows = set()
    for text in items:
        w = brute.words(text)
        size = min(len(w), 10)
        windows |= {tuple(w[s : s + size]) for s in range(len(w) - size + 1)} if w else set()
    sizes = {len(x) for x in windows}

    def clean(text):
        w = brute.words(text)
        return not any(tuple(w[s : s + n]) in windows for n in sizes for s in range(len(w) - n + 1))

    return [x for x in rows if clean(x[1])]


def test_the_pipeline_equals_its_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    toxic = {r.doc_id for r in op6_weak_toxicity(spark, sf_dir).collect() if r.predicted}
    rows = [x for x in rows if x[0] not in toxic]
    first = {c[0]: c[1] for c in brute.classes(rows)}
    rows = [x for x in rows if first[x[0]] == x[0]]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = clean_of(rows, items)
    mixed = op1_mixing.mixed(docs.join(spark.createDataFrame([(x[0],) for x in rows], "doc_id long"), "doc_id"), max_passes=p.MAX_PASSES)
    taken = Counter(r[0] for r in mixed.select("row.doc_id").collect())
    assert set(taken) == {x[0] for x in rows} and set(taken.values()) <= {1, 2}
    got = sorted(p.run(spark, sf_dir).collect(), key=lambda r: r.start)
    assert Counter(r.doc_id for r in got) == taken
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got)
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens


def test_each_stage_keeps_columns_and_bears_odd_rows(spark, sf_dir):
    text = "these are the words of a document that is long enough for everything here"
    rows = [
        (1, text, "en", "a", 1, 0.1, 2), (1, text, "en", "a", 1, 0.1, 2), (2, text + "!", None, None, None, None, None),
        (3, None, "en", "b", 0, 0.0, 0), (4, "", "en", "b", 0, 0.0, 0), (None, "other words of no other document at all", "en", "b", 0, 0.0, 0),
        (5, "x " * 50_000, "en", "b", 0, 0.0, 0),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        kept = Counter((r.doc_id, r.text) for r in out.collect())
        if name == "near_duplicates":
            assert kept == Counter({(r[0], r[1]) for r in rows if r[0] != 2})
        else:
            assert set(kept) == {(r[0], r[1]) for r in rows}, name
        assert stage(spark, docs.where("false"), sf_dir).count() == 0
    assert p.token_ids(spark, docs, sf_dir).count() == len(rows)
