"""Hard negatives against all pairs, on small tables of odd rows."""

import random

import numpy as np

from accordance.llm import op11_hard_negatives as hard

LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


def brute(rows, of_label=5, count=10):
    own = [
        (i, (k + 1) % 10 if i % 7 == 0 else k, [int((256 * x) // 1) for x in v]) for i, k, v in rows
        if i is not None and k is not None and v and all(x is not None and x == x and abs(x) != float("inf") for x in v)
    ]
    out = []
    for a, label, x in own:
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, k) for i, k, y in own if i != a)
        for ps, p in [(-s, i) for s, i, k in scored if k == label][:of_label]:
            found = [(i, -s) for s, i, k in scored if k != label and 30 * ps <= -100 * s <= 90 * ps]
            out += [(a, p, n + 1, i, ps, s) for n, (i, s) in enumerate(found[:count])]
    return sorted(out)


def rows_of(spark, rows):
    extra = [(*r, 0, "x") for r in rows]
    return spark.createDataFrame(extra, "vec_id long, label int, embedding array<double>, rank int, place string")


def test_negatives_equal_all_pairs(spark):
    rng = random.Random(4)
    rows = []
    for n in range(900):
        k = rng.randrange(10)
        rows.append((n, k, [rng.gauss(2.0 if d == k else 0.3, 0.7) for d in range(12)]))
    rows += [(n, n % 3, [float(n % 3), 0.0, 0.5]) for n in range(900, 960)]  # ties and shorter vectors
    rows += [(n, n % 2, [0.0] * 12) for n in range(1000, 1020)]  # scores of zero
    rows += [(n, 4, [-1.0 if n % 100 else 1.0] * 12) for n in range(1100, 1104)]
    rows += [(1201, 1, None), (1202, 1, []), (1203, 1, [None, 1.0]), (1204, 1, [float("nan")]), (1300, None, [1.0]), (None, 1, [1.0])]
    rows += [(n, n % 2, [1e6 + n] * 12) for n in range(2000, 2030)]  # sums beyond 2^53
    df = rows_of(spark, rows)
    is_anchor = hard.F.col("vec_id") % 100 == 0
    expected = brute(rows)
    assert len(expected) > 100
    for block in (hard.BLOCK, 3):
        got = hard.hard_negatives(df.repartition(5), is_anchor, LABEL, block=block)
        assert sorted(tuple(r) for r in got.collect()) == expected
    assert hard.hard_negatives(df.where("false"), is_anchor, LABEL).count() == 0
    assert hard.hard_negatives(df.where("vec_id = 0"), is_anchor, LABEL).count() == 0
    assert [r[0] for r in hard.hard_negatives(df, is_anchor, LABEL).dtypes] == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]


def test_rows_that_share_an_id(spark):
    rows = [(0, 3, [1.0, 0.0]), (0, 4, [2.0, 0.0]), (1, 4, [1.0, 0.0]), (1, 4, [1.0, 0.0]), (2, 5, [0.5, 0.0]), (2, 5, [0.5, 0.0])]
    got = hard.hard_negatives(rows_of(spark, rows), hard.F.col("vec_id") % 100 == 0, LABEL)
    # The smaller vector is the anchor, of label 4; both rows of id 1 are its positives, both of id 2 their negatives.
    one = [(0, 1, n, 2, 256 * 256, 128 * 256) for n in (1, 2)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(one + one)


def test_join_is_whole_and_omits_dimensions():
    rng = np.random.default_rng(5)
    q, x = np.floor(rng.normal(size=(30, 24)) * 256), np.floor(rng.normal(size=(700, 24)) * 256)
    x[:100] /= 16
    x = np.floor(x)
    for share in (-0.2, 0.0, 0.3, 0.7):
        least = share * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
        at, row, score = hard.join(q, least, x)
        full = q @ x.T
        assert set(zip(at.tolist(), row.tolist())) == set(zip(*(c.tolist() for c in np.nonzero(full >= least[:, None]))))
        assert (score == full[at, row]).all()
    postings = hard.Postings(x, 0.5 * np.linalg.norm(x, axis=1).max())
    assert len(postings.rows) < len(x) and (postings.first > 0).any()
    at, _ = postings.candidates(q, 0.7 * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max())
    assert len(at) < 0.2 * len(q) * len(x)  # pruned before any score is known
