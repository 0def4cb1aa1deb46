"""Quality classifier: naive Bayes support vectors.

Indicators of n-grams are scaled by the log-count ratios of naive Bayes, r = log((p / |p|) / (q / |q|))
with smoothed counts p and q of documents of either class, and a linear model with hinge
loss is fitted to them by dual coordinate descent.  The weight of an n-gram is then w r.  Margins become
probabilities by a logistic fitted on a part of the sample that the model hasn't seen.

It is fitted on a bounded sample of labelled documents (``rows``); scoring sends the weights, of fixed
size, to all tasks and reads each text once.

Defined results: a null or empty text has no n-grams and gets the score of the bias.  Without labels of
both classes the score is the share of label 1, one half without any label.  Repeated rows are scored
each; null ids too.  Extra columns are left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordance.llm.features import SLOTS, bucket, calibration, labelled_sample, quality_slots, scored

#: Labelled documents that the model is fitted on at most.
ROWS = 8000


def log_count_ratios(y: np.ndarray, x: list[np.ndarray], smooth: float = 1.0) -> np.ndarray:
    p, q = np.full(SLOTS, smooth), np.full(SLOTS, smooth)
    for label, row in zip(y, x, strict=True):
        (p if label else q)[row] += 1
    seen = (p + q) > 2 * smooth
    ratio = np.log(p / p[seen].sum()) - np.log(q / q[seen].sum()) if seen.any() else np.zeros(SLOTS)
    return np.where(seen, ratio, 0.0)


def dual_coordinate_descent(
    y: np.ndarray, x: list[np.ndarray], r: np.ndarray, cost: float, epochs: int, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + cost * sum of hinge losses; classes weigh the same.

    One dual variable at a time is moved to its best value between 0 and the cost of its document.
    """
    signs = np.where(y > 0, 1.0, -1.0)
    share = np.array([(signs < 0).mean(), (signs > 0).mean()])
    each = cost / (2 * np.where(signs > 0, share[1], share[0]))
    w, bias, alpha = np.zeros(SLOTS), 0.0, np.zeros(len(x))
    values = [r[row] for row in x]
    norm = [1 / max(np.sqrt(v @ v), 1e-9) for v in values]
    values = [v * n for v, n in zip(values, norm, strict=True)]
    diagonal = np.array([v @ v + 1 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        largest = 0.0
        for i in rng.permutation(len(x)):
            gradient = signs[i] * (w[x[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / diagonal[i], 0.0), each[i])
            if change := new - alpha[i]:
                w[x[i]] += change * signs[i] * values[i]
                bias += change * signs[i]
                alpha[i] = new
                largest = max(largest, abs(change))
        if largest < 1e-4:
            break
    return w, bias


def fit(
    y: np.ndarray, x: list[np.ndarray], cost: float = 1.0, epochs: int = 12
) -> tuple[np.ndarray, float, float, float]:
    """Weights by slot, bias, and slope and offset of the logistic."""
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return np.zeros(SLOTS), 0.0, 0.0, float(np.log(share / (1 - share)))
    aside = np.arange(len(y)) % 5 == 4
    if len(set(y[aside].tolist())) < 2:
        aside[:] = False
    own = ~aside
    r = log_count_ratios(y[own], [v for v, o in zip(x, own, strict=True) if o])
    rows = [v[r[v] != 0] for v in x]
    w, bias = dual_coordinate_descent(y[own], [v for v, o in zip(rows, own, strict=True) if o], r, cost, epochs)
    weights = w * r
    held = aside if aside.any() else own
    margins = np.array([weights[v].sum() for v, h in zip(x, held, strict=True) if h]) + bias
    slope, offset = calibration(margins, y[held])
    return weights, bias, slope, offset


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out documents aren't used."""
    known = labels.where(bucket(F.col("doc_id"), 4) != 2)
    y, x = labelled_sample(docs, known, "quality", rows, quality_slots)
    out = scored(docs, *fit(y, x), quality_slots, ["doc_id"])
    return out.select(
        "doc_id",
        F.coalesce(bucket(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
