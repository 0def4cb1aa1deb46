"""Toxicity by weak supervision.

Voters fire on a document or abstain: words of a fixed lexicon, words and beginnings of words that labelled
toxic documents without these have far more often, patterns of tone, and the silence of all words.  An abstention is no evidence.
Labels do not vote.  A generative label model has for each
class the chance that each voter fires, and the prior of the class.  It is estimated by expectation maximisation over
the vote patterns of *all* documents, labelled or not: a pass over the texts counts equal patterns, and each round is one
aggregation over that table of the moments of voters, of fixed size.  Labels only say which of the two classes is the
toxic one, by the model that the rounds start from.  Voters that agree beyond what the class explains count less: the evidence of voter j
is divided by one plus the sum of its residual correlations, from the same moments, with the others that fire on the document.
A linear classifier (logistic loss) is
trained on the posterior labels of documents over hashed words, labels calibrate it, and it alone scores texts.

Lexicon voters are mined, and scores calibrated, on a bounded sample of labelled documents, the classifier is trained on a bounded
sample of any but held-out documents (``rows`` each); scoring sends the weights, of fixed size, to all tasks.

Defined results: as for the quality classifier.  Repeated rows each have their pattern counted; a sample has one row of a
doc_id.  Long texts are taken whole.  Without labels of both kinds nothing ties the classes, and the score is that of the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordance.llm.features import (
    PATTERNS,
    SLOTS,
    bucket,
    calibration,
    labelled_sample,
    scored,
    toxic_slots,
    word_slot,
)
from accordance.llm.tables import bounded_batches, keep
from accordance.llm.tokens import chunks

#: Documents of a sample at most, and voters mined from labelled ones at most.
ROWS, MINED = 16_000, 240
#: Posterior chances are summed in steps of this size, so that sums are exact in any order.
STEPS = 1 << 20
#: Voters that a toxic document should have.
COVERS = 3
#: Documents whose votes the driver holds as a matrix at a time.
ROWS_AT_ONCE = 1024
#: The slots of the patterns of tone.
TONES = np.array(list(PATTERNS.values()))
#: Residual correlations below this count as none.
UNRELATED = 0.05

# Insults and contempt.
LEXICON = (
    "bastard clown coward cretin damn despicable dimwit disgusting dumb dumbass failure filth filthy fool"
    " freak garbage gross hate idiot idiotic imbecile jerk kill loser lunatic moron moronic nasty pathetic"
    " pig scum shut stupid sucker trash ugly useless vermin vile worthless wretch"
).split()


def mined_voters(y: np.ndarray, x: list[np.ndarray], fixed: np.ndarray, most: int = MINED, covers: int = COVERS) -> np.ndarray:
    """Slots that are far more frequent in documents labelled toxic, each for some on which fewer than ``covers`` voters fire.

    Eight of nine documents with the slot are toxic, not counting those that have their voters.
    Words of one group of copies all occur in the same documents; voters from all of them would outnumber the others.
    """
    n0 = np.zeros(SLOTS)
    for label, row in zip(y, x, strict=True):
        if not label:
            n0[row] += 1
    toxic = [row for label, row in zip(y, x, strict=True) if label]
    doc = np.repeat(np.arange(len(toxic), dtype=np.int32), [len(row) for row in toxic])
    slot = np.concatenate([np.zeros(0, np.int32), *toxic])
    t1, t0 = max(len(toxic), 1), max(len(y) - len(toxic), 1)
    n1 = np.bincount(slot, minlength=SLOTS)
    # Slots that may come to be chosen; what follows holds these alone.
    some = np.flatnonzero(n1 >= 3)
    p0, p1 = (n0[some] + 0.5) / (t0 + 1), (n1[some] + 0.5) / (t1 + 1)
    told = p1 > 8 * p0
    some, gain = some[told], np.log(p1[told] / p0[told])
    if not len(some):
        return np.array([], np.int64)
    n0, place = n0[some], np.searchsorted(some, slot).astype(np.int32)
    own = some[np.minimum(place, len(some) - 1)] == slot
    doc, place = doc[own], place[own]
    covered, chosen = np.array([np.isin(fixed, row).sum() for row in toxic], np.int64), []
    free = ~np.isin(some, fixed)
    while len(chosen) < most:
        n1 = np.bincount(place[covered[doc] < covers], minlength=len(some))
        worth = np.where(free & (n1 >= 3) & (n1 > 8 * n0), n1 * gain, 0)
        best = int(worth.argmax())
        if not worth[best]:
            break
        chosen.append(some[best])
        free[best] = False
        covered[doc[place == best]] += 1
    return np.array(chosen, np.int64)


def voters(y: np.ndarray, x: list[np.ndarray]) -> np.ndarray:
    """The slots that vote: words in order, then the patterns of tone.  One more voter is the silence of all words."""
    fixed = np.array([word_slot(w) for w in LEXICON])
    # Words that labels say are harmless here don't vote, or those that share the slot of a harmless one.
    fires = np.array([np.isin(fixed, row) for row in x]).reshape(len(x), len(fixed))
    n1, n0 = fires[y > 0].sum(0), fires[y == 0].sum(0)
    fixed = fixed[(n1 > 8 * n0) | (n0 < 3)]
    words = np.unique(np.concatenate([fixed, mined_voters(y, x, fixed)]))
    return np.append(words[~np.isin(words, TONES)], TONES)


def votes(x: list[np.ndarray], slots: np.ndarray) -> np.ndarray:
    """A row for each document: 1 for the voters that fire, else 0; the last is silence."""
    out = np.zeros((len(x), len(slots) + 1))
    for i, row in enumerate(x):
        out[i, :-1] = np.isin(slots, row, assume_unique=True)
    out[:, -1] = ~out[:, : len(slots) - len(TONES)].any(1)
    return out


def vote_parts(x: list[np.ndarray], slots: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Where a part of the documents starts, and its votes."""
    for at in range(0, len(x), ROWS_AT_ONCE):
        yield at, votes(x[at : at + ROWS_AT_ONCE], slots)


def patterns(docs: DataFrame, slots: np.ndarray) -> DataFrame:
    """fired (numbers of the voters that fire, two bytes each) and n, the documents they fire on."""

    order = np.argsort(slots)
    ranked, words = slots[order], len(slots) - len(TONES)

    def fire(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, some in chunks(batch.column("text").to_pylist()):
                doc, found = toxic_slots(some)
                place = np.minimum(np.searchsorted(ranked, found), len(slots) - 1)
                own = ranked[place] == found
                doc, place = doc[own], order[place[own]]
                silent = np.flatnonzero(np.bincount(doc[place < words], minlength=len(some)) == 0)
                doc, place = np.append(doc, silent), np.append(place, np.full(len(silent), len(slots)))
                by = np.lexsort((place, doc))
                cuts = np.searchsorted(doc[by], np.arange(1, len(some)))
                out += [p.tobytes() for p in np.split(place[by].astype(np.uint16), cuts)]
            yield pa.record_batch([pa.array(out, pa.binary())], names=["fired"])

    return docs.select("text").mapInArrow(fire, "fired binary").groupBy("fired").agg(F.count("*").alias("n"))


@dataclass
class LabelModel:
    """Chance of the toxic class, and of each voter to fire in it (row 0) and in the other; residual correlations."""

    prior: float
    chance: np.ndarray
    alike: np.ndarray

    def posterior(self, v: np.ndarray) -> np.ndarray:
        evidence = np.log(self.chance[0]) - np.log(self.chance[1])
        odds = np.log(self.prior / (1 - self.prior)) + (v / (1 + v @ self.alike)) @ evidence
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def moments(v: np.ndarray, n: np.ndarray, model: LabelModel) -> np.ndarray:
    """For each class the products of voters (and of a last column of ones), summed by documents and posterior."""
    ones = np.hstack([v, np.ones((len(v), 1))])
    toxic = np.rint(model.posterior(v) * STEPS)
    return np.stack([ones.T @ (ones * (n * w)[:, None]) for w in (toxic, STEPS - toxic)])


def summed_moments(counted: DataFrame, model: LabelModel) -> np.ndarray:
    """The moments over all patterns; as many numbers as pairs of voters come to the driver."""
    size = len(model.alike)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size + 1, size + 1), np.int64)
        for batch in batches:
            fired, n = batch.column("fired").to_pylist(), batch.column("n").to_numpy()
            for at in range(0, len(fired), 4096):
                some = fired[at : at + 4096]
                v = np.zeros((len(some), size))
                v[np.repeat(np.arange(len(some)), [len(f) // 2 for f in some]), np.frombuffer(b"".join(some), np.uint16)] = 1
                total += moments(v, n[at : at + 4096], model).astype(np.int64)
        kind, i, j = np.nonzero(np.triu(total))
        yield pa.record_batch(
            [pa.array(kind, pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[kind, i, j])],
            names=["kind", "i", "j", "n"],
        )

    rows = counted.mapInArrow(partial, "kind int, i int, j int, n long")
    found = rows.groupBy("kind", "i", "j").agg(F.sum("n").alias("n")).toArrow()
    kind, i, j, n = (found[c].to_numpy() for c in ("kind", "i", "j", "n"))
    out = np.zeros((2, size + 1, size + 1))
    out[kind, i, j] = out[kind, j, i] = n
    return out / STEPS


def estimated(products: np.ndarray, smooth: float = 0.5) -> LabelModel:
    """The model that the moments give."""
    classes = products[:, -1, -1]
    fires = products[:, -1, :-1]
    chance = (fires + smooth) / (classes[:, None] + 2 * smooth)
    mean = fires / np.maximum(classes, 1e-9)[:, None]
    rest = products[:, :-1, :-1].sum(0) - sum(c * np.outer(m, m) for c, m in zip(classes, mean, strict=True))
    spread = np.sqrt(np.maximum(np.diag(rest), 1e-9))
    alike = np.clip(rest / np.outer(spread, spread), 0, 1)
    np.fill_diagonal(alike, 0)
    alike[alike < max(UNRELATED, 4 / np.sqrt(max(classes.sum(), 1)))] = 0  # what chance alone brings about
    return LabelModel((classes[0] + 1) / (classes.sum() + 2), chance, alike)


def labelled_products(y: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The moments of labelled documents, by their labels."""
    ones = np.hstack([v, np.ones((len(v), 1))])
    return np.stack([ones[y == label].T @ ones[y == label] for label in (1, 0)])


def first_model(y: np.ndarray, v: np.ndarray) -> LabelModel:
    """Where the rounds start: the model of labelled documents, which tells the classes apart."""
    return estimated(labelled_products(y, v))


def first_model_of(y: np.ndarray, x: list[np.ndarray], slots: np.ndarray) -> LabelModel:
    """The same from features, part by part."""
    parts = (labelled_products(y[at : at + len(v)], v) for at, v in vote_parts(x, slots))
    return estimated(sum(parts, np.zeros((2, len(slots) + 2, len(slots) + 2))))


def posteriors(model: LabelModel, x: list[np.ndarray], slots: np.ndarray) -> np.ndarray:
    """The chance of the toxic class for each document."""
    return np.concatenate([np.zeros(0), *(model.posterior(v) for _, v in vote_parts(x, slots))])


def label_model(counted: DataFrame, model: LabelModel, rounds: int = 12) -> LabelModel:
    """The model that explains the patterns of all documents, by expectation maximisation."""
    for _ in range(rounds):
        new = estimated(summed_moments(counted, model))
        done = np.abs(new.chance - model.chance).max() < 1e-3 and abs(new.prior - model.prior) < 1e-4
        model = new
        if done:
            break
    return model


def train(
    post: np.ndarray, x: list[np.ndarray], epochs: int = 12, rate: float = 0.1, decay: float = 1e-4, least: float = 4.0
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model of the posterior labels, by adaptive gradient steps.

    Features take part whose shares in the classes are ``least`` standard deviations apart.
    """
    seen, bad = np.zeros(SLOTS), np.zeros(SLOTS)
    for p, row in zip(post, x, strict=True):
        seen[row] += 1
        bad[row] += p
    t1, t0 = max(post.sum(), 1), max(len(post) - post.sum(), 1)
    some = np.flatnonzero(seen >= 3)
    seen, bad = seen[some], bad[some]
    share = seen / len(post)
    spread = np.sqrt(share * (1 - share) * (1 / t1 + 1 / t0)) + 1e-12
    told = np.zeros(SLOTS, bool)
    told[some] = np.abs(bad / t1 - (seen - bad) / t0) > least * spread
    rows = [row[told[row]] for row in x]
    w, sums = np.zeros(SLOTS), np.full(SLOTS, 1e-2)
    bias, bias_sum = 0.0, 1e-2
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            row = rows[i]
            p = 1 / (1 + np.exp(-np.clip(w[row].sum() + bias, -30, 30)))
            slope = p - post[i]
            g = slope + decay * w[row]
            sums[row] += g * g
            w[row] -= rate * g / np.sqrt(sums[row])
            bias_sum += slope * slope
            bias -= rate * slope / np.sqrt(bias_sum)
    return w, bias


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> tuple[np.ndarray, float, float, float]:
    """Weights by slot, bias, and slope and offset of the logistic; labels of held-out documents aren't used."""
    bounded_batches(docs.sparkSession)
    open_ids = bucket(F.col("doc_id"), 5) != 0
    y, x = labelled_sample(docs, labels.where(open_ids), "toxic", rows, toxic_slots)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 0.2) / (len(y) + 2)
        return np.zeros(SLOTS), 0.0, 0.0, float(np.log(share / (1 - share)))
    slots = voters(y, x)
    model = label_model(keep(patterns(docs, slots), "patterns"), first_model_of(y, x, slots))
    anyone = docs.where(open_ids).select("doc_id", F.lit(0).alias("drawn"))
    _, own = labelled_sample(docs, anyone, "drawn", rows, toxic_slots)
    w, bias = train(posteriors(model, own, slots), own)
    slope, offset = calibration(np.array([w[row].sum() for row in x]) + bias, y)
    return w, bias, slope, offset


def toxicity_scores(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out documents aren't used."""
    out = scored(docs, *fit(docs, labels, rows), toxic_slots, ["doc_id"])
    return out.select(
        "doc_id",
        F.coalesce(bucket(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = ROWS, limit: float = 0.5) -> DataFrame:
    """The documents whose score is below the limit, with all their columns."""
    name = "score"
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    return scored(docs, *fit(docs, labels, rows), toxic_slots, docs.columns, name).where(F.col(name) < limit).drop(name)
