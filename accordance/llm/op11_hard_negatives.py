"""Hard negatives by threshold joins over an inverted index with suffix-norm bounds (in the manner of L2AP).

Anchors are taken in blocks of bounded size; each block is sent to all tasks, which hold all rows in batches.  A batch is
indexed for the thresholds at hand: the first dimensions of a row are left out of its posting lists as long as their norm
alone can't lift any anchor to its threshold.  Postings are gone through from the last dimension to the first; partial scores
are accumulated, and a pair is dropped once its partial score and the norms of what remains stay below the threshold.
What survives is scored in full.  Thresholds start high and are lowered, for the anchors whose windows are not full,
until the windows fill or the floor is reached, so that nothing is missed.

The join is used twice: for the best rows of an anchor's label (its positives), and for the best rows of other labels
whose score lies in the window that each positive opens.  A task returns as many rows a window as are asked for.

Defined results: rows with a null id or label, or a vector that is null, empty or holds null or non-finite components, take
no part.  Components are floor(256 x); sums beyond 2^53 are computed with whole numbers and end at the limits of a
long.  Of two lengths the shorter vector counts as filled up with zeros.  Of rows that share an anchor's id the smallest vector
is the anchor and none is its candidate; other rows that share an id are candidates each, equal rows one after another.
Extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accordance.llm.op10_pivots import EXACT, LIMIT, _matrix, _wide, whole_vectors
from accordance.llm.tables import keep

#: Anchors of one block, and the sides of a tile of partial scores: bounds of memory, not of results.
BLOCK, ANCHORS, ROWS = 2048, 256, 4096
#: Dimensions whose postings are added at once.
STEP = 8
#: What the first thresholds are, as shares of the highest score there could be.
LEVELS = (0.6, 0.4, 0.25, 0.1)
POSITIVES = "anchor_id long, positive_id long, positive_score long"
NEGATIVES = "anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long"


class Postings:
    """The rows of a batch, by dimension, for thresholds of at least ``least`` times the anchor's norm."""

    def __init__(self, x: np.ndarray, least: float):
        norms = np.sqrt(np.cumsum(x * x, 1))
        omitted = (norms * (1 + 1e-9) < least).sum(1)
        self.rows = np.argsort(omitted, kind="stable")
        self.first = omitted[self.rows]  # ascending: the postings of a dimension are the first rows
        self.rows = self.rows[: np.searchsorted(self.first, x.shape[1])]  # the others have no posting at all
        self.first = self.first[: len(self.rows)]
        self.norms = np.hstack([np.zeros((len(self.rows), 1)), norms[self.rows]])
        self.x = np.where(np.arange(x.shape[1]) >= self.first[:, None], x[self.rows], 0)

    def candidates(self, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Anchors and rows of the pairs that may reach the anchor's threshold."""
        width = q.shape[1]
        q_norms = np.hstack([np.zeros((len(q), 1)), np.sqrt(np.cumsum(q * q, 1))])
        most = self.norms[:, -1].max(initial=0)
        least = (least - 1e-9 * q_norms[:, -1] * most - 1)[:, None]
        x, first, norms, rows = self.x, self.first, self.norms, self.rows
        sums = np.zeros((len(q), len(rows)))
        alive = np.ones(sums.shape, bool)
        for high in range(width, 0, -STEP):
            low = max(0, high - STEP)
            n = np.searchsorted(first, high)
            sums[:, :n] += q[:, low:high] @ x[:n, low:high].T
            rest = np.maximum(first, low)
            alive = sums + q_norms[:, rest] * norms[np.arange(len(rows)), rest] >= least
            some = alive.any(0)
            if some.sum() < 0.7 * len(rows):
                x, first, norms, rows, sums, alive = x[some], first[some], norms[some], rows[some], sums[:, some], alive[:, some]
            if not len(rows):
                break
        at, row = np.nonzero(alive)
        return at, rows[row]


def pair_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whole inner products of rows side by side, ended at the limits of a long."""
    if (np.abs(q) * np.abs(x)).sum(1).max(initial=0) < EXACT:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    whole = [sum(int(a) * int(b) for a, b in zip(v, w, strict=True)) for v, w in zip(q.tolist(), x.tolist(), strict=True)]
    return np.array([max(-LIMIT - 1, min(LIMIT, s)) for s in whole], np.int64)


def join(q: np.ndarray, least: np.ndarray, x: np.ndarray, below: np.ndarray | None = None):
    """Anchor, row and score of all pairs that reach the anchor's threshold (and stay below another one)."""
    norms = np.maximum(np.sqrt((q * q).sum(1)), 1e-300)
    found = []
    for low in range(0, len(x), ROWS):
        part = x[low : low + ROWS]
        postings = Postings(part, (least / norms).min(initial=np.inf))
        for start in range(0, len(q), ANCHORS):
            at, row = postings.candidates(q[start : start + ANCHORS], least[start : start + ANCHORS])
            for n in range(0, len(at), 1 << 16):
                a, r = at[n : n + (1 << 16)] + start, row[n : n + (1 << 16)]
                score = pair_scores(q[a], part[r])
                own = score >= least[a]
                if below is not None:
                    own &= score < below[a]
                found.append((a[own], r[own] + low, score[own]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True))


class Windows:
    """The first rows, by falling score and rising id, of score windows; several may belong to one anchor."""

    def __init__(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, size: int):
        self.anchor, self.low, self.high, self.size = anchor, low, high, size
        self.window = self.score = self.id = np.zeros(0, np.int64)

    def add(self, at: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        first = np.searchsorted(self.anchor, at)
        count = np.searchsorted(self.anchor, at, side="right") - first
        pair = np.repeat(np.arange(len(at)), count)
        window = np.repeat(first, count) + np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
        own = (score[pair] >= self.low[window]) & (score[pair] <= self.high[window])
        window = np.concatenate([self.window, window[own]])
        score = np.concatenate([self.score, score[pair[own]]])
        ids = np.concatenate([self.id, ids[pair[own]]])
        order = np.lexsort([ids, ~score, window])  # ~score falls as score rises, and does not overflow
        window = window[order]
        kept = np.arange(len(window)) - np.searchsorted(window, window) < self.size
        self.window, self.score, self.id = window[kept], score[order][kept], ids[order][kept]

    def open(self, anchors: int) -> np.ndarray:
        """The least score that still matters to an anchor: that of its last place, the floor if places are free."""
        least = self.low.astype(float)
        last = np.flatnonzero(np.bincount(self.window, minlength=len(least)) == self.size)
        ends = np.searchsorted(self.window, last, side="right") - 1
        least[last] = np.maximum(least[last], self.score[ends])
        out = np.full(anchors, np.inf)
        np.minimum.at(out, self.anchor, least)
        return out


def fill(windows: Windows, q: np.ndarray, ids: np.ndarray, x: np.ndarray, top: np.ndarray, allowed: Callable) -> None:
    """Puts the rows of a batch into the windows, by lowering thresholds."""
    below = np.full(len(q), np.inf)
    longest = np.sqrt((x * x).sum(1).max(initial=0))
    for level in (*LEVELS, -np.inf):
        least = windows.open(len(q))
        left = np.flatnonzero(least < below)  # what is at or above ``below`` has been seen
        if not len(left):
            break
        guess = np.minimum(top, np.sqrt((q * q).sum(1)) * longest)
        least = np.maximum(least, level * guess if np.isfinite(level) else -np.inf)
        at, row, score = join(q[left], least[left], x, below[left])
        own = allowed(left[at], row)
        windows.add(left[at][own], ids[row][own], score[own])
        below[left] = np.minimum(below[left], least[left])


def _batches(batches: Iterator[pa.RecordBatch], q: np.ndarray, order: np.ndarray):
    """id, label and vector of the rows, and the anchors as wide, their dimensions in the order of the index."""
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column("x"))
            own = _wide(q, x.shape[1])
            x = _wide(x, own.shape[1])
            dims = np.concatenate([np.arange(len(order), own.shape[1]), order])
            yield (
                batch.column("vec_id").to_numpy(zero_copy_only=False),
                batch.column("label").to_numpy(zero_copy_only=False),
                np.ascontiguousarray(x[:, dims]),
                np.ascontiguousarray(own[:, dims]),
            )


def positives(rows: DataFrame, anchors: pa.Table, count: int) -> DataFrame:
    """The best rows of each anchor's label, of each task."""
    a_ids, a_labels = (np.asarray(anchors[c].to_numpy()) for c in ("vec_id", "label"))
    q = _matrix(anchors["x"].combine_chunks())
    order = np.argsort((q * q).sum(0), kind="stable")  # heavy dimensions last: they are indexed

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.arange(len(q))
        windows = Windows(n, np.full(len(q), -LIMIT - 1), np.full(len(q), LIMIT), count)
        for ids, labels, x, own in _batches(batches, q, order):
            fill(windows, own, ids, x, np.full(len(q), np.inf), lambda a, r: (labels[r] == a_labels[a]) & (ids[r] != a_ids[a]))
        yield pa.record_batch([a_ids[windows.window], windows.id, windows.score], names=["anchor_id", "positive_id", "positive_score"])

    return rows.mapInArrow(of_task, POSITIVES)


def negatives(rows: DataFrame, anchors: pa.Table, found: dict[int, list[tuple[int, int]]], low: int, high: int, count: int) -> DataFrame:
    """The best rows of other labels in the window of each positive, of each task; bounds in percent."""
    a_ids, a_labels = (np.asarray(anchors[c].to_numpy()) for c in ("vec_id", "label"))
    q = _matrix(anchors["x"].combine_chunks())
    order = np.argsort((q * q).sum(0), kind="stable")
    opened = [(n, place, p, s) for n, a in enumerate(a_ids.tolist()) for place, (p, s) in enumerate(found.get(a, []))]
    # A window with its floor above its ceiling (a negative positive_score) is empty.
    opened = [(n, place, p, s, -((-low * s) // 100), high * s // 100) for n, place, p, s in opened if low * s <= high * s]
    anchor, place, p_ids, p_scores, floors, ceilings = (np.array(c, np.int64) for c in zip(*opened, strict=True)) if opened else [np.zeros(0, np.int64)] * 6
    top = np.full(len(q), -np.inf)
    np.maximum.at(top, anchor, ceilings.astype(float))

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(anchor, floors, ceilings, count)
        for ids, labels, x, own in _batches(batches, q, order):
            fill(windows, own, ids, x, top, lambda a, r: (labels[r] != a_labels[a]) & (ids[r] != a_ids[a]))
        w = windows.window
        columns = [a_ids[anchor[w]], place[w].astype(np.int32), p_ids[w], p_scores[w], windows.id, windows.score]
        yield pa.record_batch(columns, names=[c.split()[0] for c in NEGATIVES.split(", ")])

    return rows.mapInArrow(of_task, NEGATIVES)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column | str = "label",
    count: int = 10, of_label: int = 5, low: int = 30, high: int = 90, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of each anchor and positive."""
    spark = vectors.sparkSession
    labelled = vectors.withColumn("label", F.expr(label) if isinstance(label, str) else label)
    rows = keep(whole_vectors(labelled.where("label IS NOT NULL"), also=["label"]).withColumn("label", F.col("label").cast("long")), "vectors")
    anchors = keep(rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("x", "label")).alias("own")).select("vec_id", "own.*"), "anchors")
    blocks = -(-anchors.count() // block)
    out = spark.createDataFrame([], NEGATIVES)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    for n in range(blocks):
        some = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == n).toArrow()
        if some.num_rows:
            # At most of_label rows an anchor of the block.
            first = positives(rows, some, of_label).withColumn("place", F.row_number().over(best)).where(F.col("place") <= of_label)
            found: dict[int, list[tuple[int, int]]] = {}
            for r in sorted(first.collect(), key=lambda r: (r.anchor_id, r.place)):
                found.setdefault(r.anchor_id, []).append((r.positive_id, r.positive_score))
            out = out.unionByName(negatives(rows, some, found, low, high, count))
        if n % 16 == 15:
            out = keep(out, "negatives")
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (
        out.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= count)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
