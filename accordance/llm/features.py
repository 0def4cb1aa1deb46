"""Hashed indicator features of texts, and the labelled samples that classifiers are fitted on.

A feature is a slot of 2^20; which word or n-gram it came from isn't kept, so a model has a fixed
size however many words the corpus has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordance.llm.tokens import MARK, chunks, mixed, runs

BITS = 20
SLOTS = 1 << BITS
#: Bytes of the beginnings of words.
PREFIX = 6
#: Texts of a chunk to the documents (places in the chunk) and slots of their features, each pair once.
Extract = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def _slots(kind: int, *parts: np.ndarray) -> np.ndarray:
    """A slot for each n-gram whose elements the parts have."""
    h = np.full(len(parts[0]), np.uint64(kind))
    for part in parts:
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + part)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def _once(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(np.concatenate([doc.astype(np.int64) << BITS | slots for doc, slots in found]))
    return both >> BITS, both & (SLOTS - 1)


def _pairs(kind: int, doc: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    near = np.flatnonzero(doc[1:] == doc[:-1])
    return doc[near], _slots(kind, values[near], values[near + 1])


def quality_slots(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words, pairs of words, shapes, pairs of shapes, and how often a word follows itself."""
    r = runs(texts, shapes=True)
    doc, words = r.words()
    same = np.zeros(len(words), np.uint64)
    same[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    same[2:] += same[2:] * same[1:-1]
    return _once(
        [
            (doc, _slots(1, words)), _pairs(2, doc, words), (r.doc, _slots(3, r.shape)),
            _pairs(4, r.doc, r.shape), (doc, _slots(5, same)),
        ]
    )


def word_slot(word: str) -> int:
    """The slot of a word among ``toxic_slots``."""
    return int(_slots(1, runs([word.encode()]).hash)[0])


PATTERNS = {name: int(_slots(9, np.array([n], np.uint64))[0]) for n, name in enumerate(("marks", "shouting", "addressed"))}
_YOU = np.concatenate([runs([w]).hash for w in (b"you", b"your", b"youre")])


def toxic_slots(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words, beginnings of words, and patterns of tone."""
    r = runs(texts, prefix=PREFIX, shapes=True)
    own = r.kind != MARK
    doc, words = r.doc[own], r.hash[own]
    found = [(doc, _slots(1, words)), (doc, _slots(2, r.prefix[own]))]
    n = np.bincount(doc, minlength=len(texts))
    exclaim = r.doc[(r.kind == MARK) & np.isin(r.hash, runs([b"!!", b"!!!", b"?!"]).hash)]
    caps = np.bincount(doc[r.shape[own] == 1], minlength=len(texts))
    tones = {
        "marks": np.unique(exclaim),
        "shouting": np.flatnonzero((2 * caps > n) & (n > 3)),
        "addressed": np.unique(doc[np.isin(words, _YOU)]),
    }
    found += [(at, np.full(len(at), PATTERNS[name])) for name, at in tones.items()]
    return _once(found)


def _lists(texts: list[str | None], slots: Extract) -> list[np.ndarray]:
    """The features of each text."""
    out: list[np.ndarray] = []
    for _, some in chunks(texts):
        doc, found = slots(some)
        out += np.split(found.astype(np.int32), np.searchsorted(doc, np.arange(1, len(some))))
    return out


def bucket(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(of))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, slots: Extract
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels (0 or 1) and features of at most ``rows`` labelled documents, those with the smallest hashed ids.

    Of several labels of a document the largest counts; null labels and ids don't.  Of several rows of a
    document that with the least hash of its text is taken.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # One row of an id, so at most ``rows`` rows.
    found = (
        docs.select("doc_id", "text")
        .join(F.broadcast(known), "doc_id")
        .groupBy("doc_id", "y")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = _lists(batch.column("text").to_pylist(), slots)
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            x = pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int32), *lists]))
            yield pa.record_batch([batch.column("doc_id"), batch.column("y"), x], names=["doc_id", "y", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    taken = found.select("doc_id", "text", "y").mapInArrow(extract, f"doc_id {kind}, y int, x array<int>").toArrow()
    taken = taken.sort_by("doc_id")
    pa.default_memory_pool().release_unused()
    x = taken["x"].combine_chunks() if taken.num_rows else pa.array([], pa.list_(pa.int32()))
    values, ends = np.asarray(x.flatten()), x.offsets.to_numpy()
    lists = [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return np.asarray(taken["y"]), lists


def scored(
    docs: DataFrame, weights: np.ndarray, bias: float, slope: float, offset: float, slots: Extract,
    columns: list[str], name: str = "score",
) -> DataFrame:
    """These columns and the score of each text: the logistic of slope * (its weights + bias) + offset."""
    weights = weights.astype(np.float32)
    # A text that is returned goes to the tasks once.
    text = columns.index("text") if "text" in columns else len(columns)
    more = [] if "text" in columns else [F.col("text").alias(f"{name}_text")]
    rows = docs.select(*[F.col(f"`{c}`") for c in columns], *more)
    schema = rows.schema[: len(columns)].add(name, "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = np.zeros(batch.num_rows)
            for start, some in chunks(batch.columns[text].to_pylist()):
                doc, found = slots(some)
                margins[start : start + len(some)] = np.bincount(doc, weights[found], len(some))
            scores = 1 / (1 + np.exp(-np.clip(slope * (margins + bias) + offset, -50, 50)))
            yield pa.record_batch([*batch.columns[: len(columns)], pa.array(scores)], names=[*columns, name])

    return rows.mapInArrow(score, schema)


def calibration(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic that fits the labels best (Platt), by Newton's method."""
    scale = max(float(np.abs(margins).mean()), 1e-9) if len(margins) else 1.0
    m, a, b = margins / scale, 1.0, 0.0
    p1, p0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (p1 + 1) / (p1 + 2), 1 / (p0 + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -50, 50)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - t) * m).sum() + 1e-3 * (a - 1), (p - t).sum()])
        h = np.array([[(w * m * m).sum() + 1e-3, (w * m).sum()], [(w * m).sum(), w.sum()]])
        step = np.linalg.solve(h + 1e-9 * np.eye(2), g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 1e-6) / scale, b
