"""Exact top-k search by inner product: elimination with a table of distances to pivots.

For a query q, a candidate x and pivots p the triangle inequality gives
|q - x| >= max over p of ||q - p| - |x - p||, and q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2, so that each
candidate has an upper bound of its score.  A query takes candidates by falling bound and
stops where the bound is below its k-th score so far: what comes after can't be better.

Queries are taken in blocks of bounded size; each block is sent to all tasks, which hold all other
rows in batches, with their distances to the pivots, which are computed once and stored.  A task returns k rows a query, and the
best of those are ranked.  Pivots are chosen from a bounded sample, far from each other; they only steer what is evaluated, never the
result.  How much they eliminate depends on the vectors: nearly all among clusters, a few percent among directions without order.

Defined results: vectors that are null, empty or hold null or non-finite components, and those without
id, take no part.  Components are floor(256 x); sums beyond 2^53 are computed with whole numbers and end at the
limits of a long.  Of rows that share a query's id the smallest vector is the query and none is its candidate;
other rows that share an id are candidates each, equal rows one after another.  Of two lengths the shorter vector counts as filled up with
zeros.  Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from accordance.llm.tables import keep

#: Vectors among which pivots are chosen, pivots, and queries of one block: bounds of what tasks get.
SAMPLE, PIVOTS, BLOCK = 2048, 64, 2048
#: Candidates that are scored at once, at first and at most.
FIRST, MOST = 64, 4096
EXACT, LIMIT = 2.0**53, 2**63 - 1
HITS = "query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, scale: int = 256, also: Sequence[str] = ()) -> DataFrame:
    """vec_id and the components as whole doubles, with other columns, of the vectors that take part."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("double"))
    return vectors.where(F.col("vec_id").isNotNull() & (F.size(x) > 0) & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), *also, whole.alias("x")
    )


def _matrix(column: pa.ListArray, width: int = 0) -> np.ndarray:
    """The vectors as rows, filled up with zeros to the longest."""
    sizes = np.diff(column.offsets.to_numpy())
    values = np.asarray(column.flatten())
    width = max(width, int(sizes.max(initial=0)))
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def choose_pivots(x: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Rows far from those chosen before, starting with the one farthest from the mean."""
    if not len(x):
        return x
    far = np.linalg.norm(x - x.mean(0), axis=1)
    chosen = []
    for _ in range(min(count, len(x))):
        chosen.append(int(far.argmax()))
        far = np.minimum(far if len(chosen) > 1 else np.inf, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return x[chosen]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    width = max(x.shape[1], pivots.shape[1])
    x, pivots = _wide(x, width), _wide(pivots, width)
    return np.stack([np.sqrt(((x - p) ** 2).sum(1)) for p in pivots], 1)


def _scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whole inner products, ended at the limits of a long."""
    if max(x.max(initial=0), -x.min(initial=0)) * np.abs(q).sum() < EXACT:
        return (x @ q).astype(np.int64)
    whole = [int(v) for v in q]
    scores = (sum(int(a) * b for a, b in zip(row, whole, strict=True)) for row in x.tolist())
    return np.array([max(-LIMIT - 1, min(LIMIT, s)) for s in scores], np.int64)


def best_of_batch(
    best: list[tuple[int, int]], q_id: int, q: np.ndarray, q_far: np.ndarray,
    ids: np.ndarray, x: np.ndarray, squares: np.ndarray, far: np.ndarray, k: int,
) -> list[tuple[int, int]]:
    """The k best (-score, vec_id) so far with those of a batch, taken by falling bound; far has a row for each pivot."""
    apart, one = np.zeros(len(ids)), np.empty(len(ids))
    for of_pivot, own_far in zip(far, q_far.tolist(), strict=True):
        np.subtract(of_pivot, own_far, out=one)
        np.abs(one, out=one)
        np.maximum(apart, one, out=apart)
    own = q @ q
    bound = (own + squares - apart * apart) / 2
    bound += 1e-9 * (own + squares) + 1  # what rounding of the distances can take away
    least = -best[k - 1][0] if len(best) == k else -np.inf
    left = np.flatnonzero((bound >= least) & (ids != q_id))
    left = left[np.argsort(-bound[left], kind="stable")]
    at, size = 0, FIRST
    while at < len(left):
        some = left[at : at + size]
        at, size = at + size, min(4 * size, MOST)
        if len(best) == k:
            least = -best[k - 1][0]
            some = some[bound[some] >= least]
            if not len(some):
                break
        scores = _scores(x[some], q)
        if len(best) == k:
            own_best = np.flatnonzero(scores >= least)
        else:
            own_best = np.arange(len(some))
        if len(own_best) > k:
            own_best = own_best[np.lexsort([ids[some[own_best]], ~scores[own_best]])[:k]]
        found = zip((-int(s) for s in scores[own_best].tolist()), ids[some[own_best]].tolist(), strict=True)
        best = sorted([*best, *found])[:k]
    return best


def with_distances(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Vectors with their distances to the pivots."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = _distances(_matrix(batch.column("x")), pivots)
                offsets = np.arange(0, far.size + 1, far.shape[1], dtype=np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(far.ravel()))
                yield pa.record_batch([*batch.columns, column], names=["vec_id", "x", "far"])

    return vectors.select("vec_id", "x").mapInArrow(of_task, "vec_id long, x array<double>, far array<double>")


def _search(vectors: DataFrame, queries: pa.Table, pivots: np.ndarray, k: int) -> DataFrame:
    q_ids = queries["vec_id"].to_pylist()
    q = _matrix(queries["x"].combine_chunks())
    q_far = _distances(q, pivots)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in q_ids]
        own = q
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            x = _matrix(batch.column("x"))
            own = _wide(q, x.shape[1])
            x = _wide(x, own.shape[1])
            squares, far = (x * x).sum(1), np.ascontiguousarray(_matrix(batch.column("far")).T)
            for n, q_id in enumerate(q_ids):
                best[n] = best_of_batch(best[n], q_id, own[n], q_far[n], ids, x, squares, far, k)
        rows = [(q_id, i, -s) for q_id, found in zip(q_ids, best, strict=True) for s, i in found]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.record_batch(
            [pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"]
        )

    return vectors.mapInArrow(of_task, HITS)


def top_k(vectors: DataFrame, is_query, k: int = 5, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row that is_query holds for."""
    spark = vectors.sparkSession
    rows = keep(whole_vectors(vectors), "vectors")
    queries = keep(rows.where(is_query).groupBy("vec_id").agg(F.min("x").alias("x")), "queries")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("x").toArrow()
    pivots = choose_pivots(_matrix(sample["x"].combine_chunks()))
    rows = keep(with_distances(rows, pivots), "distances")
    blocks = -(-queries.count() // block)
    found = spark.createDataFrame([], HITS)
    for n in range(blocks):
        some = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == n).toArrow()
        if some.num_rows:
            found = found.unionByName(_search(rows, some, pivots, k))
        if n % 16 == 15:
            found = keep(found, "hits")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
