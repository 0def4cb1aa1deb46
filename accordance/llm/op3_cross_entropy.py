"""LM scoring: cross-entropy difference of a target and a background model.

Both are models of pairs of words over one vocabulary, all words of the documents (as 64-bit hashes).  Words,
pairs and their contexts are counted over all documents and all target documents, and every pair counts, with absolute
discounting: what a context's pairs lose goes to single words, so that each context's chances add up to one.
A document's score is its loss per word under the target model less that under the background model: the lower, the
closer to the target.

The counts of words and pairs are written tables until the chances of pairs are one.  Tasks send the counts of pairs on in
parts, each one binary value of sorted keys as steps, which takes a quarter of the shuffle that rows take.  Frequent words have numbers, and the chances of frequent pairs go to all
tasks (the ``LOOKED_UP`` most frequent of each); a document's other pairs are joined with their chances.  How a pair is looked up
does not change its chance.  Pairs that occur once in all and never in the target are not joined: they are those not found.

Texts are gone through in pieces, long ones too.
Defined results: a null or empty text has no words, and its losses and score are 0.  Repeated rows are scored and counted each.
Without target documents the target model knows no pairs and all words alike.  Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordance.llm.tables import bounded_batches, new_path
from accordance.llm.tokens import chunks, mixed, runs
from accordance.plans.workspace import remove_folder

#: Words and pairs that tasks look up in memory; the others are joined, with the same result.
LOOKED_UP = 1 << 20
#: Bits of a word's number in a pair's key, and the most frequent words, whose pairs are dealt out by the pair.
BITS, TOP = 21, 1 << 12
DISCOUNT, ADDED = 0.75, 0.5
#: Distinct words or pairs of chunks that a task holds before it sends their counts on.
HELD = 1 << 20
#: Parts that pairs are dealt to, whole contexts or pairs of top words, and rows that a task adds up at once.
PARTS, MERGED = 1 << 12, 1 << 18
START = 0  # the number before the first word; frequent words have numbers from 1 on


def _counted(docs: DataFrame, of_chunk, counts: str) -> DataFrame:
    """Values and how often they occur, summed over a task's share as far as it fits its memory."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, some in chunks(batch.column("text").to_pylist()):
                values, n = np.unique(of_chunk(some), return_counts=True)
                held.append((values, n))
                size += len(values)
                if size >= HELD:
                    yield _counts(held, counts)
                    held, size = [], 0
        if held:
            yield _counts(held, counts)

    return docs.select("text").mapInArrow(count, f"value long, {counts} long")


def _counts(held: list[tuple[np.ndarray, np.ndarray]], name: str) -> pa.RecordBatch:
    value, n = (np.concatenate(x) for x in zip(*held, strict=True))
    first, order, sums = _added(value, n)
    return pa.record_batch([pa.array(value[order][first]), pa.array(sums)], names=["value", name])


def _added(value: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the values, the first place of each distinct one in it, and the sums of n."""
    order = np.argsort(value)
    value = value[order]
    first = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
    sums = np.add.reduceat(n[order], first) if len(first) else n
    return first, order, sums.astype(np.int64)


def _words(texts: list[bytes]) -> np.ndarray:
    return runs(texts).words()[1].view(np.int64)


def _most(counts: DataFrame, weight: Column, tie: str) -> DataFrame:
    """The rows of highest weight, LOOKED_UP at most: whole classes of one weight, or a part of the highest class."""
    most = 1 << 16
    steps = counts.groupBy(F.least(weight, F.lit(most)).alias("n")).count().orderBy(F.desc("n")).collect()
    least, held = most + 1, 0
    for row in steps:  # at most 2^16
        held += row["count"]
        if held > LOOKED_UP:
            break
        least = row["n"]
    if least > most:
        return counts.where(weight >= most).orderBy(weight.desc(), tie).limit(LOOKED_UP)
    return counts.where(weight >= least)


@dataclass
class Known:
    """What tasks look up: frequent words by hash, their counts by number, and chances of frequent pairs."""

    hashes: np.ndarray
    numbers: np.ndarray
    context: np.ndarray | None = None  # by number: rows of own and all, distinct pairs of own and all
    single: np.ndarray | None = None  # by number: own and all
    words: int = 0  # of the whole vocabulary
    total: tuple[int, int] = (0, 0)
    keys: np.ndarray | None = None
    chances: np.ndarray | None = None

    def pairs_of(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """doc, key, word before and word of each word.

        A word is its number or a negative hash; a key holds two numbers or is a negative hash, other than that of a word.
        """
        doc, hashes = runs(texts).words()
        word = _negative(hashes, 2)
        if len(self.hashes):
            at, known = _found(self.hashes, hashes.view(np.int64))
            word = np.where(known, self.numbers[at].astype(np.int64), word)
        before = np.empty_like(word)
        before[1:] = word[:-1]
        first = np.ones(len(word), bool)
        first[1:] = doc[1:] != doc[:-1]
        before[first] = START
        both = mixed(before.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + word.view(np.uint64))
        key = np.where((before >= 0) & (word >= 0), (before << BITS) | word, _negative(both, 3))
        return doc, key, before, word

    def log_chances(self, own, both, context, single) -> list[np.ndarray]:
        """Log chances of pairs with these counts under the target and the background model."""
        out = []
        for k, n in enumerate((own, both)):
            rows = np.maximum(context[k], 1)
            rest = np.where(context[k] > 0, DISCOUNT * context[k + 2] / rows, 1.0)
            p = (single[k] + ADDED) / (self.total[k] + ADDED * (self.words + 1))
            out.append(np.log(np.maximum(n - DISCOUNT, 0) / rows + rest * p))
        return out

    def of_keys(self, key, own, both) -> list[np.ndarray]:
        before, word = key >> BITS, key & ((1 << BITS) - 1)
        return self.log_chances(own, both, self.context[:, before], self.single[:, word])


def _negative(hashes: np.ndarray, mark: int) -> np.ndarray:
    return ((hashes >> np.uint64(2)) | np.uint64(mark << 62)).view(np.int64)


#: The words of a pair, as SQL.
BEFORE, AFTER = f"coalesce(before, shiftright(key, {BITS}))", f"coalesce(word, key & {(1 << BITS) - 1})"
COUNTS = ("own", "all")
CONTEXT = ("rows_own", "rows_all", "pairs_own", "pairs_all")


def _written(df: DataFrame, path: str) -> DataFrame:
    """The rows written at a path and read back; what was shuffled for them goes at once."""
    spark, name = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        df.write.parquet(path, compression="zstd")
    finally:
        spark.conf.set(name, before)
    return spark.read.schema(df.schema).parquet(path)


PACKED = "part int, n int, pairs binary"


def packed(key: np.ndarray, before: np.ndarray, word: np.ndarray, own: np.ndarray, both: np.ndarray) -> pa.RecordBatch:
    """Pairs in ascending order of their key, at least one, as a row for each part.

    A row's value has the steps between keys and the counts, byte by byte (all first bytes, all second bytes and so on), then
    both words of the pairs whose key is a negative hash, which come first.
    """
    place = np.where((before >= 0) & (before <= TOP), key, before)
    part = (mixed(place.view(np.uint64)) & np.uint64(PARTS - 1)).astype(np.uint16)
    order = np.argsort(part, kind="stable")
    part, key = part[order], key[order].view(np.uint64)
    new = np.append(True, part[1:] != part[:-1])
    steps = np.append(key[:1], key[1:] - key[:-1])
    steps[new] = key[new]
    columns = np.stack([steps, own[order].view(np.uint64), both[order].view(np.uint64)], 1).astype("<u8").view(np.uint8)
    words = np.stack([before[order], word[order]], 1).astype("<i8").view(np.uint8)
    first = np.flatnonzero(new)
    ends = np.append(first[1:], len(part))
    hashed = np.add.reduceat(key >> np.uint64(63), first).astype(np.int64)
    values = [
        columns[a:b].T.tobytes() + words[a : a + h].tobytes()
        for a, b, h in zip(first.tolist(), ends.tolist(), hashed.tolist(), strict=True)
    ]
    parts = [pa.array(part[first], pa.int32()), pa.array(ends - first, pa.int32()), pa.array(values, pa.binary())]
    return pa.record_batch(parts, names=["part", "n", "pairs"])


def unpacked(n: int, value: bytes) -> tuple[np.ndarray, ...]:
    """key, own, all, and the words before and words of the pairs with a negative key, which come first."""
    columns = np.ascontiguousarray(np.frombuffer(value, np.uint8, 24 * n).reshape(24, n).T).view("<u8")
    words = np.frombuffer(value, "<i8", offset=24 * n).reshape(-1, 2)
    key = np.cumsum(columns[:, 0], dtype=np.uint64).view(np.int64)
    return key, columns[:, 1].view(np.int64), columns[:, 2].view(np.int64), words[:, 0], words[:, 1]


def _merged(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """The distinct pairs of whole parts."""
    key, own, both, before, word = (np.concatenate(x) for x in zip(*held, strict=True))
    hashed, (before_hashed, word_hashed) = np.flatnonzero(key < 0), (before, word)
    before, word = np.zeros_like(key), np.zeros_like(key)
    before[hashed], word[hashed] = before_hashed, word_hashed
    first, order, own = _added(key, own)
    both = np.add.reduceat(both[order], first)
    at = order[first]
    key = key[at]
    parts = [pa.array(key), *(pa.array(x[at], mask=key >= 0) for x in (before, word)), pa.array(own), pa.array(both)]
    return pa.record_batch(parts, names=["key", "before", "word", *COUNTS])


def _of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size, last = [], 0, None
    for batch in batches:
        for part, n, value in zip(batch.column("part").to_pylist(), batch.column("n").to_pylist(), batch.column("pairs"), strict=True):
            if part != last and size >= MERGED:
                yield _merged(held)
                held, size = [], 0
            last = part
            held.append(unpacked(n, value.as_py()))
            size += n
    if held:
        yield _merged(held)


def _pair_counts(marked: DataFrame, known: Broadcast) -> DataFrame:
    """Distinct pairs of the texts with their counts in the target and in the documents.

    They are summed over a task's share as far as it fits, then over each part.  The pairs of a context are one part, so that contexts
    are nearly counted where they are read; those of top words are spread.
    """

    def counted(held: list[tuple]) -> pa.RecordBatch:
        key, before, word, own, both = (np.concatenate(x) for x in zip(*held, strict=True))
        first, order, sums = _added(key, own)
        at = order[first]
        all_sums = np.add.reduceat(both[order], first) if len(first) else both
        return packed(key[at], before[at], word[at], sums, all_sums)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            weights = [np.asarray(batch.column(c), dtype=np.int64) for c in COUNTS]
            for start, some in chunks(batch.column("text").to_pylist()):
                doc, key, before, word = known.value.pairs_of(some)
                first, order, own = _added(key, weights[0][start + doc])
                at = order[first]
                both = np.add.reduceat(weights[1][start + doc][order], first) if len(first) else first
                held.append((key[at], before[at], word[at], own, both))
                size += len(at)
                if size >= HELD:
                    yield counted(held)
                    held, size = [], 0
        if size:
            yield counted(held)

    parts = marked.select("text", *COUNTS).mapInArrow(count, PACKED).repartition("part").sortWithinPartitions("part")
    return parts.mapInArrow(_of_parts, "key long, before long, word long, own long, all long")


def _array(rows: pa.Table, names: tuple[str, ...], size: int) -> np.ndarray:
    out = np.zeros((len(names), size))
    for k, name in enumerate(names):
        out[k, np.asarray(rows["id"], dtype=np.int64)] = np.asarray(rows[name], dtype=np.float64)
    return out


def tables(docs: DataFrame, marked: DataFrame):
    """What tasks look up (broadcast), and the table of the chances (key, target, background) of the pairs to be joined."""
    spark = docs.sparkSession
    folder = new_path(spark, "counts")
    words = _counted(docs, _words, "all").groupBy("value").agg(F.sum("all").alias("all"))
    words = _written(words, f"{folder}/words")
    frequent = _most(words, F.col("all"), "value").toArrow().sort_by([("all", "descending"), ("value", "ascending")])
    value = np.asarray(frequent["value"], dtype=np.int64)
    if len(value) >> BITS:
        raise ValueError(f"numbers of {len(value)} words do not fit {BITS} bits")
    order = np.argsort(value)
    known, size = Known(value[order], (order + 1).astype(np.int32)), len(value) + 1
    numbers = spark.sparkContext.broadcast(known)

    none = F.lit(0).cast("long")
    pairs = _written(_pair_counts(marked, numbers), f"{folder}/pairs")
    numbers.destroy()

    contexts = pairs.groupBy(F.expr(BEFORE).alias("id")).agg(
        *(F.sum(c).alias(f"rows_{c}") for c in COUNTS), *(F.count_if(F.col(c) > 0).alias(f"pairs_{c}") for c in COUNTS)
    )
    contexts = _written(contexts, f"{folder}/contexts")
    singles = pairs.where("own > 0").groupBy(F.expr(AFTER).alias("id")).agg(F.sum("own").alias("own"))
    singles = _written(singles, f"{folder}/singles")
    own = singles.agg(F.coalesce(F.sum("own"), none).alias("n")).first()["n"]
    whole = words.agg(F.count("*").alias("words"), F.coalesce(F.sum("all"), none).alias("n")).first()
    context = _array(contexts.where("id >= 0").toArrow(), CONTEXT, size)
    single = np.zeros((2, size))
    single[0] = _array(singles.where("id >= 0").toArrow(), ("own",), size)[0]
    single[1, 1:] = np.asarray(frequent["all"], dtype=np.float64)
    context, single = context.astype(np.float32), single.astype(np.float32)
    known = replace(known, context=context, single=single, words=whole["words"], total=(own, whole["n"]))

    inner = pairs.where("key >= 0")
    top = _most(inner, F.col("own") + F.col("all"), "key").select("key", *COUNTS).toArrow().sort_by("key")
    known.keys = np.asarray(top["key"], dtype=np.int64)
    counts = (np.asarray(top[c], dtype=np.float64) for c in COUNTS)
    known.chances = np.array(known.of_keys(known.keys, *counts), np.float32).reshape(2, -1)
    shared = spark.sparkContext.broadcast(known)

    def of_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, own, both = (np.asarray(c) for c in batch.columns)
            new = ~_found(shared.value.keys, key)[1]
            parts = shared.value.of_keys(key[new], own[new], both[new])
            yield pa.record_batch([pa.array(key[new]), *(pa.array(x.astype(np.float32)) for x in parts)], names=["key", "target", "background"])

    def of_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: batch.column(name) for name in batch.schema.names}
            own, both, before, word = (np.asarray(at[c]) for c in (*COUNTS, "before", "word"))
            context = np.array([np.asarray(at[c].fill_null(0)) for c in CONTEXT], np.float64)
            single = np.array([np.asarray(at[c].fill_null(0)) for c in ("n_own", "n_all")], np.float64)
            numbered = before >= 0
            context[:, numbered] = shared.value.context[:, before[numbered]]
            numbered = word >= 0
            single[:, numbered] = shared.value.single[:, word[numbered]]
            parts = shared.value.log_chances(own, both, context, single)
            yield pa.record_batch([at["key"], *(pa.array(x.astype(np.float32)) for x in parts)], names=["key", "target", "background"])

    kind = "key long, target float, background float"
    # Words without a number are joined with their counts; a pair's other word gets a key that no word has.
    rare_words = words.select(
        F.shiftrightunsigned("value", 2).bitwiseOR(F.lit(-(1 << 63)).cast("long")).alias("word_key"),
        F.col("all").alias("n_all"),
    )
    own_words = singles.where("id < 0").select(F.col("id").alias("word_key"), F.col("own").alias("n_own"))
    rare_words = rare_words.join(own_words.hint("merge"), "word_key", "left")
    outer = pairs.where("key < 0").withColumns(
        {f"{c}_key": F.when(F.col(c) < 0, F.col(c)).otherwise(F.col("key")) for c in ("before", "word")}
    )
    outer = outer.join(contexts.where("id < 0").withColumnRenamed("id", "before_key").hint("merge"), "before_key", "left")
    outer = outer.join(rare_words.hint("merge"), "word_key", "left")
    found = inner.where("own > 0 OR all > 1").select("key", *COUNTS).mapInArrow(of_numbers, kind)
    found = found.unionByName(outer.drop("before_key", "word_key").mapInArrow(of_hashes, kind))
    found = _written(found, new_path(spark, "chances"))
    remove_folder(spark, folder)
    return shared, found


def _found(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sorted keys, and whether the key is there; each distinct key is looked for once, in order."""
    if not len(keys) or not len(key):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    order = np.argsort(key)
    ranked = key[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    place = np.minimum(np.searchsorted(keys, ranked[first]), len(keys) - 1)
    times = np.diff(np.append(first, len(key)))
    at, there = np.empty(len(key), np.int64), np.empty(len(key), bool)
    at[order] = np.repeat(place, times)
    there[order] = np.repeat(keys[place] == ranked[first], times)
    return at, there


def cross_entropy_difference(
    docs: DataFrame, target: DataFrame | None = None, is_target: DataFrame | None = None
) -> DataFrame:
    """doc_id, n_words, target_loss and background_loss (nats per word), score (their difference).

    The target are any texts.  Where it is a part of the documents, ``is_target`` may be given instead: the documents with a
    boolean column of that name, so that each text is counted once for both models.
    """
    if (target is None) == (is_target is None):
        raise ValueError("give the target or the documents marked by is_target")
    one, none = (F.lit(n).cast("long") for n in (1, 0))
    if is_target is not None:
        own = F.when(F.col("is_target"), one).otherwise(none)
        marked = is_target.select("text", own.alias("own"), one.alias("all"))
    else:
        marked = docs.select("text", none.alias("own"), one.alias("all")).unionByName(
            target.select("text", one.alias("own"), none.alias("all"))
        )
    bounded_batches(docs.sparkSession)
    shared, chances = tables(docs, marked)
    kind = docs.schema["doc_id"].dataType.simpleString()
    own_key = 1 << 62  # of a document's own row, which no pair has

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document with what its frequent pairs add, and one for each other pair."""
        known, row = shared.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            for start, some in chunks(batch.column("text").to_pylist()):
                doc, key, _, _ = known.pairs_of(some)
                at, frequent = _found(known.keys, key)
                rows = row + np.arange(len(some))
                row += len(some)
                sums = [-np.bincount(doc[frequent], c[at[frequent]], len(some)).astype(np.float64) for c in known.chances]
                n, none = np.bincount(doc, minlength=len(some)), int((~frequent).sum())
                ids = batch.column("doc_id").slice(start, len(some))
                parts = [np.concatenate([rows, rows[doc[~frequent]]]), np.concatenate([own_key | rows, key[~frequent]])]
                parts = [pa.array(x) for x in parts]
                for x in (ids, *(pa.array(x) for x in (n, *sums))):
                    parts.append(pa.concat_arrays([x, pa.nulls(none, x.type)]))
                yield pa.record_batch(parts, names=["row", "key", "doc_id", "n_words", "t", "b"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            at = {name: batch.column(name) for name in batch.schema.names}
            key = np.asarray(at["key"])
            once = (key >= 0) & (key < own_key) & np.asarray(at["target"].is_null())
            single = known.of_keys(key[once], np.zeros(once.sum()), np.ones(once.sum()))
            sums = []
            for k, (own, chance) in enumerate((("t", "target"), ("b", "background"))):
                x = np.asarray(at[own].fill_null(0.0)) - np.asarray(at[chance].cast(pa.float64()).fill_null(0.0))
                x[once] -= single[k]
                sums.append(pa.array(x))
            yield pa.record_batch([at["row"], at["doc_id"], at["n_words"], *sums], names=["row", "doc_id", "n_words", "t", "b"])

    rows = docs.select("doc_id", "text").mapInArrow(
        held, f"row long, key long, doc_id {kind}, n_words long, t double, b double"
    )
    rows = rows.join(chances.hint("merge"), "key", "left")
    rows = rows.mapInArrow(added, f"row long, doc_id {kind}, n_words long, t double, b double")
    sums = rows.groupBy("row").agg(*(F.max(c).alias(c) for c in ("doc_id", "n_words")), F.sum("t").alias("t"), F.sum("b").alias("b"))
    words = F.greatest("n_words", F.lit(1))
    return sums.select(
        "doc_id",
        "n_words",
        (F.col("t") / words).alias("target_loss"),
        (F.col("b") / words).alias("background_loss"),
        ((F.col("t") - F.col("b")) / words).alias("score"),
    )
