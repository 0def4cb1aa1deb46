"""Removal of repeated passages: suffix arrays of shards, with common prefixes, merged by binary search.

A string of 400 bytes that starts in two places is removed in both.  Shards are cut by content, so that equal strings meet:
each window of 400 bytes has an anchor, its 32 bytes of least hash (the first, if several tie).  Equal windows have equal
anchors at the same place, so only windows around anchors whose bytes repeat anywhere can repeat.  A run of windows with one anchor,
its context, is short (at most 768 bytes), each window lies in exactly one context, and equal contexts are kept once with their number.

The contexts of repeated anchors are shuffled by anchor into shards.  A task orders a shard's suffixes (suffix_arrays) and
marks windows that share 400 bytes with a neighbour in that order.  The contexts of a frequent anchor are dealt over several shards;
each then yields its distinct windows as sorted 64-bit fingerprints, cut at splitters into ranges, and what shards have in common
is found by binary search, range by range.  No anchor, context or window is sent to one task with all it occurs in: equal
contexts are counted before they are shuffled, and joins back to documents take frequent keys by broadcast (their number is
bounded by the share of all rows that makes them frequent) and others by merging.

Anchors and contexts are compared by two independent 64-bit hashes together, windows of different shards by that of the anchor and
one of the window; within a shard bytes are compared.

Defined results: a null or empty text has 0 bytes and the digest of nothing; texts below 400 bytes lose nothing.  Texts are bytes,
matches may overlap, also with themselves, and may cut characters.  Repeated rows are documents each, so all but short ones lose
every byte.  Long texts are gone through in pieces of 512 KB.  doc_id may be null or repeated.  Extra columns are left out;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordance.llm.suffix_arrays import Shard
from accordance.llm.tables import keep
from accordance.llm.tokens import mixed

#: Bytes of a repeated string, and of an anchor.
LENGTH, GRAM = 400, 32
#: Window starts of a piece of a long text, bytes of a shard, and contexts of an anchor that one shard takes.
PIECE, SHARD, SPLIT = 1 << 19, 2 << 20, 2048
#: Keys with more than this share of the rows, and this many, are joined by broadcast.
SHARE, FEW = 4000, 1000
_PLACE_BITS = 20
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
_SIGNS = np.random.default_rng(13).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
KEY = "k1 long, k2 long"
PLACES = f"{KEY}, h long, ctx long, start long, n int, copies long, more array<long>"
CONTEXTS = "h long, split int, splits int, k1 long, k2 long, start long, single boolean, bytes binary"
FOUND = f"{KEY}, spans array<long>, h long, slot int, prints array<long>, k1s array<long>, k2s array<long>, places array<long>"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A hash of the ``size`` bytes (a power of two) from each place on."""
    out = _SIGNS[data]
    width = 1
    while width < size:
        out = out[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + out[width:]
        width *= 2
    return mixed(out)


def least_of_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of each window of ``width`` places."""
    have = 1
    while 2 * have <= width:
        keys = np.minimum(keys[:-have], keys[have:])
        have *= 2
    return np.minimum(keys[: len(keys) - (width - have)], keys[width - have :]) if width > have else keys


def anchors(pieces: list[bytes], length: int = LENGTH):
    """Of the windows of pieces, in runs of one anchor: piece, first start, number of starts, hashes of anchor and context."""
    data = b"".join(pieces)
    ends = np.cumsum([len(p) for p in pieces])
    hashes = gram_hashes(np.frombuffer(data, np.uint8))
    keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    place = (least_of_windows(keys, length - GRAM + 1) & _PLACE).astype(np.int64)
    starts = np.arange(len(place))
    piece = np.searchsorted(ends, starts, side="right")
    own = starts + length <= ends[piece]
    starts, piece, place = starts[own], piece[own], place[own]
    first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (piece[1:] != piece[:-1])))
    count = np.diff(np.append(first, len(starts)))
    at, piece = starts[first], piece[first]
    view = memoryview(data)
    digest = xxhash.xxh3_64_intdigest
    context = [digest(view[a:b]) for a, b in zip(at.tolist(), (at + count + length - 1).tolist(), strict=True)]
    begins = np.append(0, ends[:-1])
    return piece, at - begins[piece], count, hashes[place[first]].view(np.int64), np.array(context, np.uint64).view(np.int64)


def merged(spans: np.ndarray) -> np.ndarray:
    """Rows of first and end, in order, those that touch as one."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > ends[:-1])
    return np.stack([spans[new, 0], ends[np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)]], 1)


def _runs(starts: np.ndarray, length: int) -> np.ndarray:
    """The bytes of windows at ascending starts, as rows of first and end."""
    return merged(np.stack([starts, starts + length], 1))


def places(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The contexts of each text; equal ones of a text that are met at once are one row with the bytes of the others."""

    def rows(keys: list[tuple[int, int]], begins: list[int], pieces: list[bytes]) -> pa.RecordBatch:
        piece, start, count, h, ctx = anchors(pieces, length)
        doc = np.array([n for n, _ in begins], np.int64)[piece]
        start = start + np.array([b for _, b in begins], np.int64)[piece]
        order = np.lexsort([start, ctx, h, doc])
        new = np.append(True, (np.diff(doc[order]) != 0) | (np.diff(h[order]) != 0) | (np.diff(ctx[order]) != 0))
        first = np.flatnonzero(new)
        copies = np.diff(np.append(first, len(order)))
        more: list = [None] * len(first)
        for n in np.flatnonzero(copies > 1):
            others = start[order[first[n] + 1 : first[n] + copies[n]]]
            more[n] = merged(np.stack([others, others + count[order[first[n]]] + length - 1], 1)).ravel()
        first = order[first]
        key = np.array(keys, np.int64).reshape(-1, 2)[doc[first]]
        columns = [key[:, 0], key[:, 1], h[first], ctx[first], start[first], count[first].astype(np.int32), copies, pa.array(more, pa.list_(pa.int64()))]
        return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=_names(PLACES))

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, begins, pieces, size = [], [], [], 0
        for batch in batches:
            k1, k2 = (batch.column(c).to_pylist() for c in ("k1", "k2"))
            for n, text in enumerate(batch.column("text")):
                data = text.as_py()
                keys.append((k1[n], k2[n]))
                for at in range(0, len(data) - length + 1, PIECE):
                    piece = data[at : at + PIECE + length - 1]
                    if size + len(piece) >> _PLACE_BITS:
                        yield rows(keys, begins, pieces)
                        keys, begins, pieces, size = keys[-1:], [], [], 0
                    begins.append((len(keys) - 1, at))
                    pieces.append(piece)
                    size += len(piece)
        if pieces:
            yield rows(keys, begins, pieces)

    return docs.where(F.octet_length("text") >= length).mapInArrow(of_task, PLACES)


def _spread_join(big: DataFrame, small: DataFrame, on: list[str], weight: str, total: int) -> DataFrame:
    """An inner join in which no task gets more of big's rows of one key than others.

    Of the keys whose weight, at least their rows in big, is above a share of the total there are at most SHARE.
    """
    least = max(FEW, total // SHARE)
    heavy = small.where(F.col(weight) > least).drop(weight)
    rest = big.join(F.broadcast(heavy.select(*on)), on, "left_anti")
    light = small.where(F.col(weight) <= least).drop(weight)
    return big.join(F.broadcast(heavy), on).unionByName(rest.join(light.hint("merge"), on))


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """The bytes of the contexts that a document stands for."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for k1, k2, text, cuts in zip(*(batch.column(c) for c in ("k1", "k2", "text", "cuts")), strict=True):
                data = text.as_py()
                for c in cuts.as_py():
                    part = data[c["start"] : c["start"] + c["n"] + length - 1]
                    rows.append((c["h"], c["split"], c["splits"], k1.as_py(), k2.as_py(), c["start"], c["single"], part))
                    size += len(part)
                    if size >= SHARD:
                        yield _table(rows, CONTEXTS)
                        rows, size = [], 0
            if rows:
                yield _table(rows, CONTEXTS)

    return texts.where("size(cuts) > 0").select("k1", "k2", "text", "cuts").mapInArrow(of_task, CONTEXTS)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = [_TYPES[c.split()[1]] for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_names(schema))


def shard_repeats(rows: list[tuple], length: int) -> list[tuple]:
    """Repeated bytes of the contexts of a shard, and the sorted fingerprints of windows whose anchor has several shards."""
    strings = [r[-1] for r in rows]
    shard = Shard(strings)
    order = shard.suffixes(length)
    shared = shard.common(order) >= length
    repeated, twin = np.zeros(len(order), bool), np.zeros(len(order), bool)
    repeated[order[shared]] = True
    twin[order[shared]] = True  # an equal window comes before it in the array
    repeated[order[:-1][shared[1:]]] = True
    out, prints = [], {}
    for (h, _, splits, k1, k2, start, single, data), at in zip(rows, shard.starts.tolist(), strict=True):
        count = len(data) - length + 1
        found = np.flatnonzero(repeated[at : at + count])
        if single and len(found):
            spans = (_runs(found, length) + start).ravel().tolist()
            out.append((k1, k2, spans, None, None, None, None, None, None))
        if splits > 1:
            for n in np.flatnonzero(~twin[at : at + count]).tolist():
                print_ = xxhash.xxh3_64_intdigest(data[n : n + length])
                # Only windows not marked here have something to gain; others still show that they are here.
                place = start + n if single and not repeated[at + n] else None
                prints.setdefault((h, splits), []).append((print_, k1, k2, place))
    for (h, splits), own in prints.items():
        own.sort(key=lambda p: p[0])
        values = np.array([p[0] for p in own], np.uint64)
        bounds = np.searchsorted(values, np.array([(s << 64) // splits for s in range(1, splits)], np.uint64))
        for slot, (a, b) in enumerate(zip([0, *bounds.tolist()], [*bounds.tolist(), len(own)], strict=True)):
            if b > a:
                columns = list(zip(*own[a:b], strict=True))
                out.append((None, None, None, h, slot, values[a:b].view(np.int64).tolist(), *map(list, columns[1:])))
    return out


def _shards(contexts: DataFrame, length: int) -> DataFrame:
    """The repeats of shards: whole anchors (or their splits) up to SHARD bytes."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in _names(CONTEXTS)), strict=True):
                if row[:2] != last and size >= SHARD:
                    yield _table(shard_repeats(held, length), FOUND)
                    held, size = [], 0
                last = row[:2]
                held.append(row)
                size += len(row[-1])
        if held:
            yield _table(shard_repeats(held, length), FOUND)

    return contexts.repartition("h", "split").sortWithinPartitions("h", "split").mapInArrow(of_task, FOUND)


def _merge(length: int):
    """What the sorted runs of several shards have in common, in one range of fingerprints of one anchor."""

    def of_range(runs: pa.Table) -> pa.Table:
        prints = [np.asarray(p.values).view(np.uint64) for p in runs.column("prints")]
        every = np.sort(np.concatenate(prints))
        common = np.unique(every[1:][every[1:] == every[:-1]])  # a run holds a fingerprint once
        found: dict[tuple[int, int], list[int]] = {}
        for n, run in enumerate(prints):
            at = np.searchsorted(run, common)
            at = at[(at < len(run)) & (run[np.minimum(at, len(run) - 1)] == common)]
            k1, k2, place = (runs.column(c)[n].values for c in ("k1s", "k2s", "places"))
            for p in at.tolist():
                if place[p].is_valid:
                    found.setdefault((k1[p].as_py(), k2[p].as_py()), []).append(place[p].as_py())
        rows = [(*key, _runs(np.sort(np.array(own)), length).ravel().tolist()) for key, own in found.items()]
        return pa.Table.from_batches([_table(rows, f"{KEY}, spans array<long>")])

    return of_range


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Texts (k1, k2, text) in which something may repeat, and spans (k1, k2, spans) of the bytes that do.

    docs has k1, k2 and text, as bytes.
    """
    key = ["k1", "k2"]
    found = keep(places(docs, length), "places")
    total = found.count()
    repeats = found.groupBy("h").agg(F.sum("copies").alias("all"), F.min("ctx").alias("low"), F.max("ctx").alias("high"))
    repeats = keep(repeats.where("all > 1").select("h", "all", (F.col("low") != F.col("high")).alias("several")), "repeats")
    own = keep(_spread_join(found, repeats, ["h"], "all", total), "repeated")
    contexts = own.groupBy("h", "ctx").agg(
        F.sum("copies").alias("all"),
        F.min(F.struct(*key, "start", "n")).alias("first"),
        F.max("several").alias("several"),
    )
    contexts = keep(contexts, "contexts")
    several = contexts.where("several")
    splits = several.groupBy("h").agg(F.count(F.lit(1)).alias("all"))
    splits = splits.withColumn("splits", F.ceil(F.col("all") / SPLIT).cast("int"))
    split = F.pmod("ctx", F.col("splits").cast("long")).cast("int")
    single = (F.col("all") == 1).alias("single")
    cuts = several.select("h", "ctx", "first.*", single)
    cuts = _spread_join(cuts, splits, ["h"], "all", total).select(
        *key, F.struct("h", split.alias("split"), "splits", "start", "n", "single").alias("cut")
    )
    cut_type = cuts.schema["cut"].dataType
    wanted = cuts.unionByName(own.select(*key, F.lit(None).cast(cut_type).alias("cut")))
    wanted = wanted.groupBy(*key).agg(F.collect_list("cut").alias("cuts"))
    texts = docs.where(F.octet_length("text") >= length).groupBy(*key).agg(F.first("text").alias("text"))
    texts = keep(texts.join(wanted.hint("merge"), key), "texts")
    shards = keep(_shards(_contexts(texts, length), length), "shards")
    across = shards.where("slot IS NOT NULL").groupBy("h", "slot").applyInArrow(_merge(length), f"{KEY}, spans array<long>")
    copied = _spread_join(own, contexts.where("all > 1").select("h", "ctx", "all"), ["h", "ctx"], "all", total)
    end = F.col("start") + F.col("n") + F.lit(length - 1)
    spans = (
        copied.select(*key, F.array("start", end).alias("spans"))
        .unionByName(own.where("more IS NOT NULL").select(*key, F.col("more").alias("spans")))
        .unionByName(shards.where("spans IS NOT NULL").select(*key, "spans"))
        .unionByName(across)
    )
    return texts.select(*key, "text"), spans


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for k1, k2, text, spans in zip(*(batch.column(c) for c in ("k1", "k2", "text", "spans")), strict=True):
            data = memoryview(text.as_buffer())
            own = merged(np.asarray(spans.values).reshape(-1, 2))
            digest, at = hashlib.sha256(), 0
            for a, b in own.tolist():
                digest.update(data[at:a])
                at = b
            digest.update(data[at:])
            rows.append((k1.as_py(), k2.as_py(), int((own[:, 1] - own[:, 0]).sum()), len(own), digest.hexdigest()))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = [*[pa.int64()] * 4, pa.string()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["k1", "k2", "n_removed", "n_spans", "kept"])


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keyed = docs.select(
        "doc_id", text.alias("text"), *[F.xxhash64(F.lit(n), "doc_id", "text").alias(f"k{n}") for n in (1, 2)]
    )
    texts, spans = repeated_spans(keyed.drop("doc_id"), length)
    spans = spans.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    found = texts.join(spans.hint("merge"), ["k1", "k2"]).mapInArrow(
        _kept, f"{KEY}, n_removed long, n_spans long, kept string"
    )
    every = keyed.select("doc_id", "k1", "k2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    zero = F.lit(0).cast("long")
    return every.join(found.hint("merge"), ["k1", "k2"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept", "whole").alias("kept_sha256"),
    )
