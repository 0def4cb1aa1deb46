"""Alignment of two tokenizers over the same texts, by diagonal run skipping over their end offsets.

Both tokenizers cut space + text into tokens; the arrays of their byte ends are compared on a diagonal: while the tokens are
one to one, the index of one array is that of the other plus a shift.  A probe compares a stretch of both arrays at the
current shift; each stretch that agrees doubles the next, so that one-to-one runs are jumped.  Where the ends differ,
the smaller end is advanced until both end together again: an irregular group, after which the shift is another.  A stretch of
texts is gone through in lanes, which start at common ends found by binary search and move side by side in numpy.

Links (A token, B token) of a group are counted as pairs of ids, by documents over the whole corpus.  A task gathers
documents into blocks, each with its distinct pairs and, for each document, which of them it holds how often.  Blocks are written once;
Spark adds up the documents of each pair, finds the highest count of each A id, and joins both back to the blocks.

Tokenizers are called for each distinct unit: a stretch between single spaces that have no white space beside them.  Neither
tokenizer has tokens across such a place (checked when they are loaded, else texts are encoded whole), so that the units'
tokens are the text's.  Long texts are gone through in segments of such units, and a document's digest and counts are
added up over them; a stretch without such a space is one unit and has to fit into memory.

Defined results: a text that is null, empty or whose tokens joined differ from space + text has no tokens: counts of 0 and an
empty digest.  Repeated rows are documents each.  A null or repeated doc_id is kept as it is.  Extra columns are left out; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordance.llm.tables import keep

#: Bytes of text of a segment and of a block, bytes between lanes, and the longest probe: bounds of work done at once.
SEGMENT, BLOCK, LANE, PROBE = 1 << 20, 8 << 20, 1 << 10, 1 << 10
#: Distinct units that a task remembers.
REMEMBERED = 600_000
#: Links of a group that are written out one by one; beyond, distinct ids are paired with their numbers.
LINKS = 4096
_ID = 20  # bits of an id
_EDGE = re.compile(r" \s|\s ")
_CUT = re.compile(r"(?<=\S) (?=\S)")
DOCS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
BLOCKS = (
    f"block string, docs array<struct<{DOCS.replace(' long', ':long').replace(' string', ':string')}>>,"
    " sizes array<int>, held binary, n_held long, pair array<long>, holders array<int>"
)
_DOC = pa.struct([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in DOCS.split(", ")])
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def align(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices into both ascending arrays of ends where the same offset ends a token; the last ends agree."""
    first_a, first_b, last_a, last_b = _lanes(a, b)
    ends_a, ends_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    i, j, probe = first_a.copy(), first_b.copy(), np.full(len(first_a), 4)
    active = np.arange(len(i))
    while len(active):
        x, y = a[i[active]], b[j[active]]
        apart = x != y
        off = active[apart]
        if len(off):  # inside an irregular group: the smaller end moves
            less = x[apart] < y[apart]
            i[off] += less
            j[off] += ~less
        on = active[~apart]
        for size in np.unique(probe[on]):
            lanes = on[probe[on] == size]
            step = np.arange(size)
            at = i[lanes][:, None] + step
            other = j[lanes][:, None] + step
            inside = (at <= last_a[lanes][:, None]) & (other <= last_b[lanes][:, None])
            same = inside & (a[np.minimum(at, len(a) - 1)] == b[np.minimum(other, len(b) - 1)])
            run = np.where(same.all(1), size, same.argmin(1))
            skipped = step < run[:, None]
            ends_a[at[skipped]] = True
            ends_b[other[skipped]] = True
            i[lanes] += run
            j[lanes] += run
            probe[lanes] = np.where(run == size, min(2 * size, PROBE), 4)
        active = active[i[active] <= last_a[active]]
    return np.flatnonzero(ends_a), np.flatnonzero(ends_b)


def _lanes(a: np.ndarray, b: np.ndarray):
    """First and last indices of lanes in both arrays; a lane ends where both arrays have the same end."""
    near = np.searchsorted(a, np.arange(LANE, a[-1], LANE))
    found = [np.array([len(a) - 1])]
    for step in range(8):
        if not len(near):
            break
        at = np.minimum(near + step, len(a) - 1)
        common = b[np.searchsorted(b, a[at])] == a[at]
        found.append(at[common])
        near = near[~common]
    last_a = np.unique(np.concatenate(found))
    last_b = np.searchsorted(b, a[last_a])
    return np.append(0, last_a[:-1] + 1), np.append(0, last_b[:-1] + 1), last_a, last_b


class Tokenizers:
    """A byte-level tokenizer file (A) and a piece model (B), and what distinct units are in both."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        entries = self.a.get_vocab(with_added_tokens=True)
        added = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, n in entries.items():
            self.bytes_a[n] = entry.encode() if entry in added else _byte_level(entry)
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace("▁", " ").encode() for n, p in enumerate(pieces)
        ]
        if max(len(self.bytes_a), len(self.bytes_b)) >> _ID:
            raise ValueError(f"ids of more than {_ID} bits")
        self.sizes_a, self.sizes_b = (np.array([len(e) for e in t]) for t in (self.bytes_a, self.bytes_b))
        self.by_units = _cuts_at_spaces(json.loads(self.a.to_str())) and not any(
            "▁" in p.lstrip("▁") for p in pieces
        )
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = [np.zeros(0, np.uint32), np.zeros(0, np.uint32)]
        self.ends = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def _encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        # Offsets of tokens are not needed.
        found_a = [e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
        return found_a, self.b.encode(units, num_threads=1)

    def _joined(self, unit: str, a: list[int], b: list[int]) -> bool:
        whole = (" " + unit).encode()
        return whole == b"".join(map(self.bytes_b.__getitem__, b)) and whole == b"".join(map(self.bytes_a.__getitem__, a))

    def segments(self, text: str) -> Iterator[list[str]]:
        """The units of a text, as many at once as make a segment."""
        if not self.by_units or "▁" in text:
            yield [text]
            return
        at, held, size = 0, [], 0
        while at < len(text):
            end = at + SEGMENT // 2
            while end < len(text):  # the next place to cut
                end = text.find(" ", end)
                if end < 0 or (end and end + 1 < len(text) and not (text[end - 1].isspace() or text[end + 1].isspace())):
                    break
                end += 1
            end = len(text) if end < 0 or end >= len(text) else end
            part = text[at:end]
            yield _CUT.split(part) if _EDGE.search(part) else _plain(part)
            at = end + 1

    def ids(self, segments: list[list[str]]):
        """The ids of each tokenizer with their number by segment (none if its tokens joined are another text), and which are good."""
        if len(self.known) > REMEMBERED or len(self.flat[0]) > 8 * REMEMBERED:
            self._clear()
        new = [u for u in dict.fromkeys(chain.from_iterable(segments)) if u not in self.known]
        if new:
            found = self._encode(new)
            start = len(self.ends[0]) - 1
            for unit, n in zip(new, range(start, start + len(new)), strict=True):
                self.known[unit] = n if self._joined(unit, found[0][n - start], found[1][n - start]) else -1
            for side in (0, 1):
                sizes = np.array([len(f) for f in found[side]], np.int64)
                more = np.fromiter((i for f in found[side] for i in f), np.uint32, sizes.sum())
                self.flat[side] = np.concatenate([self.flat[side], more])
                self.ends[side] = np.concatenate([self.ends[side], self.ends[side][-1] + np.cumsum(sizes)])
        lists = [list(map(self.known.__getitem__, units)) for units in segments]
        good = [min(units) >= 0 for units in lists]
        numbers = np.array([n for units, own in zip(lists, good, strict=True) if own for n in units], np.int64)
        units = np.array([len(u) if own else 0 for u, own in zip(lists, good, strict=True)])
        out = []
        for side in (0, 1):
            sizes = np.diff(self.ends[side])[numbers]
            ends = np.cumsum(sizes)
            at = np.repeat(self.ends[side][numbers] - (ends - sizes), sizes) + np.arange(sizes.sum())
            out.append((self.flat[side][at], np.diff(np.append(0, np.append(0, ends)[np.cumsum(units)]))))
        return out[0], out[1], good


def _byte_level(entry: str) -> bytes:
    return bytes(map(_BYTES.__getitem__, entry))


#: Byte-level vocabularies write a byte as the character of its number if that can be seen, and the others, in
#: order, as the characters from 256 on.
_UNSEEN = [*range(33), *range(127, 161), 173]
_BYTES = {chr(n): n for n in range(256) if n not in _UNSEEN} | {chr(256 + k): n for k, n in enumerate(_UNSEEN)}


def _cuts_at_spaces(spec: dict) -> bool:
    """Does the tokenizer cut before a single space, as the common byte-level expression does, and change no text?"""
    cut = spec.get("pre_tokenizer") or {}
    return not spec.get("normalizer") and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)


def _plain(part: str) -> list[str]:
    """The units of a text without white space beside its spaces; its outer spaces are no cuts."""
    units = part.split(" ")
    if len(units) > 1 and not units[0]:
        units[:2] = [" " + units[1]]
    if len(units) > 1 and not units[-1]:
        units[-2:] = [units[-2] + " "]
    return units


@cache
def _tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def _pairs(doc: np.ndarray, a, b, first_a, n_a, first_b, n_b) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct keys of (document, A id, B id) of the links of groups, and how often they are linked."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    few = n_a * n_b <= LINKS
    links = (n_a * n_b)[few]
    group = np.repeat(np.flatnonzero(few), links)
    k = np.arange(links.sum()) - np.repeat(np.cumsum(links) - links, links)
    width = n_b[group]
    keys = (doc[group] << (2 * _ID)) | (a[first_a[group] + k // width] << _ID) | b[first_b[group] + k % width]
    yield np.unique(keys, return_counts=True)
    for g in np.flatnonzero(~few):
        ids_a, times_a = np.unique(a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        ids_b, times_b = np.unique(b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        yield ((doc[g] << (2 * _ID)) | (ids_a[:, None] << _ID) | ids_b).ravel(), (times_a[:, None] * times_b).ravel()


def _summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their sums."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, time = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(key, kind="stable")
    key, time = key[order], time[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(time, first) if len(first) else time


class _Block:
    """Documents with the pairs of ids they hold."""

    def __init__(self, tokenizers: Tokenizers, table: list[bytes]):
        self.tokenizers, self.table = tokenizers, table
        self.doc_ids, self.counts, self.digests, self.bad = [], [], [], set()
        self.keys, self.times = [], []
        self.waiting, self.size, self.held = [], 0, 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        n = len(self.doc_ids)
        self.doc_ids.append(doc_id)
        self.counts.append(np.zeros(4, np.int64))
        self.digests.append(None)
        for units in self.tokenizers.segments(text) if text else ():
            self.waiting.append((n, units))
            size = sum(map(len, units)) + len(units)
            self.size += size
            self.held += size
            if self.size >= SEGMENT:
                self.work()
        self.held += 64

    def work(self) -> None:
        """Aligns the segments that wait, as one stretch."""
        docs = np.array([n for n, _ in self.waiting], np.int64)
        (a, of_a), (b, of_b), good = self.tokenizers.ids([units for _, units in self.waiting])
        self.waiting, self.size = [], 0
        self.bad.update(docs[~np.array(good, bool)].tolist())
        if not len(a):
            return
        sizes_a, sizes_b = self.tokenizers.sizes_a, self.tokenizers.sizes_b
        last_a, last_b = align(np.cumsum(sizes_a[a]), np.cumsum(sizes_b[b]))
        n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        first_a, first_b = last_a - n_a + 1, last_b - n_b + 1
        part = np.searchsorted(np.cumsum(of_a), first_a, side="right")
        groups = np.bincount(part, minlength=len(docs))
        ends = np.cumsum(groups)
        links = np.diff(np.append(0, np.cumsum(n_a * n_b))[ends], prepend=0)
        # Ids and the signs that follow them, group by group: the A ids, then the B ids.
        count = len(self.table) // 3
        code = np.empty(len(a) + len(b), np.int64)
        code[np.repeat(first_b, n_a) + np.arange(len(a))] = a
        code[np.repeat(last_a + 1, n_b) + np.arange(len(b))] = b
        code[last_a + first_b] += count
        code[last_a + last_b + 1] += 2 * count
        signs = list(map(self.table.__getitem__, code.tolist()))
        at = 0
        for n, *own in zip(docs.tolist(), of_a, of_b, groups, links, strict=True):
            if own[0]:
                self.counts[n] += np.array(own)
                digest = self.digests[n]
                text = b"".join(signs[at : (at := at + int(own[0] + own[1]))])[:-1]
                if digest is None:
                    self.digests[n] = hashlib.sha256(text)
                else:
                    digest.update(b";" + text)
        for keys, times in _pairs(docs[part], a, b, first_a, n_a, first_b, n_b):
            self.keys.append(keys)
            self.times.append(times)

    def row(self) -> pa.RecordBatch:
        """The block as a row of BLOCKS."""
        if self.waiting:
            self.work()
        key, times = _summed(self.keys, self.times)
        doc = key >> (2 * _ID)
        if self.bad:
            own = ~np.isin(doc, np.array(sorted(self.bad)))
            key, times, doc = key[own], times[own], doc[own]
        pairs, at, holders = np.unique(key & ((1 << 2 * _ID) - 1), return_inverse=True, return_counts=True)
        sizes = np.bincount(doc, minlength=len(self.doc_ids))
        # Places among the pairs rise within a document, so their steps are small.
        data = np.diff(at.astype(np.int64), prepend=0).astype("<i4").tobytes() + times.astype("<u8").tobytes()
        rows = []
        for n, doc_id in enumerate(self.doc_ids):
            none = n in self.bad or self.digests[n] is None
            own = dict.fromkeys(_COUNTS, 0) if none else dict(zip(_COUNTS, self.counts[n].tolist(), strict=True))
            rows.append({"doc_id": doc_id, **own, "groups_sha256": "" if none else self.digests[n].hexdigest()})
        columns = [
            pa.array([uuid.uuid4().hex]),
            pa.array([rows], pa.list_(_DOC)),
            pa.array([sizes.tolist()], pa.list_(pa.int32())),
            pa.array([zstandard.ZstdCompressor(level=1).compress(data)]),
            pa.array([len(key)], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(pairs, pa.int64())),
            pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(holders.astype(np.int32))),
        ]
        return pa.record_batch(columns, names=["block", "docs", "sizes", "held", "n_held", "pair", "holders"])


def blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Documents aligned, in blocks with their distinct pairs of ids."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokenizers(path_a, path_b)
        count = max(len(own.bytes_a), len(own.bytes_b))
        table = [str(n).encode() + sign for sign in (b",", b"|", b";") for n in range(count)]
        block = _Block(own, table)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                block.add(doc_id, text.as_py())
                if block.held >= BLOCK:
                    yield block.row()
                    block = _Block(own, table)
        if block.doc_ids:
            yield block.row()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(of_task, BLOCKS)


def _with_counts(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a block with what their links add up to; right has all pairs of the block."""
    columns = [pa.array([], pa.int64())] * 2
    docs = left.column("docs").combine_chunks().flatten()
    sizes = np.asarray(left.column("sizes").combine_chunks().flatten())
    n = left.column("n_held")[0].as_py()
    data = zstandard.ZstdDecompressor().decompress(left.column("held")[0].as_py(), max_output_size=12 * n)
    at = np.cumsum(np.frombuffer(data, "<i4", n).astype(np.int64))
    times = np.frombuffer(data, "<u8", n, 4 * n).astype(np.int64)
    ends = np.cumsum(sizes)
    if n:
        order = np.argsort(right.column("pair").to_numpy())
        count, best = right.column("count").to_numpy()[order], right.column("best").to_numpy()[order]
        weights = (times * (count[at] == best[at]), times * count[at])
        columns = [pa.array(np.diff(np.append(0, np.cumsum(w))[ends], prepend=0)) for w in weights]
    else:
        columns = [pa.array(np.zeros(len(sizes), np.int64))] * 2
    names = [f.name for f in _DOC]
    return pa.table([*docs.flatten(), *columns], names=[*names, "n_best", "count_sum"])


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum of each document."""
    rows = keep(blocks(docs, path_a, path_b), "blocks")
    held = rows.select(F.col("block").alias("of_block"), F.inline(F.arrays_zip("pair", "holders")))
    counts = held.groupBy("pair").agg(F.sum("holders").alias("count"))
    first = F.shiftright("pair", _ID)
    counts = keep(counts.withColumn("a", first), "counts")
    best = counts.groupBy("a").agg(F.max("count").alias("best"))
    counts = counts.join(best.hint("merge"), "a").select("pair", "count", "best")
    known = held.select("of_block", "pair").join(counts.hint("merge"), "pair")
    left = rows.select("block", "docs", "sizes", "held", "n_held").groupBy("block")
    return left.cogroup(known.groupBy("of_block")).applyInArrow(_with_counts, f"{DOCS}, n_best long, count_sum long").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
