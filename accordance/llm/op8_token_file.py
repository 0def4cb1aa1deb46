"""Token-ID files: tokenized documents in blocks of an adaptive range coder.

Documents are ordered by doc_id over all shards (range partitioning), tokenized, closed with an end id, and
packed into segments of whole documents.  A segment is one binary value:

    magic "TIRC", then little-endian: u16 version, u32 ids of a block, u32 documents, u64 ids, u32 blocks,
    u32 bytes of the index and its CRC-32, the index (zlib: u8 no doc_id for each document, i64 doc_id, u64 ids),
    for each block u32 bytes and u32 CRC-32 of its ids, the blocks.

Blocks are coded independently (range_coder), so any can be decoded alone.  Segments are stored as rows of
Parquet files with their shard and place in it, so that they are committed as one, in any store Spark writes to.

The tokenizer is called for each distinct run of characters without white space and a task remembers its ids, which
is what the tokenizer makes of a whole text: it cuts at white space and drops it.  Texts for which that is not certain
(characters outside Latin-1, separator control characters, what looks like a special token) are encoded whole.

Defined results: a null or empty text has the end id only.  A null doc_id sorts first.  Documents with one doc_id are
ordered by a hash of the text; repeated rows follow each other.  Extra columns are left out.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from accordance.llm import range_coder
from accordance.llm.tables import new_path

MAGIC, VERSION = b"TIRC", 1
_HEAD = struct.Struct("<4sHIIQIII")
#: Ids after which a segment is closed at the end of a document.
SEGMENT = 6_000_000
#: Distinct runs that a task remembers the ids of, and as many older ones.
REMEMBERED = 600_000
SEGMENTS = "shard int, place int, ids long, segment binary"
Encode = Callable[[list[str | None]], Iterator[np.ndarray]]


#: Byte-level vocabularies write a byte as the character of its number if that can be seen, and the others, in
#: order, as the characters from 256 on.
_UNSEEN = [*range(33), *range(127, 161), 173]
_SIGNS = {byte: 256 + n for n, byte in enumerate(_UNSEEN)}


class _Ids(dict):
    """Ids of runs of characters without white space, as the bytes of 16-bit numbers.

    When REMEMBERED runs are there they become the older ones, which give back those that come again.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.older: dict[str, bytes] = {}

    def __missing__(self, run: str) -> bytes:
        ids = self.older.get(run)
        if ids is None:
            if run[-1] in ".,;:!?" and run[:-1].isalpha():  # letters and marks are pieces of their own
                ids = self[run[:-1]] + self[run[-1]]
            elif run.isalpha():  # one piece, which the model takes as the signs of its bytes
                signs = run if run.isascii() else run.encode().decode("latin-1").translate(_SIGNS)
                ids = array("H", [t.id for t in self.model.tokenize(signs)]).tobytes()
            else:
                ids = array("H", self.tokenizer.encode(run, add_special_tokens=False).ids).tobytes()
        if len(run) <= 40:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[run] = ids
        return ids


@cache
def _remembered(path: str) -> _Ids:
    from tokenizers import Tokenizer

    return _Ids(Tokenizer.from_file(path))


def _by_runs(text: str) -> bool:
    """Is the text in Latin-1, without separator control characters and what may be a special token?"""
    try:
        data = text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return "<|" not in text and not any(data.find(c) >= 0 for c in (b"\x1c", b"\x1d", b"\x1e", b"\x1f"))


def word_ids(path: str, end: int) -> Encode:
    """An encoder by the tokenizer file at path, whose pieces never cross white space and ignore case."""

    def encode(texts: list[str | None]) -> Iterator[np.ndarray]:
        known = _remembered(path)
        for text in texts:
            if not text:
                yield np.array([end], np.uint16)
            elif _by_runs(text):
                found = b"".join(map(known.__getitem__, text.lower().split()))
                yield np.append(np.frombuffer(found, np.uint16), np.uint16(end))
            else:
                yield np.array([*known.tokenizer.encode(text, add_special_tokens=False).ids, end], np.uint16)

    return encode


def pack(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    """A segment of whole documents."""
    none = np.array([i is None for i in doc_ids], np.uint8)
    numbers = np.array([0 if i is None else i for i in doc_ids], "<i8")
    index = zlib.compress(none.tobytes() + numbers.tobytes() + np.array(sizes, "<u8").tobytes())
    blocks = range_coder.encode(ids)
    head = _HEAD.pack(
        MAGIC, VERSION, range_coder.BLOCK, len(doc_ids), len(ids), len(blocks), len(index), zlib.crc32(index)
    )
    table = b"".join(struct.pack("<II", len(data), crc) for data, crc in blocks)
    return b"".join([head, index, table, *(data for data, _ in blocks)])


def unpack(segment: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, ids of each document, and all ids; raises ValueError for damaged segments."""
    magic, version, block, docs, total, count, size, crc = _HEAD.unpack_from(segment)
    if magic != MAGIC or version != VERSION:
        raise ValueError("no token-ID segment")
    at = _HEAD.size
    index = segment[at : at + size]
    if zlib.crc32(index) != crc:
        raise ValueError("the index is damaged")
    index = zlib.decompress(index)
    none = np.frombuffer(index, np.uint8, docs)
    numbers = np.frombuffer(index, "<i8", docs, docs)
    sizes = np.frombuffer(index, "<u8", docs, 9 * docs).astype(np.int64)
    at += size
    start = at + 8 * count
    blocks = []
    for n in range(count):
        length, crc = struct.unpack_from("<II", segment, at + 8 * n)
        blocks.append((segment[start : start + length], crc))
        start += length
    doc_ids = [None if n else int(i) for n, i in zip(none, numbers, strict=True)]
    return doc_ids, sizes, range_coder.decode(blocks, total, block)


def write_tokens(docs: DataFrame, path: str, encode: Encode) -> None:
    """doc_id and text as segments in ascending order of doc_id."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, place = TaskContext.get().partitionId(), 0
        doc_ids, sizes, held, size = [], [], [], 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts), strict=True):
                doc_ids.append(doc_id)
                sizes.append(len(ids))
                held.append(ids)
                size += len(ids)
                if size >= SEGMENT:
                    yield _segment(shard, place, doc_ids, sizes, held)
                    place += 1
                    doc_ids, sizes, held, size = [], [], [], 0
        if doc_ids:
            yield _segment(shard, place, doc_ids, sizes, held)

    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("key", F.xxhash64("text"))
        .repartitionByRange(count, "doc_id", "key")
        .sortWithinPartitions("doc_id", "key")
    )
    ordered.select("doc_id", "text").mapInArrow(segments, SEGMENTS).write.parquet(path)


def _segment(shard: int, place: int, doc_ids: list, sizes: list[int], held: list[np.ndarray]) -> pa.RecordBatch:
    data = pack(doc_ids, sizes, np.concatenate(held))
    return pa.record_batch(
        [pa.array([shard], pa.int32()), pa.array([place], pa.int32()), pa.array([sum(sizes)]), pa.array([data])],
        names=["shard", "place", "ids", "segment"],
    )


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """shard, place, start: ids before each segment."""
    parts = spark.read.schema(SEGMENTS).parquet(path).select("shard", "place", "ids")
    shards = parts.groupBy("shard").agg(F.sum("ids").alias("all"))
    # One row for each shard, of which there are as many as shuffle partitions.
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("all").over(ahead), F.lit(0)).alias("first"))
    inner = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return parts.join(shards, "shard").select(
        "shard", "place", (F.col("first") + F.coalesce(F.sum("ids").over(inner), F.lit(0))).alias("start")
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from its decoded ids."""
    rows = spark.read.schema(SEGMENTS).parquet(path).join(segment_starts(spark, path), ["shard", "place"])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, segment in zip(batch.column("start").to_pylist(), batch.column("segment"), strict=True):
                doc_ids, sizes, ids = unpack(segment.as_py())
                ends = np.cumsum(sizes)
                crcs = [zlib.crc32(ids[e - n : e].astype("<u4")) for n, e in zip(sizes, ends, strict=True)]
                yield pa.record_batch(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(first + ends - sizes),
                        pa.array(sizes),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return rows.select("start", "segment").mapInArrow(
        documents, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def tokenized(docs: DataFrame, encode: Encode) -> DataFrame:
    """Documents written as token-ID files and read back."""
    spark = docs.sparkSession
    path = new_path(spark, "tokens")
    write_tokens(docs, path, encode)
    return read_tokens(spark, path)
