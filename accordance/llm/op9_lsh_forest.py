"""N-gram Jaccard join: prefixes of trees of min-hashes, then exact verification.

Texts with the same words are one node.  The shingles of a node are its runs of five words (all words if
there are fewer).  There are ``trees`` trees of min-hashes; two nodes of similarity s share a prefix of
length d in one of T trees with chance 1 - (1 - s^d)^T.  The longest prefix whose chance at the threshold reaches the
target recall is taken once, from the threshold alone, and nodes that share it are candidates: this is banding with a
derived length, not a walk through sorted tries that shortens matched prefixes.

Candidates are compared in tiles of bounded size, so a bucket of any size is spread over many tasks; a
tile sends on a star of links for each group it finds, never its pairs.  A first comparison of all min-hashes drops what
is four standard deviations below the threshold; connected candidates then form clusters.  The shingles of
a cluster's texts are compared exactly, again in tiles, which count each node's links and send on stars of
links; those give the classes.

Result: doc_id, class_id (least doc_id of the class), n_links (other texts of at least the similarity), n_copies
(documents with the same words, itself included).

Defined results: documents without words (null, empty or marks only) are alone, n_copies 1.  Rows are told apart by
doc_id and text; repeated rows are copies of each other.  A null doc_id takes part; class_id is null if the class has no id.
Extra columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordance.llm.components import components
from accordance.llm.tables import bounded_batches, keep
from accordance.llm.tokens import chunks, mixed, runs

WORDS, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 20, 6, 0.9995
#: Nodes of one block of a tile.
BLOCK = 256
_FACTORS = mixed(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_ORDER = mixed(np.arange(100, 100 + WORDS, dtype=np.uint64)) | np.uint64(1)


def prefix_length(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which a pair of the threshold's similarity is found often enough."""
    length = depth
    while length > 1 and 1 - (1 - threshold**length) ** trees < recall:
        length -= 1
    return length


def shingles(words: np.ndarray) -> np.ndarray:
    """The distinct hashes of the runs of five words."""
    size = min(len(words), WORDS)
    if not size:
        return words
    count = len(words) - size + 1
    h = np.zeros(count, np.uint64)
    for k in range(size):
        h += words[k : k + count] * _ORDER[k]
    return np.unique(mixed(h))


def min_hashes(own: np.ndarray) -> np.ndarray:
    """A min-hash for each factor."""
    out = np.full(len(_FACTORS), np.uint64(2**64 - 1))
    for at in range(0, len(own), 2048):
        np.minimum(out, (_FACTORS[:, None] * own[None, at : at + 2048]).min(1), out=out)
    return out


def _documents(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The word hashes of each text."""
    for _, some in chunks(texts):
        doc, words = runs(some).words()
        yield from np.split(words, np.searchsorted(doc, np.arange(1, len(some))))


def digest_of(words: np.ndarray) -> bytes | None:
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest() if len(words) else None


def sketches(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, text_key, node (digest of the words), keys (a prefix for each tree), bits (a byte of each min-hash)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    trees = np.arange(TREES, dtype=np.uint64)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keys, bits = [], [], []
            for words in _documents(batch.column("text").to_pylist()):
                nodes.append(digest_of(words))
                if not len(words):
                    keys.append(None)
                    bits.append(None)
                    continue
                least = min_hashes(shingles(words))
                of_trees = least.reshape(TREES, DEPTH)
                h = trees + np.uint64(1)
                for k in range(length):
                    h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + of_trees[:, k])
                keys.append(h.view(np.int64))
                bits.append((least >> np.uint64(32)).astype(np.uint8).tobytes())
            yield pa.record_batch(
                [
                    batch.column("doc_id"), batch.column("text_key"), pa.array(nodes, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.binary()),
                ],
                names=["doc_id", "text_key", "node", "keys", "bits"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(
        sketch, f"doc_id {kind}, text_key long, node binary, keys array<bigint>, bits binary"
    )


def _tiled(members: DataFrame, key: str, blocks) -> DataFrame:
    """Each row once for each tile (i, j) of its group that it is in; ``block`` is its own.

    Nodes of a tile are in order, so that the first of a group, the middle of its star, is the same in
    most tiles of the group.
    """
    block = F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int")
    rows = members.withColumn("blocks", blocks.cast("int")).withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other)
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    return rows.drop("blocks", "other").repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "node")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of whole groups, and where each group starts; groups are neighbours equal in the first columns."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
        cut = _starts(table, keys)
        if len(cut) > 1:
            yield table.slice(0, cut[-1]), cut[:-1]
        rest = table.slice(cut[-1])
    if rest is not None:
        yield rest, np.zeros(1, np.int64)


def _starts(table: pa.Table, keys: int) -> np.ndarray:
    """Where any of the first columns differs from the row before."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for n in range(keys):
        column = table.column(n).combine_chunks()
        if pa.types.is_binary(column.type):
            values = np.array(column.to_pylist(), dtype=object)
        else:
            values = column.to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _pairs(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a tile: within its one block, or between its two."""
    values = np.unique(block)
    if len(values) == 1:
        return np.triu_indices(len(block), 1)
    first, second = np.flatnonzero(block == values[0]), np.flatnonzero(block == values[1])
    return np.repeat(first, len(second)), np.tile(second, len(first))


def _labels(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each row is connected with."""
    label = np.arange(size)
    while len(a):
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def candidate_stars(tiles: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) of a star for each group of a tile whose min-hashes agree often enough."""
    hashes = TREES * DEPTH
    least = threshold - 4 * math.sqrt(threshold * (1 - threshold) / hashes)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _groups(batches, 3):
            nodes = table.column("node").to_pylist()
            bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(-1, hashes)
            block = table.column("block").to_numpy()
            ends = np.append(starts[1:], table.num_rows)
            twos = starts[(ends - starts == 2)]
            a, b = [twos], [twos + 1]
            found_a, found_b = [], []
            for start, end in zip(starts, ends, strict=True):
                if end - start > 2:
                    first, second = _pairs(block[start:end])
                    a.append(first + start)
                    b.append(second + start)
                    if sum(map(len, a)) > 100_000:
                        _agree(bits, a, b, least, found_a, found_b)
            _agree(bits, a, b, least, found_a, found_b)
            x, y = np.concatenate(found_a), np.concatenate(found_b)
            label = _labels(len(nodes), x, y)
            own = np.flatnonzero(label != np.arange(len(nodes)))
            yield pa.record_batch(
                [pa.array([nodes[n] for n in own], pa.binary()), pa.array([nodes[n] for n in label[own]], pa.binary())],
                names=["a", "b"],
            )

    return tiles.select("key", "i", "j", "block", "node", "bits").mapInArrow(compare, "a binary, b binary")


def _agree(bits, a: list, b: list, least: float, found_a: list, found_b: list) -> None:
    """Moves the pairs whose min-hashes agree to what is found."""
    none = np.zeros(0, np.int64)
    x, y = np.concatenate([none, *a]), np.concatenate([none, *b])
    good = np.zeros(len(x), bool)
    for at in range(0, len(x), 50_000):
        part = slice(at, at + 50_000)
        good[part] = (bits[x[part]] == bits[y[part]]).mean(1) >= least
    found_a.append(x[good])
    found_b.append(y[good])
    a.clear()
    b.clear()


def common(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two sets share."""
    sizes = [len(s) for s in sets]
    _, element = np.unique(np.concatenate(sets), return_inverse=True)
    doc = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(element, kind="stable")
    element, doc = element[order], doc[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    cuts = np.searchsorted(element, np.arange(0, int(element[-1]) + width + 1, width))
    for n, (start, end) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        x = np.zeros((len(sets), width), np.float32)
        x[doc[start:end], element[start:end] - n * width] = 1
        out += x @ x.T
    return out


def verified(tiles: DataFrame, threshold: float) -> DataFrame:
    """node, root and links: exact links of each node within its tiles, and a star for each group."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _groups(batches, 3):
            out: list[tuple[bytes, bytes, int]] = []
            for start, end in zip(starts, np.append(starts[1:], table.num_rows), strict=True):
                part = table.slice(start, end - start)
                nodes, block = part.column("node").to_pylist(), part.column("block").to_numpy()
                if len(nodes) < 2:
                    continue
                sets = [shingles(w) for w in _documents(part.column("text").to_pylist())]
                size = np.array([len(s) for s in sets], np.float32)
                shared = common(sets)
                a, b = _pairs(block)
                both = shared[a, b]
                good = both >= threshold * (size[a] + size[b] - both) - 1e-6
                a, b = a[good], b[good]
                links = np.bincount(a, minlength=len(nodes)) + np.bincount(b, minlength=len(nodes))
                label = _labels(len(nodes), a, b)
                out += [(nodes[n], nodes[label[n]], int(links[n])) for n in range(len(nodes)) if links[n]]
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.record_batch(
                [
                    pa.array(columns[0], pa.binary()),
                    pa.array(columns[1], pa.binary()),
                    pa.array(columns[2], pa.int64()),
                ],
                names=["node", "root", "links"],
            )

    return tiles.select("cluster", "i", "j", "block", "node", "text").mapInArrow(
        verify, "node binary, root binary, links long"
    )


def similar_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_key, class_id, n_links, n_copies and class_node of each document.

    class_node names the class, also if none of it has an id; it is null for documents without words.
    """
    bounded_batches(docs.sparkSession)
    found = keep(sketches(docs, prefix_length(threshold)), "sketches")
    texts = keep(
        found.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"),
            F.count("*").alias("n_copies"),
            F.first("keys").alias("keys"),
            F.first("bits").alias("bits"),
        ),
        "texts",
    )
    prefixes = texts.select("node", F.explode("keys").alias("key"))
    buckets = keep(prefixes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    # Sides that grow with the documents are merged at every size.
    members = prefixes.join(buckets.hint("merge"), "key").join(texts.select("node", "bits").hint("merge"), "node")
    tiles = _tiled(members, "key", F.ceil(F.col("n") / BLOCK))
    stars = keep(candidate_stars(tiles, threshold).distinct(), "stars")
    clusters = components(stars)
    sizes = keep(clusters.groupBy("root").agg(F.count("*").alias("n")), "sizes")
    clusters = keep(
        clusters.join(sizes, "root")
        .select("node", F.col("root").alias("cluster"), "n")
        .join(texts.select("node", "first"), "node")
        .select("node", "cluster", "n", F.col("first.doc_id").alias("own_id"), F.col("first.text_key").alias("own_key")),
        "clusters",
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key"))
    # One row of each node: repeated rows share doc_id and text.
    own = rows.join(clusters.hint("merge"), same).select("node", "cluster", "n", "text").dropDuplicates(["node"])
    tiles = _tiled(own, "cluster", F.ceil(F.col("n") * 2 / BLOCK))
    exact = keep(verified(tiles, threshold), "verified")
    classes = components(exact.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = exact.groupBy("node").agg(F.sum("links").alias("n_links"))
    of_class = keep(
        texts.select("node", "first.doc_id", "n_copies").join(classes, "node", "left").join(links, "node", "left"),
        "nodes",
    )
    ids = keep(
        of_class.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("doc_id").alias("class_id")), "classes"
    )
    nodes = keep(
        of_class.select("node", F.coalesce("root", "node").alias("root"), "n_copies", "n_links").join(ids, "root"),
        "nodes",
    )
    return found.select("doc_id", "text_key", "node").join(nodes, "node", "left").select(
        "doc_id",
        "text_key",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.col("root").alias("class_node"),
    )


def one_of_each_class(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The document with the least doc_id of each class (one of equal rows), and all without words."""
    rows = keep(similar_classes(docs, threshold), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    each = rows.groupBy("class_node", "doc_id", "text_key").agg(F.count("*").alias("n"))
    firsts = rows.where("class_node IS NOT NULL").groupBy("class_node").agg(F.min(order).alias("first"))
    own = F.col("e.class_node") == F.col("f.class_node")
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    stay = keep(
        each.alias("e")
        .join(firsts.alias("f"), own, "left")
        .where(F.col("e.class_node").isNull() | first)
        .select("doc_id", "text_key", F.when(F.col("e.class_node").isNull(), 1).otherwise(F.col("n")).alias("n")),
        "stay",
    )
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.xxhash64("d.text") == F.col("s.text_key"))
    once = docs.alias("d").join(stay.where("n = 1").alias("s").hint("merge"), same, "left_semi")
    # Equal rows of one class: the first that comes.
    several = docs.alias("d").join(keep(stay.where("n > 1"), "several").alias("s"), same, "left_semi")
    return once.unionByName(several.dropDuplicates(["doc_id", "text"]))
