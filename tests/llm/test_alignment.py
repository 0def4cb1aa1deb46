"""Tokenizer alignment against whole encodings and plain loops."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from accordance.llm import op12_alignment as op12
from accordance.llm.queries import BYTE_LEVEL, PIECES, QUERIES
from accordance.llm.tables import table


def encoded(texts):
    """Ids and end offsets of both tokenizers of whole texts, None where their tokens joined are another text."""
    own = op12._tokenizers(BYTE_LEVEL, PIECES)
    out = []
    for text in texts:
        if not text:
            out.append(None)
            continue
        a = own.a.encode(" " + text, add_special_tokens=False).ids
        b = own.b.encode(text)
        whole = (" " + text).encode()
        good = b"".join(own.bytes_a[n] for n in a) == whole == b"".join(own.bytes_b[n] for n in b)
        out.append((a, b) if good else None)
    return out


def brute(rows):
    own = op12._tokenizers(BYTE_LEVEL, PIECES)
    groups, count = [], Counter()
    for found in encoded([t for _, t in rows]):
        groups.append([])
        if not found:
            continue
        a, b = found
        i = j = at_a = at_b = 0
        left, right = [], []
        while i < len(a) or j < len(b):
            if at_a <= at_b and i < len(a):
                at_a += len(own.bytes_a[a[i]])
                left.append(a[i])
                i += 1
            else:
                at_b += len(own.bytes_b[b[j]])
                right.append(b[j])
                j += 1
            if at_a == at_b:
                groups[-1].append((left, right))
                left, right = [], []
        count.update({(x, y) for p, q in groups[-1] for x in p for y in q})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, _), own_groups in zip(rows, groups, strict=True):
        links = [(x, y) for p, q in own_groups for x in p for y in q]
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in own_groups)
        out.append((
            doc_id, sum(len(p) for p, _ in own_groups), sum(len(q) for _, q in own_groups), len(own_groups), len(links),
            sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if own_groups else "",
        ))
    return Counter(out)


ODD = [
    None, "", " ", "  ", "a", "a ", " a", "a  b", "a b", "\n", "a \nb", "a\n b", "x  y", "　a b", "a\x1c b c",
    "<|endoftext|> and <s> </s> <unk> <0x41>", "▁a b", "a ▁ b", "naïve café über 日本語 текст 🙂 é", "ﬁne ﬀ ½ ™", "\x00a b\x00", "don't 's 'll  x 12 345.6",
    "a" * 3000, " ".join(["tion"] * 4000), "x " * 50, "    " * 300, "日本" * 700, "\t\t a\t b", "the the the", "the the the",
]


@pytest.mark.parametrize("segment", [op12.SEGMENT, 64])
def test_odd_texts_equal_whole_encodings(spark, monkeypatch, segment):
    rng = random.Random(9)
    signs = ["a", "b", " ", " ", "\n", ".", "é", " ", "1", "'s", "日", "the ", " of", "▁", "\r", "-"]
    texts = ODD + ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 200))) for _ in range(200)]
    rows = [(None if n % 11 == 0 else n % 40, t) for n, t in enumerate(texts)]
    monkeypatch.setattr(op12, "SEGMENT", segment)
    own = op12.Tokenizers(BYTE_LEVEL, PIECES)
    table = [str(n).encode() + sign for sign in (b",", b"|", b";") for n in range(50257)]
    block = op12._Block(own, table)
    for row in rows:
        block.add(*row)
    got = block.row().to_pydict()["docs"][0]
    expected = Counter((r[0], *r[1:5], r[7]) for r in brute(rows).elements())
    assert Counter(tuple(r.values()) for r in got) == expected
    assert own.by_units
    if segment > 64:
        docs = spark.createDataFrame([(*r, 0, "p") for r in rows], "doc_id long, text string, n_a int, pair string")
        assert Counter(tuple(r) for r in op12.aligned(docs.repartition(4), BYTE_LEVEL, PIECES).collect()) == brute(rows)
        assert op12.aligned(docs.where("false"), BYTE_LEVEL, PIECES).count() == 0


def test_query_equals_plain_loops(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in QUERIES["op12_tokenizer_alignment"](spark, sf_dir).collect())
    assert got == brute(rows)


def test_runs_are_skipped_and_groups_resolved():
    rng = np.random.default_rng(2)
    for share in (0.0, 0.02, 0.5, 1.0):
        for size in (1, 5, 20_000):
            total = 4 * size
            offsets = np.arange(1, total)
            a = np.append(offsets[rng.random(total - 1) < 0.4], total)
            moved = np.where(rng.random(len(a)) < share, rng.integers(1, total + 1, len(a)), a)
            b = np.unique(np.append(moved, total))
            i, j = op12.align(a, b)
            assert (a[i] == np.intersect1d(a, b)).all() and (b[j] == a[i]).all()


def test_large_groups_pair_distinct_ids(monkeypatch):
    monkeypatch.setattr(op12, "LINKS", 6)
    a, b = np.array([1, 2, 1, 1, 5]), np.array([3, 3, 4, 6])
    groups = [np.array(c) for c in ([0, 4], [4, 1], [0, 3], [3, 1])]
    found = op12._summed(*zip(*op12._pairs(np.zeros(2, np.int64), a, b, *groups), strict=True))
    pairs = [((k >> 20) & 0xFFFFF, k & 0xFFFFF, n) for k, n in zip(*(c.tolist() for c in found), strict=True)]
    assert pairs == [(1, 3, 6), (1, 4, 3), (2, 3, 2), (2, 4, 1), (5, 6, 1)]
