"""Repeated passages against all windows, and suffix arrays against sorting."""

import hashlib
import random
from collections import Counter

import pytest

from accordance.llm import op13_suffix_dedup as op13
from accordance.llm.queries import QUERIES
from accordance.llm.suffix_arrays import END, Shard
from accordance.llm.tables import table


def brute(rows, length=op13.LENGTH):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[s : s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        kept, spans, last, end = bytearray(), 0, False, 0
        for n in range(len(t)):
            if count[t[n : n + length]] > 1 and n + length <= len(t):
                end = n + length
            spans += n < end and not last
            last = n < end
            if not last:
                kept.append(t[n])
        out.append((doc_id, len(t), len(t) - len(kept), spans, hashlib.sha256(bytes(kept)).hexdigest()))
    return Counter(out)


def odd_rows():
    rng = random.Random(6)

    def words(n):
        return " ".join("".join(rng.choice("abcdeé日") for _ in range(rng.randrange(1, 9))) for _ in range(n))

    passage, other = words(120), words(150)
    texts = [None, "", "x", "a" * 399, "b" * 400, "c" * 401, "c" * 3000, "ab" * 500, "ab" * 500 + "!", "xyz" * 1000]
    texts += [words(200), passage, "pre " + passage, passage + " post", words(30) + passage + words(30) + passage + words(9)]
    texts += [other] * 3 + [other[:-1], other[1:], passage[:260] + other, "\0" * 900, "é" * 200, "é" * 500, words(3000)]
    texts += [words(60) + passage[n : n + 400] + words(40) for n in range(0, 60, 4)]
    line = words(15) + "\n"
    texts += [line * 40 + words(50), words(50) + line * 30]
    for n in range(60):  # near copies: a word changed
        w = other.split()
        w[rng.randrange(len(w))] = words(1)
        texts.append(" ".join(w))
    return [(None if n % 9 == 0 else n % 50, t) for n, t in enumerate(texts)]


@pytest.mark.parametrize("split, shard, piece, few", [(2048, 2 << 20, 1 << 19, 1000), (3, 4000, 500, 2)])
def test_odd_texts_equal_all_windows(spark, monkeypatch, split, shard, piece, few):
    for name, value in (("SPLIT", split), ("SHARD", shard), ("PIECE", piece), ("FEW", few)):
        monkeypatch.setattr(op13, name, value)
    rows = odd_rows()
    docs = spark.createDataFrame([(*r, 0, "h") for r in rows], "doc_id long, text string, k1 int, ctx string")
    got = op13.without_repeats(docs.repartition(3))
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert op13.without_repeats(docs.where("false")).count() == 0


def test_query_equals_all_windows(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in QUERIES["op13_suffix_dedup"](spark, sf_dir).collect())
    assert got == brute(rows)


def test_suffix_arrays_equal_sorting():
    rng = random.Random(1)
    for trial in range(200):
        signs = [0, 1, 255] if trial % 2 else b"ab"
        strings = [bytes(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(rng.randrange(1, 8))]
        depth = rng.choice([3, 7, 10, 30])
        shard = Shard(strings)
        order = shard.suffixes(depth)
        text = shard.signs.tolist()
        keys = [tuple(text[n : n + depth]) for n in order]
        assert sorted(order.tolist()) == list(range(len(text))) and keys == sorted(keys)
        common = shard.common(order)
        for n in range(1, len(order)):
            a, b, m = order[n - 1], order[n], 0
            while max(a, b) + m < len(text) and text[a + m] == text[b + m] != END:
                m += 1
            assert common[n] == m
