import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from accordance.llm import op8_token_file as o
from accordance.llm import range_coder as r
from accordance.llm.queries import END_ID, TOKENIZER, op8_token_file

SCHEMA = "doc_id long, text string, segment string, shard int"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def expected(rows, tokenizer):
    """Rows with distinct ids, in order."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda x: (x[0] is not None, x[0])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        out.append((doc_id, start, len(ids), crc))
        start += len(ids)
    return out


def found(df):
    return sorted(map(tuple, df.collect()), key=lambda x: x[1])


def test_the_table_comes_back_from_its_files(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert found(op8_token_file(spark, sf_dir)) == expected([tuple(x) for x in docs], tokenizer)


def test_nulls_empty_long_and_repeated_texts(spark, tokenizer):
    rows = [(3, None), (1, ""), (2, "  "), (None, "null id"), (5, "many words " * 40_000), (4, "Größe, ŒUVRE İ <|endoftext|> a\x1fb 'S")]
    df = spark.createDataFrame([(*x, "s", 1) for x in rows], SCHEMA)
    encode = o.word_ids(TOKENIZER, END_ID)
    assert found(o.tokenized(df, encode)) == expected(rows, tokenizer)
    twice = found(o.tokenized(df.union(df), encode))
    assert len(twice) == 2 * len(rows) and twice[-1][1] + twice[-1][2] == 2 * sum(x[2] for x in expected(rows, tokenizer))
    assert o.tokenized(df.where("false"), encode).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs"])) | st.text("aB'sS t.,!? \n\x1f\x85\xa0É<|>é0"))
def test_encoding_by_runs_is_that_of_the_whole_text(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    (ids,) = o.word_ids(TOKENIZER, END_ID)([text])
    assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, END_ID]


@pytest.mark.parametrize("count", [0, 1, 5, r.BLOCK, r.BLOCK + 1, 3 * r.BLOCK - 1])
@pytest.mark.parametrize("kind", ["zipf", "even", "same", "cycle"])
def test_blocks_come_back(count, kind):
    rng = np.random.default_rng(3)
    ids = {
        "zipf": rng.zipf(1.3, count) % r.IDS, "even": rng.integers(0, r.IDS, count),
        "same": np.full(count, r.IDS - 1), "cycle": np.arange(count) % 50,
    }[kind]
    blocks = r.encode(ids)
    assert (r.decode(blocks, count) == ids).all()
    if kind in ("same", "cycle") and count >= r.BLOCK:
        assert sum(len(data) for data, _ in blocks) < count / 4


def test_each_block_can_be_decoded_alone():
    ids = np.random.default_rng(4).zipf(1.2, 2 * r.BLOCK + 100) % r.IDS
    blocks = r.encode(ids)
    assert (r.decode(blocks[1:2], r.BLOCK) == ids[r.BLOCK : 2 * r.BLOCK]).all()


def test_damage_is_found():
    segment = o.pack([1, None], [3, 2], np.array([5, 6, 7, 8, 9]))
    doc_ids, sizes, ids = o.unpack(segment)
    assert (doc_ids, sizes.tolist(), ids.tolist()) == ([1, None], [3, 2], [5, 6, 7, 8, 9])
    with pytest.raises(ValueError):
        r.encode(np.array([r.IDS]))
    random.seed(1)
    for at in (0, 35, len(segment) - 8):
        broken = bytearray(segment)
        broken[at] ^= 0x55
        with pytest.raises((ValueError, zlib.error)):
            o.unpack(bytes(broken))


def test_a_segment_needs_little_memory():
    """Coding holds few copies of the ids; an executor runs several tasks at once."""
    import tracemalloc

    ids = (np.random.default_rng(5).zipf(1.2, 1000 * r.BLOCK) % r.IDS).astype(np.uint16)
    tracemalloc.start()
    blocks = r.encode(ids)
    assert tracemalloc.get_traced_memory()[1] < 28 * len(ids)
    tracemalloc.reset_peak()
    assert (r.decode(blocks, len(ids)) == ids).all()
    assert tracemalloc.get_traced_memory()[1] < 28 * len(ids)
    tracemalloc.stop()


def test_runs_that_come_again_are_tokenized_once(monkeypatch):
    """What a task remembers is not dropped at once when it is full."""
    asked = []

    class Counting:
        model = property(lambda self: self)

        def tokenize(self, run):
            asked.append(run)
            return [type("Token", (), {"id": len(run)})]

    monkeypatch.setattr(o, "REMEMBERED", 3)
    known = o._Ids(Counting())
    for n in range(40):
        assert known["often"] == np.array([5], np.uint16).tobytes()
        assert known["x" * (6 + n)] == np.array([6 + n], np.uint16).tobytes()
    assert asked.count("often") == 1 and len(known) + len(known.older) <= 6


def test_the_bytes_of_blocks_are_fixed():
    """Files written before stay readable: the coder's output is part of the format."""
    rng = np.random.default_rng(8)
    ids = np.concatenate([rng.zipf(1.3, 5 * r.BLOCK) % r.IDS, rng.integers(0, r.IDS, 700), np.arange(900) % 50])
    blocks = r.encode(ids)
    assert zlib.crc32(b"".join(data for data, _ in blocks)) == 2685765603
    assert (r.decode(blocks, len(ids)) == ids).all()
