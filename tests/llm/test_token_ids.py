import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakecraft.llm.queries import tokenizer_path
from lakecraft.llm.tokenstore import MinimalPerfectHash, Shard, WordMemo, key_hashes, token_digests, token_ids, write_token_shards

TOKENIZER = Tokenizer.from_file(tokenizer_path())
ROWS = [(5, "Hello, world it's 2024!", ""), (2, None, ""), (9, "", ""), (None, "no id", ""), (3, "a | b|c <|endoftext|> |  x y\tz\r\n", ""), (3, "second", ""), (3, "second", ""), (11, "word " * 60_000, ""), (-4, "É́é ﬁ 漢字 𝔘", "")]


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


def brute(rows):
    out, at = [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = ids_of(text)
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), len(out)))
        at += len(ids)
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [[], ROWS, [(i, f"text {i} " * (i % 50), "") for i in range(400)]])
def test_round_trip(spark, rows):
    got = token_ids(spark.createDataFrame(rows, "doc_id long, text string, start string"), tokenizer_path(), shard_bytes=3000)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_keyed_access(spark):
    manifest = write_token_shards(spark.createDataFrame(ROWS, "doc_id long, text string, start string"), tokenizer_path(), order=["doc_id"], shard_bytes=1 << 60).collect()
    found = {(doc_id, copy): ids for m in manifest for doc_id in (5, 2, None, 3, -4, 77) for copy in (0, 1, 2) if (ids := Shard(m.path).get(doc_id, copy)) is not None}
    assert set(found) == {(5, 0), (2, 0), (None, 0), (3, 0), (3, 1), (3, 2), (-4, 0)}
    assert found[5, 0].tolist() == ids_of(ROWS[0][1]) and found[3, 2].tolist() == ids_of("second")


def test_perfect_hash_is_minimal():
    keys = key_hashes(np.arange(5000), np.ones(5000, bool), np.zeros(5000, np.int64))
    assert sorted(MinimalPerfectHash.build(keys).slots(keys)) == list(range(5000))
    with pytest.raises(ValueError):
        MinimalPerfectHash.build(np.array([3, 3], np.uint64))


LETTERS = "aAzZ09'stvrelmdÀéÉß×÷ªµ²ſİΣς.,|<>_-~\x00\x1c\x85\xa0\u0301\u200b\u2028漢ﬁ𝔘 \n\t\r"


MEMO = WordMemo(tokenizer_path())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(LETTERS, max_size=30), max_size=5))
def test_words_encode_as_whole_texts_do(texts):
    ids, n = MEMO.encode(pa.array(texts, pa.string()))
    assert MEMO.short and len(n) == len(texts)
    for text, own in zip(texts, np.split(ids, np.cumsum(n)[:-1]) if len(n) else [], strict=True):
        assert own.tolist() == ids_of(text), text


def test_rows_without_ids_are_dealt_over_shards(spark):
    rows = [(None, f"text number {i}") for i in range(400)] + [(1, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = write_token_shards(frame, tokenizer_path(), order=["doc_id"], shard_bytes=1000)
    assert max(r.docs for r in manifest.collect()) < 200
    got = sorted(token_digests(manifest).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(401)) and [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(401)]
    assert [r.doc_id for r in got] == [None] * 400 + [1]
