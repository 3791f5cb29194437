"""Packing: round trip of the ids, the plan, and the edge cases."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ebbtide.llm.packing import (
    END_ID,
    _encoder,
    pack,
    pack_documents,
    sequences,
    shortest_pack_first,
    tokenized_pieces,
    vocabulary_path,
)

SCHEMA = "doc_id long, text string, start string, length string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "one two three"), (2, None), (3, ""), (1, "one two three"), (4, "long text " * 3000),
        (5, "ends with <|endoftext|> inside"), (6, "é日本\n\n  x"), (None, "no id"),
    ] + [(100 + i, "w " * i) for i in range(60)]
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)


def test_fast_ids_equal_the_tokenizers(tokenizer, spark, small):
    encode = _encoder(vocabulary_path())
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    texts += ["", " ", "a<|endoftext|>b", "\x00  ǅ 🎉🏽 ''s 12345", "x" * 5000]
    assert all(encode(t) == tokenizer.encode(t, add_special_tokens=False).ids for t in texts)


def test_round_trip(docs, tokenizer):
    pieces = tokenized_pieces(docs).cache()
    placed = pack(pieces, ["doc_id", "start", "ids_crc32"], buckets=4)
    rows = placed.collect()
    whole = {r.sequence_id: r.ids for r in sequences(placed).collect()}
    assert max(map(len, whole.values())) <= 1024
    assert sorted(whole) == list(range(len(whole)))
    for r in rows:  # every piece lies where it says
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert sum(r.length for r in rows) == sum(map(len, whole.values()))
    texts = {}
    for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id, r.start)):
        if r.doc_id != 1:  # the row that occurs twice
            texts.setdefault(r.doc_id, []).extend(r.ids)
    for d in docs.collect():
        if d.doc_id != 1:
            want = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [END_ID]
            assert texts[d.doc_id] == want
    assert sum(r.doc_id == 1 for r in rows) == 2


def test_query_form(docs):
    rows = pack_documents(docs).collect()
    assert rows[0].asDict().keys() == {
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert {(r.length, r.doc_tokens) for r in rows if r.doc_id in (2, 3)} == {(1, 1)}


def test_empty_table(docs):
    assert pack_documents(docs.limit(0)).count() == 0


def test_plan_packs_longest_first_into_the_emptiest():
    plan = shortest_pack_first({6: 1, 5: 2, 4: 1, 3: 1, 1: 2}, 10)
    filled = {}
    for length, rank, sequence, offset in zip(plan.length, plan.rank, plan.sequence, plan.offset):
        filled.setdefault(sequence, []).append((offset, length))
    assert plan.sequences <= 3


def test_plan_covers_every_rank_once():
    rng = random.Random(5)
    histogram = {rng.randint(1, 64): rng.randint(1, 10**9) for _ in range(40)}
    plan = shortest_pack_first(histogram, 64)
    for length, count in histogram.items():
        ranks = np.sort(plan.rank[plan.length == length])
        assert ranks[0] == 0 and ranks[-1] < count
    tokens = sum(k * v for k, v in histogram.items())
    alone = sum(v for k, v in histogram.items() if k > 32)  # no two of these share a sequence
    assert plan.sequences <= 1.25 * max(tokens / 64, alone)
