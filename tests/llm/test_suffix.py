"""Repeated strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ebbtide.llm import suffix as S

LENGTH = 100


def brute(rows):
    rows = [(S.LAST_ID if d is None else d, d, (t or "").encode()) for d, t in rows]
    first = {}
    for order, _, raw in rows:
        for p in range(len(raw) - LENGTH + 1):
            w = raw[p : p + LENGTH]
            first[w] = min(first.get(w, (order, p)), (order, p))
    out = Counter()
    for order, d, raw in rows:
        gone = bytearray(len(raw))
        for p in range(len(raw) - LENGTH + 1):
            if first[raw[p : p + LENGTH]] < (order, p):
                gone[p : p + LENGTH] = b"\1" * LENGTH
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(gone[j] and (j == 0 or not gone[j - 1]) for j in range(len(gone)))
        out[d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def rows_for(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 6)))
    paragraphs = [" ".join(word() for _ in range(60)) for _ in range(10)]
    def one():
        parts = [rng.choice(paragraphs)[rng.randint(0, 80) :][: rng.randint(90, 260)] for _ in range(rng.randint(0, 5))]
        return " ".join(parts)
    rows = [(i, one()) for i in range(50)]
    rows += [
        (7, rows[7][1]), (7, paragraphs[0]), (None, paragraphs[1]), (None, paragraphs[1] + "x"), (100, None),
        (101, ""), (102, "a" * 1000), (103, "ab" * 300), (104, "a" * 99), (105, rows[3][1]), (106, "a" * 100),
        (107, "a" * 100), (108, "é" * 50), (-5, paragraphs[2]),
    ]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, hot", [(1, False), (2, True)])
def test_equals_brute_force(spark, monkeypatch, seed, hot):
    rows = rows_for(seed)
    df = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, doc string").repartition(5)
    if hot:  # every gram dealt out over three tasks
        docs = df.select(S.document().alias("doc"), S.F.coalesce("text", S.F.lit("")).alias("text"))
        keys = S._context_rows(docs, LENGTH, S.NO_HOT).select("key").distinct().collect()
        keys = np.sort(np.array([k.key for k in keys], np.int64))
        monkeypatch.setattr(S, "find_hot", lambda docs, length: S.Hot(keys, np.full(len(keys), 3)))
    got = S.remove_repeats(df, with_kept=True).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(rows)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)
    assert S.remove_repeats(df.limit(0)).count() == 0


def test_hot_grams_are_found(spark):
    common = "x".join(chr(97 + i % 23) * (i % 5) for i in range(200))
    df = spark.createDataFrame([(i, f"{i} {common} {i}") for i in range(3000)], "doc long, text string")
    hot = S.find_hot(df, LENGTH)
    assert len(hot.keys) and (hot.salts > 1).all()


def test_suffix_classes_follow_suffix_order():
    data = np.frombuffer(b"abracadabra" * 40, np.uint8)
    starts = np.arange(len(data) - LENGTH + 1)
    rank = S.suffix_classes(data, starts, LENGTH)
    strings = [data[s : s + LENGTH].tobytes() for s in starts]
    order = {s: i for i, s in enumerate(sorted(set(strings)))}
    assert rank.tolist() == [order[s] for s in strings]


def test_contexts_cover_every_window_once():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"abc ") for _ in range(n)) for n in (0, 99, 100, 101, 500, 3000, 5)]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    _, _, row, start, n = S.contexts(raw, offsets, LENGTH)
    seen = Counter((r, p) for r, a, m in zip(row, start, n) for p in range(a, a + m))
    want = {(i, p) for i, t in enumerate(texts) for p in range(len(t) - LENGTH + 1)}
    assert set(seen) == want and set(seen.values()) == {1}
    assert n.max() <= 127


def test_length_is_checked(spark):
    with pytest.raises(ValueError):
        S.remove_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"), length=20)


@pytest.mark.parametrize("seed", range(4))
def test_longest_previous_factors_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    length = [64, 100, 77, 127][seed]
    motif = rng.integers(0, 3, 150).astype(np.uint8)
    data = np.concatenate([
        rng.integers(0, 2, 300).astype(np.uint8), motif, motif[20:], motif[:90], rng.integers(0, 2, 200).astype(np.uint8),
        np.zeros(260, np.uint8), motif,
    ])
    starts = rng.permutation(len(data) - length + 1)[:900]
    earlier = rng.integers(0, 700, len(starts))  # with ties
    got = S.longest_previous_factors(data, starts, earlier, length)
    raw = data.tobytes()

    def agree(a, b):
        n = 0
        while n < length and raw[a + n] == raw[b + n]:
            n += 1
        return n

    for k in range(0, len(starts), 7):
        before = [starts[j] for j in np.flatnonzero(earlier < earlier[k])]
        assert got[k] == max((agree(starts[k], b) for b in before), default=0)


def test_previous_smaller_of_long_runs():
    rng = np.random.default_rng(1)
    for values in (np.arange(5000), np.arange(5000)[::-1], np.zeros(5000, np.int64), rng.integers(0, 50, 5000)):
        between = rng.integers(0, 100, len(values))
        got = S.previous_smaller(values, between)
        for k in range(0, len(values), 97):
            j = k - 1
            while j >= 0 and values[j] >= values[k]:
                j -= 1
            assert got[k] == (between[j + 1 : k + 1].min() if j >= 0 else 0)
