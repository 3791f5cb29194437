"""Phrase and proximity matches against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ebbtide.llm import positional as P

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    phrases = set()
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        phrases |= {(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1) if n}
    out = Counter()
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, phrase in phrases:
            n = len(phrase)
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) == phrase:
                    hit |= set(range(p, p + n))
                    found |= {item} - {None}
        listed = ",".join(sorted(map(str, found)))
        out[doc, len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)] += 1
    return out


def rows_for(seed, n=60):
    rng = random.Random(seed)
    common = ["Ab", "cd", "É", "x9", "the", "the", "the", "straße", "ÀB", "k"]
    line = lambda k: " ".join(rng.choice(common) for _ in range(k))
    items = [(i, line(rng.choice([1, 3, 9, 10, 11, 25]))) for i in range(12)]
    items += [(3, items[4][1]), (None, line(12)), (90, None), (91, ""), (92, " .\x00; "), (93, "zz " * 30)]
    docs = []
    for i in range(n):
        parts = [line(rng.randint(0, 30)) for _ in range(rng.randint(0, 3))]
        for _ in range(rng.randint(0, 3)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(len(w) - 1, 0))
            parts.insert(rng.randint(0, len(parts)), rng.choice([", ", "\n", "-"]).join(w[a : a + rng.randint(1, 25)]))
        docs.append((i, ".".join(parts)))
    docs += [(None, items[5][1]), (7, items[6][1]), (7, items[6][1]), (500, None), (501, ""), (502, "zz " * 40)]
    docs += [(600 + i, "the " * 50) for i in range(20)]
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
        spark.createDataFrame(items, "item_id bigint, text string").repartition(2),
    )


@pytest.mark.parametrize("seed", range(3))
def test_report_equals_brute_force(spark, monkeypatch, seed):
    docs, items = rows_for(seed)
    monkeypatch.setattr(P, "BLOCK_WORDS", [1 << 18, 40, 7][seed])  # one block, several, many
    monkeypatch.setattr(P, "SEGMENT", [1 << 20, 500, 1][seed])
    monkeypatch.setattr(P, "STARTS", [1 << 20, 10, 1][seed])
    d, b = frames(spark, docs, items)
    extra = d.withColumns({"id": F.lit("x"), "segment": F.lit(1), "words": F.lit(None), "row": F.lit(2)})
    got = P.decontaminate(extra, b.withColumns({"first": F.lit(3), "n": F.lit("y")}))
    assert Counter(map(tuple, got.collect())) == brute(docs, items)


def test_runs_are_longest_and_in_place(spark):
    item = " ".join(f"w{i}" for i in range(40))
    doc = "before " + " ".join(f"w{i}" for i in range(5, 25)) + " X " + " ".join(f"W{i}," for i in range(20, 40))
    d, b = frames(spark, [(1, "other text"), (2, doc)], [(9, item)])
    got = P.phrase_matches(P.build_index(d), b)
    rows = sorted((r.id, r.item_id, r.item_start, r.start, r.n_words) for r in got.collect())
    assert rows == [(2, 9, 5, 1, 20), (2, 9, 20, 22, 20)]


def test_long_test_text_is_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(P, "PIECE_WORDS", 16)
    rng = random.Random(5)
    w = [rng.choice("abcdefgh") for _ in range(300)]
    docs = [(i, " ".join(w[a : a + 14])) for i, a in enumerate(range(0, 286, 3))]
    d, b = frames(spark, docs, [(1, " ".join(w))])
    assert Counter(map(tuple, P.decontaminate(d, b).collect())) == brute(docs, [(1, " ".join(w))])


def test_index_is_read_by_several_test_sets(spark):
    docs, items = rows_for(9)
    d, b = frames(spark, docs, items)
    index = P.build_index(d)
    for part in (b, b.filter("item_id < 4")):
        kept = [tuple(r) for r in part.select("item_id", "text").collect()]
        report = P.contamination_report(index, P.phrase_matches(index, part))
        got = Counter((r.id, r.n_hit, r.n_items) for r in report.collect())
        want = Counter()
        for (doc, _, hit, n, _, _), times in brute(docs, kept).items():
            want[doc, hit, n] += times
        assert got == want


def test_empty_tables(spark):
    docs, items = rows_for(1, 5)
    d, b = frames(spark, docs, items)
    assert P.decontaminate(d.limit(0), b).collect() == []
    clean = P.decontaminate(d, b.limit(0)).collect()
    assert len(clean) == len(docs) and not any(r.contaminated for r in clean)


def test_words_of_long_and_broken_texts():
    text = "Ä" * 200_000 + " a" * 100_000 + "\x7f{`@/\x00 Zz09"
    assert [w.decode() for w in P.words_of(text.encode())] == words(text)


def near_brute(docs, queries, within):
    out = Counter()
    for doc, text in docs:
        w = words(text)
        for q, query in queries:
            need = set(words(query))
            spans = [
                (i, j)
                for i in range(len(w))
                for j in range(i, min(i + within, len(w)))
                if need and need <= set(w[i : j + 1])
            ]
            for i, j in spans:
                if not any((a, b) != (i, j) and i <= a and b <= j for a, b in spans):
                    out[doc, q, i, j - i + 1] += 1
    return out


@pytest.mark.parametrize("within", [1, 4, 12])
def test_proximity_equals_brute_force(spark, monkeypatch, within):
    docs, _ = rows_for(4, 25)
    queries = [(1, "ab cd"), (2, "The x9 k"), (3, "É"), (4, "nowhere ab"), (5, None), (6, ""), (7, "the the ab"), (8, "straße àb É k")]
    monkeypatch.setattr(P, "SEGMENT", 600)
    d, q = frames(spark, docs, queries)
    got = P.proximity_matches(P.build_index(d), q, within)
    rows = Counter((r.id, r.item_id, r.start, r.n_words) for r in got.collect())
    assert rows == near_brute(docs, queries, within)


def test_proximity_refuses_what_reaches_over_texts(spark):
    d, b = frames(spark, [(1, "a")], [(1, "a")])
    with pytest.raises(ValueError):
        P.proximity_matches(P.build_index(d), b, P.GAP + 1)
