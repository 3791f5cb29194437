"""Mixing: targets, the schedule, and the words taken."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ebbtide.llm.mixing import (
    MixConfig,
    mix_documents,
    plan_sources,
    repeated,
    schedule,
    targets,
    word_count,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, size string, taken string"


def filled(sizes: dict) -> dict:
    """Targets by sharing the rest again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, goal, open_ = float(sum(sizes.values())), dict.fromkeys(names, 0.0), set(names)
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] > 3 * sizes[s]}
        if not full:
            goal.update({s: share * weight[s] for s in open_})
            break
        for s in full:
            goal[s] = 3.0 * sizes[s]
            left -= goal[s]
        open_ -= full
    return goal


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 1000, "c": 10, None: 5},
        {"a": 1, "b": 1, "c": 1000, "d": 1000, "é": 3, "Z": 7},
        {"a": 0, "b": 50},
        {"a": 0},
        {"only": 12},
        {f"s{i}": (i * 37) % 11 * 10 for i in range(30)},
    ],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in targets(rows).collect()}
    want = filled(sizes)
    assert got == pytest.approx(want)
    assert all(got[s] <= 3 * sizes[s] + 1e-9 for s in sizes)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "w " * (i % 41), "hot" if i % 3 else f"s{i % 7}", "x", "y") for i in range(900)]
    rows += [(5, None, "hot", "x", "y"), (6, "", None, "x", "y"), (7, " \t\n", "empty", "x", "y")]
    rows += [(8, "a b c", "hot", "x", "y")] * 3 + [(None, "d e", None, "x", "y"), (9, "z " * 30_000, "long", "x", "y")]
    return spark.createDataFrame(rows, SCHEMA).repartition(7)


def test_words_taken(docs):
    rows = mix_documents(docs).collect()
    assert len(rows) == docs.count()
    goals = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        goals.setdefault((r.target, r.source_size), [0, 0])
    by_source = {}
    source_of = {}
    for d in docs.collect():
        source_of.setdefault((d.doc_id, len(WORD.findall(d.text or ""))), set()).add(d.source)
    for r in rows:
        (source,) = source_of[r.doc_id, r["size"]]
        taken, size, target = by_source.get(source, (0, 0, 0))
        by_source[source] = (taken + r.taken, size + r["size"], r.target)
        assert r["size"] == 0 or r.source_size > 0
    for taken, size, target in by_source.values():
        assert taken == int(target + 1e-9)
    again = mix_documents(docs.repartition(3)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r["size"], r.taken)
    assert sorted(rows, key=key) == sorted(again, key=key)


def plain_mix(rows: list, hashes: dict) -> list:
    """Words taken of each ``(doc_id, text, source)``: every word of a source as often as its target goes
    round the source, and one more time up to where it ends, documents in the order of their hashes."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    goals, out = filled(sizes), []
    for source, size in sizes.items():
        own = [(doc, text) for doc, text, s in rows if s == source]
        own.sort(key=lambda r: ((hashes[r][0] % 2**64 >> 32) % 4096, hashes[r], r[0] is not None, r[0] or 0))
        words, start = int(goals[source] + 1e-9), 0
        for doc, text in own:
            n = len(WORD.findall(text or ""))
            over = max(0, min(start + n, words % size) - start) if size else 0
            out.append((doc, n, (words // size) * n + over if size else 0))
            start += n
    return out


def hashes_of(rows):
    """Hash of order and of text, by id and text."""
    text = F.xxhash64("text")
    found = rows.select("doc_id", "text", F.xxhash64(F.lit(17), "doc_id", text).alias("h"), text.alias("t"))
    return {(r.doc_id, r.text): (r.h, r.t) for r in found.collect()}


def test_words_of_each_document_equal_plain_python(docs):
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = Counter((r.doc_id, r["size"], r.taken) for r in mix_documents(docs).collect())
    assert got == Counter(plain_mix(rows, hashes_of(docs)))


def test_schedule_keeps_proportions_in_every_stretch(spark):
    rows = spark.createDataFrame([("a", 60_000), ("b", 90_000), ("c", 150_000)], "source string, size long")
    config = MixConfig(block_words=100)
    plan = plan_sources(targets(rows, config), config).cache()
    share = {r.source_id: r.high - r.low for r in plan.collect()}
    slots = schedule(plan, config).orderBy("slot").collect()
    need = {r.source_id: r.slots for r in plan.collect()}
    for s, n in need.items():
        assert sorted(r["rank"] for r in slots if r.source_id == s) == list(range(n))
    for start in range(0, 2500, 250):
        part = [r.source_id for r in slots if start <= r.slot < start + 250]
        for s, p in share.items():
            assert abs(part.count(s) - p * 250) < 6


def test_word_count(spark):
    texts = ["", " ", "a", " a\tb\x0bc\x0cd\r\ne ", "é x y", "a" * 100_000, None, "a\x1fb"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.n for r in df.select(word_count(df.text).alias("n")).collect()]
    assert got == [len(WORD.findall(t or "")) for t in texts]


def test_repeated_rows_follow_the_mix(docs):
    taken = {}
    for r in mix_documents(docs).collect():
        if r.doc_id not in (None, 5, 6, 7, 8, 9):
            taken[r.doc_id] = r.taken / r["size"] if r["size"] else 0
    out = repeated(docs)
    assert out.columns == docs.columns
    counts = {}
    for r in out.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    for d, share in taken.items():
        assert abs(counts.get(d, 0) - share) <= 0.5 + 1e-9


def test_empty_table(docs):
    assert mix_documents(docs.limit(0)).count() == 0
    assert repeated(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(docs):
    plan = mix_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
