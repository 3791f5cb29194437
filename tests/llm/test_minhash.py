"""Near-duplicate documents against brute force."""

import gc
import random
import re
import weakref
from collections import Counter, defaultdict

import numpy as np
import pytest

from ebbtide.llm import common as C
from ebbtide.llm import minhash as M
from ebbtide.llm.common import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text, k):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)])


def brute(rows, k, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, sizes = defaultdict(list), [len(s) for s in sets]
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in holders[g])
        for j, n in common.items():
            if 100 * n >= percent * (sizes[i] + sizes[j] - n) and None not in (rows[i][0], rows[j][0]):
                x, y = find(rows[i][0]), find(rows[j][0])
                if x != y:
                    parent[max(x, y)] = min(x, y)
        for g in s:
            holders[g].append(i)
    return Counter((d, sizes[i], find(d), d == find(d)) for i, (d, _) in enumerate(rows))


def rows_for(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.choice([1, 2, 4, 8, 30, 150]))] for _ in range(25)]
    rows, n = [], 0
    for _ in range(350):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((n, rng.choice([" ", "\n", "\t "]).join(text)))
        n += rng.randint(1, 3)
    common = [rng.choice(words) for _ in range(60)]  # a passage that many share
    rows += [(5000 + i, " ".join(common + [rng.choice(words) for _ in range(rng.randint(5, 60))])) for i in range(80)]
    rows += [(6000, None), (6001, ""), (6002, " \n"), (6003, "ONE"), (6004, "one"), (6005, "é É"), (6006, "É é"), (None, "one")]
    rows += [rows[3], rows[3], (rows[5][0], rows[5][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, k, block", [(1, 2, 2048), (2, 5, 16)])
def test_equals_brute_force(spark, seed, k, block):
    rows = rows_for(seed)
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, sketch string").repartition(6)
    got = M.near_duplicates(df, M.NearConfig(shingle=k, block=block)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, k)
    assert M.near_duplicates(df.limit(0)).count() == 0


def test_last_step_alone_equals_brute_force(spark, monkeypatch):
    """Without merging rounds all that the hubs leave apart is found in clusters of several blocks."""
    monkeypatch.setattr(M, "SET_BYTES", 4000)
    monkeypatch.setattr(M, "COUNTED", 300)
    rows = rows_for(4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = M.near_duplicates(df, M.NearConfig(shingle=2, block=8, merge_rounds=0)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, 2)


@pytest.mark.parametrize("rate", [0.05, 0.03])
def test_a_group_of_near_copies_never_becomes_its_pairs(spark, monkeypatch, rate):
    """Most pairs of the group are promising, few or none reach the threshold."""
    rng, n = random.Random(5), 300
    base = [f"b{i}" for i in range(150)]
    rows = [(i, " ".join(f"x{rng.random()}" if rng.random() < rate else w for w in base)) for i in range(n)]
    sent, verify, across = [], M.verified, []

    def verified(pairs, docs, config):
        sent.append(pairs.count())
        return verify(pairs, docs, config)

    def components(edges):
        across.append(edges.count())
        return C.components(edges)

    monkeypatch.setattr(M, "verified", verified)
    monkeypatch.setattr(M, "components", components)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = M.near_duplicates(df, M.NearConfig(shingle=2)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, 2)
    assert sent and max(sent) <= n
    assert max(across) <= n * M.REGISTERS // M.BAND < n * n // 4


def test_long_text_beside_short_ones(spark):
    text = " ".join(f"v{i}" for i in range(60_000))
    rows = [(1, text), (2, text + " tail"), (3, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = M.near_duplicates(df).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, 5)


def test_estimates_are_close():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64) * np.uint64(2)
    for share in (0.5, 0.8, 0.95):
        n = 2000
        both = int(n * 2 * share / (1 + share))
        a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[:both], pool[n : 2 * n - both]]))
        sketch = M.registers(np.concatenate([a, b]), np.array([0, n, 2 * n]))
        close, used = M.estimates(sketch[:1], sketch[1:], np.array([n]), np.array([n]))
        assert used[0] == M.REGISTERS
        assert abs(close[0] - share) < 4 * np.sqrt(share * (1 - share) / M.REGISTERS)


def test_registers_match_their_definition():
    flat = np.sort(np.random.default_rng(2).integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2))
    sketch = M.registers(flat, np.array([0, len(flat)]))[0]
    for place in range(M.REGISTERS):
        own = [int(h) & ((1 << 57) - 1) for h in flat if int(h) >> 57 == place]
        if not own:
            assert sketch[place] == 0
            continue
        bits = format(min(own) >> 5, "052b")
        zeros = len(bits) - len(bits.lstrip("0"))
        head = (bits[zeros + 1 :] + "0" * 60)[: M.MANTISSA]
        assert sketch[place] == zeros * (1 << M.MANTISSA) + int(head, 2) + 1


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 180)] + [(500, i) for i in range(501, 600)] + [(7, 7), (900, 3), (3, 900)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(9)
    got = {r.id: r.component_id for r in components(df).collect()}
    want = {i: 100 for i in range(100, 181)} | {i: 500 for i in range(500, 600)} | {3: 3, 900: 3}
    assert got == want
    assert components(df.limit(0)).count() == 0


def random_edges(n, vertices, seed):
    rng = random.Random(seed)
    return [(rng.randrange(vertices), rng.randrange(vertices)) for _ in range(n)] + [(i, i + 1) for i in range(9000, 9080)]


def roots_of(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("rows_per_task", [1 << 17, 16])
def test_few_links_are_few_tasks(spark, monkeypatch, rows_per_task):
    """Many partitions of a few links end in one task; more links than a task takes give the same."""
    monkeypatch.setattr(C, "ROWS_PER_TASK", rows_per_task)
    edges = random_edges(300, 500, 3)
    found = components(spark.createDataFrame(edges, "a long, b long").repartition(40))
    got = [(r.id, r.component_id) for r in found.collect()]
    assert len(got) == len(dict(got)) and dict(got) == roots_of(edges)
    assert rows_per_task == 16 or found.rdd.getNumPartitions() == 1


def test_a_frame_that_was_run_is_let_go(spark):
    """Else the files of its shuffles stay until Python happens to look for cycles."""
    frames = [spark.range(100).repartition(3).groupBy("id").count()]
    held = weakref.ref(frames[0]._jdf)
    gc.disable()
    try:
        kept = C.durable(frames.pop())
        assert held() is None
    finally:
        gc.enable()
    assert kept.count() == 100
