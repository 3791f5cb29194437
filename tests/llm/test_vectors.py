"""Top-k search and near vectors against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import covertree as C
from ebbtide.llm import topk as T

INF, NAN = float("inf"), float("nan")


def vectors(seed, n, width, clusters):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width))
    spread = rng.choice([0.0, 0.02, 0.08, 0.3, 1.0], n)
    rows = centres[rng.integers(0, clusters, n)] + spread[:, None] * rng.normal(size=(n, width)) / math.sqrt(width)
    return rows.astype(np.float32)


ODD = [
    (5001, None, 1), (5002, [], 1), (5003, [0.0] * 8, 1), (5004, [NAN] + [1.0] * 7, 1), (5005, [INF] * 8, 1),
    (5006, [None] + [1.0] * 7, 1), (5007, [1.0, 2.0], 1), (5008, [1.0, 2.0], 1), (5009, [1.0] * 8, None),
    (None, [1.0] * 8, 1), (5010, [-1.0] * 8, 1), (5011, [2.0] * 8, 1), (5012, [1.0] * 8, 1), (5012, [1.0] * 8, 1),
    (-20, [0.5] * 8, 2), (5020, [-0.5] * 8, 1),
]


@pytest.fixture(scope="module")
def rows():
    own = [(i, v.tolist(), i % 3) for i, v in enumerate(vectors(1, 700, 8, 12))]
    own += [(800 + i, own[5][1], 2) for i in range(60)]  # a very common vector
    own += [(900 + i, [2 * x for x in own[7][1]], own[7][2]) for i in range(3)]
    return own + ODD


@pytest.fixture(scope="module")
def table(spark, rows):
    data = [(*r, "x", "y") for r in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, id string, grp string").repartition(6)


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize("k, sample, block", [(20, 2048, 1024), (3, 16, 64), (20, 8, 32)])
def test_top_k_equals_brute_force(table, rows, monkeypatch, k, sample, block):
    monkeypatch.setattr(T, "SAMPLE", sample)
    monkeypatch.setattr(T, "KEY_BLOCK", block)
    monkeypatch.setattr(T, "QUERY_BLOCK", block // 4)
    whole = {(i, tuple(math.floor(64 * np.float64(np.float32(x))) for x in v)) for i, v, _ in rows if i is not None and good(v)}
    width = max(len(v) for _, v in whole)
    whole = sorted((i, np.array(v + (0,) * (width - len(v)))) for i, v in {(i, v) for i, v in whole})
    want = {}
    for q, x in whole:
        if q % 20 == 0:
            scored = sorted((-int(x @ y), i) for i, y in whole if i != q)
            want[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    usable = table.filter(T.finite(F.col("embedding")))
    found = T.top_inner_products(
        usable.select("vec_id", T.quantised(F.col("embedding")).alias("vector")), F.col("vec_id") % 20 == 0, k
    ).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert got == want


def test_top_k_of_few_and_none(spark):
    schema = "vec_id long, vector array<double>"
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (20, [3.0])], schema)
    got = T.top_inner_products(few, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [
        (0, 1, 20, 3), (0, 2, 1, 2), (20, 1, 1, 6), (20, 2, 0, 3)]
    assert T.top_inner_products(few.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def brute_links(rows):
    usable = [
        i for i, (d, v, label) in enumerate(rows)
        if d is not None and label is not None and good(v) and any(x != 0 for x in v)
    ]
    parent = {d: d for d, _, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    n = [0] * len(rows)
    unit = {}
    for i in usable:
        v = np.array(rows[i][1], np.float32).astype(np.float64)
        unit[i] = v / np.sqrt(v @ v)
    for a in usable:
        for b in usable:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98:
                n[a] += 1
                n[b] += 1
                x, y = find(rows[a][0]), find(rows[b][0])
                if x != y:
                    parent[max(x, y)] = min(x, y)
    return sorted(
        (str(d), n[i], str(find(d)), d == find(d)) for i, (d, _, _) in enumerate(rows)
    )


@pytest.mark.parametrize("block", [2048, 40])
def test_near_vectors_equal_brute_force(table, rows, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    got = C.near_vectors(table).collect()
    want = brute_links(rows)
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == want
    assert sum(n for _, n, _, _ in want) > 4000
    assert C.near_vectors(table.limit(0)).count() == 0


def test_dual_traversal_finds_exactly_the_near_pairs():
    points = C._unit(vectors(3, 300, 8, 6).astype(np.float64))
    a, b = C.Tree(points[:180]), C.Tree(points[180:])
    near = np.zeros((180, 120), int)
    for level, left, right in C.near_pairs(a, b, 0.98):
        for i, j in zip(left, right):
            near[a.start[level][i] : a.start[level][i + 1], b.start[level][j] : b.start[level][j + 1]] += 1
    want = (points[:180] @ points[180:].T >= 0.98)[np.ix_(a.order, b.order)]
    assert (near == want).all() and want.sum() > 50


def test_tree_nodes_nest_and_shrink():
    points = C._unit(vectors(4, 200, 8, 5).astype(np.float64))
    tree = C.Tree(points)
    assert sorted(tree.order.tolist()) == list(range(200))
    for level in range(1, len(tree.start) - 1):
        assert set(tree.start[level - 1]) <= set(tree.start[level])
        assert tree.reach[level].max() <= 2.0 ** -(level - 1) + 1e-9


def test_spanning_labels():
    label = C._joined(np.arange(6), np.array([0, 3, 4]), np.array([3, 5, 1]))
    assert label.tolist() == [0, 1, 2, 0, 1, 0]


def test_shuffled_ids_do_not_matter(spark):
    rng = random.Random(1)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors(2, 120, 8, 3))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = C.near_vectors(df).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == brute_links(rows)
