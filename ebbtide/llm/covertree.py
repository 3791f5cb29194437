"""Near-duplicate vectors by dual traversal of cover trees: exact cosine threshold pairs.

On the unit sphere a cosine of ``t`` is a distance of ``sqrt(2 - 2t)``. Vectors of one group lie in
blocks of near neighbours (ordered by the nearest node of a top net over a bounded sample). Every block
has a cover tree: nested nodes whose radius halves from level to level, each with the exact distance of
its farthest descendant. Two trees, or a tree and itself, are traversed together: a pair of nodes that
cannot hold a pair of near vectors is dropped, a pair of nodes all of whose vectors are near counts as a
whole, all others go on to their children, in the end to vectors whose cosines decide.

So neither links inside a dense node nor links between such nodes are ever listed: links are counted by
node, and components need only as many edges as there are vectors. Equal vectors are one vector with a
count from the start. Pairs of blocks are dropped by the same bound before any block is sent.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.blocks import blocked, met_within, visited
from ebbtide.llm.common import components, durable
from ebbtide.llm.topk import finite

BLOCK = 1024
#: Bounds of the top net: sample on the driver, and nodes.
SAMPLE = 2048
NODES = 256
TOP_RADIUS = 1.0
LEVELS = 6  # radii 1, 1/2, ... 1/32; below that vectors
CHUNK = 1 << 15
#: Children of a node pair from which on they are compared as matrices.
DENSE = 256
SLACK = 1e-9


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of unit vectors, all to all."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def _top_net(points: np.ndarray) -> np.ndarray:
    """Greedy net: nodes farther than ``TOP_RADIUS`` from one another, the farthest next."""
    chosen = [0] if len(points) else []
    nearest = _distances(points, points[:1]).min(axis=1, initial=np.inf)
    while chosen and len(chosen) < NODES and nearest.max() > TOP_RADIUS:
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, _distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


class Tree:
    """Cover tree of a block. ``order`` lists its vectors so that a node of any level is a stretch.

    Level ``l`` has nodes ``start[l][i]`` to ``start[l][i + 1]`` whose first vector is the centre, and
    ``reach[l][i]``, the distance of its farthest vector; ``child[l]`` is the first node of the next
    level in each node. The last level's nodes hold one vector each."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        order, borders = np.arange(n), [np.array([0, n])]
        for level in range(LEVELS):
            order, borders_here = self._split(points, order, borders[-1], 2.0**-level)
            borders.append(borders_here)
        borders.append(np.arange(n + 1))
        self.order, self.start = order, borders
        self.points = points[order]
        self.reach = []
        for border in borders:
            centre = np.repeat(border[:-1], np.diff(border))
            cosine = np.einsum("ij,ij->i", self.points, self.points[centre])
            far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))
            self.reach.append(np.maximum.reduceat(far, border[:-1]))
        self.child = [
            np.searchsorted(below, above) for above, below in zip(borders, borders[1:], strict=False)
        ]

    @staticmethod
    def _split(points, order, border, radius):
        """Nodes of one level: in every node above, its centre comes first, then the next vector not
        yet covered, until all are covered. A node that its centre covers stays whole."""
        parts, sizes = [], []
        for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True):
            left = order[a:b]
            while len(left):
                near = _distances(points[left], points[left[:1]])[:, 0] <= radius
                near[0] = True
                parts.append(left[near])
                sizes.append(len(parts[-1]))
                left = left[~near]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])


def _chunks(counts: np.ndarray, most: int) -> Iterator[slice]:
    """Stretches whose counts sum to about ``most``."""
    ends = np.cumsum(counts)
    start = 0
    while start < len(counts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield slice(start, stop)
        start = stop


def near_pairs(a: Tree, b: Tree, least_cosine: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(level, nodes of a, nodes of b)`` all of whose vectors reach ``least_cosine`` with one another;
    together they are all such pairs of vectors.

    Node pairs with many children compare them as two matrices, the others gather theirs pair by pair;
    either way no more than ``CHUNK`` pairs are held at a time, besides the numbers of open ones."""
    limit = math.sqrt(max(0.0, 2.0 - 2.0 * least_cosine))
    last = len(a.start) - 1

    def judged(level: int, cosine: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs are near as a whole, and which stay open."""
        if level == last:
            return cosine >= least_cosine, np.zeros(cosine.shape, bool)
        apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))
        whole = apart + reach <= limit - SLACK
        return whole, ~whole & (apart - reach <= limit + SLACK)

    stack = [(0, np.zeros(1, np.int64), np.zeros(1, np.int64))]  # open pairs
    while stack:
        level, left, right = stack.pop()
        first_a, n_a = a.child[level][left], a.child[level][left + 1] - a.child[level][left]
        first_b, n_b = b.child[level][right], b.child[level][right + 1] - b.child[level][right]
        level += 1
        centre_a, centre_b = a.start[level][:-1], b.start[level][:-1]
        reach_a, reach_b = a.reach[level], b.reach[level]
        dense = n_a * n_b >= DENSE
        for i in np.flatnonzero(dense):
            own_b = np.arange(first_b[i], first_b[i] + n_b[i])
            step = max(1, CHUNK // len(own_b))
            for low in range(first_a[i], first_a[i] + n_a[i], step):
                own_a = np.arange(low, min(low + step, first_a[i] + n_a[i]))
                cosine = a.points[centre_a[own_a]] @ b.points[centre_b[own_b]].T
                whole, on = judged(level, cosine, reach_a[own_a, None] + reach_b[own_b])
                x, y = np.nonzero(whole)
                if len(x):
                    yield level, own_a[x], own_b[y]
                x, y = np.nonzero(on)
                if len(x):
                    stack.append((level, own_a[x], own_b[y]))
        few = ~dense
        first_a, n_a, first_b, n_b = first_a[few], n_a[few], first_b[few], n_b[few]
        for part in _chunks(n_a * n_b, CHUNK):
            counts = n_a[part] * n_b[part]
            of = np.repeat(np.arange(len(counts)), counts)
            step = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
            x = first_a[part][of] + step // n_b[part][of]
            y = first_b[part][of] + step % n_b[part][of]
            cosine = np.einsum("ij,ij->i", a.points[centre_a[x]], b.points[centre_b[y]])
            whole, on = judged(level, cosine, reach_a[x] + reach_b[y])
            if whole.any():
                yield level, x[whole], y[whole]
            if on.any():
                stack.append((level, x[on], y[on]))


def _packed(vectors: DataFrame, net: dict[int, np.ndarray]) -> DataFrame:
    """``grp, id, node, far, data`` of ``(grp, id, copies, vector)``."""
    schema = "grp string, id long, node int, far double, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, fars, data = [], [], []
            for copies, vector in zip(batch.column(2), batch.column(3), strict=True):
                values = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                unit = _unit(values[None, :])
                same = net[len(values)] if len(values) in net else unit
                to = _distances(unit, same)[0]
                nodes.append(int(to.argmin()))
                fars.append(float(to.min()))
                data.append(np.append(float(copies.as_py()), unit[0]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(nodes, pa.int32()),
                    pa.array(fars, pa.float64()),
                    pa.array(data, pa.binary()),
                ],
                names=["grp", "id", "node", "far", "data"],
            )

    return vectors.select("grp", "id", "copies", "vector").mapInArrow(run, schema)


def _block_rows(data, n: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(data, np.float64).reshape(n, -1)
    return numbers[:, 0].astype(np.int64), numbers[:, 1:]


def _balls(blocks: DataFrame) -> DataFrame:
    """``grp, block, centre, reach`` of every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centres, reach = [], []
            for n, data in zip(batch.column(2), batch.column(3), strict=True):
                points = _block_rows(data.as_buffer(), n.as_py())[1]
                mean = points.mean(axis=0)
                size = np.sqrt((mean * mean).sum())
                centre = mean / size if size > 1e-6 else points[0]
                centres.append(centre.tobytes())
                reach.append(float(_distances(points, centre[None, :]).max()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(centres, pa.binary()), pa.array(reach)],
                names=["grp", "block", "centre", "reach"],
            )

    columns = blocks.select("grp", "block", "n", "data")
    return columns.mapInArrow(run, "grp string, block long, centre binary, reach double")


def _joined(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``label`` names each vertex's component by its smallest vertex; the same with further edges."""
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return label
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        label = label.copy()
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def _links(blocks: DataFrame, pairs: DataFrame, least_cosine: float) -> DataFrame:
    """``a, b, n``: edges that span the linked vectors (``n`` -1), and numbers of links of ``a``."""
    last: dict = {}

    def tree_of(ids, data) -> tuple[Tree, np.ndarray, np.ndarray]:
        copies, points = _block_rows(data, len(ids))
        tree = Tree(points)
        return tree, copies[tree.order], ids[tree.order]

    def visit(host_ids, host_data, ids, data, same):
        if last.get("ids") is not host_ids:
            last.update(ids=host_ids, tree=tree_of(host_ids, host_data))
        tree, copies, names = last["tree"]
        other, other_copies, other_names = last["tree"] if same else tree_of(ids, data)
        n, m = len(names), len(other_names)
        counts, other_counts = np.zeros(n, np.int64), np.zeros(m, np.int64)
        weight = np.concatenate([[0], np.cumsum(copies)])
        other_weight = np.concatenate([[0], np.cumsum(other_copies)])
        # vertices of the graph: vectors of the host, then those of the guest
        shift = 0 if same else n
        label = np.arange(n if same else n + m)
        for level, left, right in near_pairs(tree, other, least_cosine):
            first_a, end_a = tree.start[level][left], tree.start[level][left + 1]
            first_b, end_b = other.start[level][right], other.start[level][right + 1]
            # a stretch gains as much at its start as it loses behind its end
            gained = other_weight[end_b] - other_weight[first_b]
            np.add.at(step := np.zeros(n + 1, np.int64), first_a, gained)
            np.add.at(step, end_a, -gained)
            counts += np.cumsum(step)[:-1]
            if not same:
                gained = weight[end_a] - weight[first_a]
                np.add.at(step := np.zeros(m + 1, np.int64), first_b, gained)
                np.add.at(step, end_b, -gained)
                other_counts += np.cumsum(step)[:-1]
            for first, end, centre, side, across in (
                (first_a, end_a, first_b, 0, shift),
                (first_b, end_b, first_a, shift, 0),
            ):
                sizes = end - first
                of = np.repeat(np.arange(len(sizes)), sizes)
                member = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                label = _joined(label, member + side, centre[of] + across)
        if same:
            counts -= copies  # every vector is near itself
        all_names = names if same else np.concatenate([names, other_names])
        tied = np.flatnonzero(label != np.arange(len(label)))
        yield {"a": all_names[tied], "b": all_names[label[tied]], "n": np.full(len(tied), -1)}
        all_counts = counts if same else np.concatenate([counts, other_counts])
        some = np.flatnonzero(all_counts)
        yield {"a": all_names[some], "b": all_names[some], "n": all_counts[some]}

    return visited(blocks, blocks, pairs, visit, "a long, b long, n long")


def near_vectors(vectors: DataFrame, least_cosine: float = 0.98) -> DataFrame:
    """One row per row of ``vectors(vec_id, embedding, label)``: ``vec_id, n_links, component_id, kept``.

    Vectors are compared when their labels are equal, and linked at a cosine of ``least_cosine`` or more.
    Vectors that are NULL, empty, zero or hold NULL or non-finite components, rows without label and rows
    without id link with nothing, and vectors of different lengths do not link. Rows that share an id
    share their component; equal rows are vectors of their own. An empty table gives no rows; further
    columns are ignored."""
    rows = vectors.select("vec_id", "embedding", "label")
    usable = (
        finite(F.col("embedding"))
        & F.col("label").isNotNull()
        & F.col("vec_id").isNotNull()
        & F.exists("embedding", lambda x: x != 0)
    )
    group = F.concat_ws(":", F.col("label").cast("string"), F.size("embedding").cast("string"))
    grouped = rows.filter(usable).select("vec_id", group.alias("grp"), F.col("embedding").alias("vector"))
    classes = durable(
        grouped.groupBy("grp", "vector")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    )
    sample = classes.orderBy(F.xxhash64("vector"), "grp").limit(SAMPLE).select("vector").collect()
    by_width: dict[int, list] = {}
    for r in sample:
        by_width.setdefault(len(r["vector"]), []).append(r["vector"])
    net = {w: _top_net(_unit(np.array(v, np.float64))) for w, v in by_width.items()}

    order = [F.col("grp"), F.col("node"), F.col("far"), F.col("id")]
    blocks = durable(blocked(_packed(classes, net), order, "string", BLOCK))
    limit = math.sqrt(max(0.0, 2.0 - 2.0 * least_cosine))

    @F.pandas_udf("boolean")
    def may_touch(a, b, reach_a, reach_b):
        import pandas as pd

        apart = [
            math.sqrt(max(0.0, 2.0 - 2.0 * float(np.frombuffer(x) @ np.frombuffer(y))))
            for x, y in zip(a, b, strict=True)
        ]
        return pd.Series(np.array(apart) - reach_a - reach_b <= limit + SLACK)

    balls = durable(_balls(blocks))
    side = lambda name, c: balls.select(
        "grp", F.col("block").alias(name), F.col("centre").alias(f"{c}c"), F.col("reach").alias(f"{c}r")
    )
    pairs = (
        met_within(blocks)
        .join(side("host", "a"), ["grp", "host"])
        .join(side("block", "b"), ["grp", "block"])
        .filter((F.col("host") == F.col("block")) | may_touch("ac", "bc", "ar", "br"))
        .select("grp", "host", "guest_grp", "block")
    )
    links = durable(_links(blocks, pairs, least_cosine))
    counts = links.filter("n >= 0").groupBy("a").agg(F.sum("n").alias("others"))
    roots = components(links.filter("n < 0").select("a", "b"))
    known = (
        classes.join(counts, classes.id == counts.a, "left")
        .drop("a")
        .join(roots.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left")
        .select(
            "grp",
            "vector",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
    )
    marked = rows.withColumn("grp", F.when(usable, group))
    out = marked.join(known, (marked.grp == known.grp) & (marked.embedding == known.vector), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
