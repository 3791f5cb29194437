"""Exact top-k inner products by pivot distances.

With one more coordinate that brings all keys to the norm of the largest, the inner product with a query
(0 in that coordinate) falls as the distance grows, so the best products are the nearest neighbours.
Every key goes to its nearest pivot and lies there at its distance: annuli, sorted, cut into blocks. A
query that already knows ``k`` keys within radius ``r`` needs from pivot ``p`` only keys whose distance
to ``p`` is within ``r`` of its own, by the triangle inequality. The search goes outward:

1. a bounded sample of keys gives every query a first radius;
2. the annuli around the query's own distance to its own pivot shrink it;
3. what the radius still leaves of all pivots is read, and nothing beyond.

Equal vectors are one key that carries its smallest ids, and one query; a vector held by a third of all
rows costs no more than any other. Queries visit keys in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.blocks import blocked, visited
from ebbtide.llm.common import durable

#: Bounds of what is fitted on the driver: a sample of distinct keys, and pivots chosen from it.
SAMPLE = 2048
PIVOTS = 32
KEY_BLOCK = 1024
QUERY_BLOCK = 256
NO_ID = np.int64(-(1 << 63))


def finite(vector: Column) -> Column:
    """Not NULL, and without NULL or non-finite components."""
    inf = F.lit(float("inf"))
    return F.coalesce(
        F.forall(
            vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < inf)
        ),
        F.lit(False),
    )


def quantised(vector: Column, factor: float = 64.0) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("double"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = column.flatten().to_numpy()
    return out


class Space:
    """Pivots, and the distances of keys and queries to them."""

    def __init__(self, sample: np.ndarray, norm: float, pivots: int):
        self.norm, self.sample = norm, sample
        lifted = self.lifted(sample)
        chosen = [0] if len(sample) else []
        nearest = self._to(lifted, lifted[:1]).min(axis=1, initial=np.inf)
        while chosen and len(chosen) < pivots and nearest.max() > 0:
            chosen.append(int(np.argmax(nearest)))
            nearest = np.minimum(nearest, self._to(lifted, lifted[chosen[-1:]])[:, 0])
        self.pivots = lifted[chosen]

    def lifted(self, keys: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.norm - (keys * keys).sum(axis=1)))
        return np.column_stack([keys, rest])

    @staticmethod
    def _to(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
        return np.sqrt(np.maximum(0.0, squares))

    def of_keys(self, keys: np.ndarray) -> np.ndarray:
        return self._to(self.lifted(keys), self.pivots)

    def of_queries(self, queries: np.ndarray) -> np.ndarray:
        return self._to(np.column_stack([queries, np.zeros(len(queries))]), self.pivots)

    def radius(self, queries: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Distance at which the product falls to ``score``, with room for rounding."""
        square = (queries * queries).sum(axis=1) + self.norm - 2 * score
        return np.sqrt(np.maximum(0.0, square)) * (1 + 1e-9) + 1e-6


def _placed(vectors: DataFrame, space: Space, width: int, k: int, queries: bool) -> DataFrame:
    """``grp`` (nearest pivot), ``id``, ``far`` (distance to it) and ``data``: for a key its pivot,
    distance, vector and smallest ids; for a query the score to beat, its distance and its vector."""
    schema = "grp long, id long, far double, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch.column(1), width)
            to = space.of_queries(points) if queries else space.of_keys(points)
            own = to.argmin(axis=1)
            far = to[np.arange(len(own)), own]
            if queries:
                beat = np.full(len(points), -np.inf)
                if len(space.sample) > k:
                    # the sample's keys are distinct, and one of them may be the query itself
                    products = points @ space.sample.T
                    beat = np.partition(products, -k - 1, axis=1)[:, -k - 1]
                known = batch.column(2).fill_null(-np.inf).to_numpy(zero_copy_only=False)
                rows = np.column_stack([np.maximum(beat, known), far, points])
                data = [r.tobytes() for r in rows]
            else:
                ids = np.full((len(points), k + 1), NO_ID)
                lists = batch.column(2)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                ids[np.arange(k + 1)[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
                rows = np.column_stack([own, far, points])
                data = [r.tobytes() + i.tobytes() for r, i in zip(rows, ids, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), batch.column(0), pa.array(far), pa.array(data, pa.binary())],
                names=["grp", "id", "far", "data"],
            )

    return vectors.mapInArrow(run, schema)


def _rows(data, n: int, width: int, k: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a block's rows and, for keys, their ids."""
    raw = np.frombuffer(data, np.uint8).reshape(n, -1)
    numbers = np.ascontiguousarray(raw[:, : 8 * width]).view(np.float64)
    rest = raw[:, 8 * width :]
    return numbers, np.ascontiguousarray(rest).view(np.int64) if k is not None else np.zeros(0, np.int64)


def _annuli(blocks: DataFrame, width: int) -> DataFrame:
    """``grp, block, low, high``: the distances a block spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = [], []
            for n, data in zip(batch.column(2), batch.column(3), strict=True):
                far = _rows(data.as_buffer(), n.as_py(), width + 2, None)[0][:, 1]
                low.append(far.min())
                high.append(far.max())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(low), pa.array(high)],
                names=["grp", "block", "low", "high"],
            )

    columns = blocks.select("grp", "block", "n", "data")
    return columns.mapInArrow(run, "grp long, block long, low double, high double")


def _reach(blocks: DataFrame, space: Space, width: int) -> DataFrame:
    """``guest_grp, block, grp, from, to``: for each query block the distances it needs of each pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, block, n, data in zip(*batch.columns, strict=True):
                rows = _rows(data.as_buffer(), n.as_py(), width + 2, None)[0]
                points, beat = rows[:, 2:], rows[:, 0]
                to = space.of_queries(points)
                r = space.radius(points, beat)[:, None]
                pivots = len(space.pivots)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([group.as_py()] * pivots, pa.int64()),
                        pa.array([block.as_py()] * pivots, pa.int64()),
                        pa.array(np.arange(pivots)),
                        pa.array((to - r).min(axis=0)),
                        pa.array((to + r).max(axis=0)),
                    ],
                    names=["guest_grp", "block", "grp", "from", "to"],
                )

    columns = blocks.select("grp", "block", "n", "data")
    schema = "guest_grp long, block long, grp long, from double, to double"
    return columns.mapInArrow(run, schema)


def _searched(keys: DataFrame, queries: DataFrame, pairs: DataFrame, space: Space, width: int, k: int):
    """``query, id, score``: of each query block's meeting with a key block, per query the ``k + 1``
    best ids that reach the score to beat."""

    def visit(host_ids, host_data, ids, data, same):
        numbers, carried = _rows(host_data, len(host_ids), width + 2, k)
        pivot, far, points = int(numbers[0, 0]), numbers[:, 1], numbers[:, 2:]
        rows = _rows(data, len(ids), width + 2, None)[0]
        wanted, beat = rows[:, 2:], rows[:, 0]
        to = space.of_queries(wanted)[:, pivot]
        r = space.radius(wanted, beat)
        active = np.flatnonzero((to - r <= far.max()) & (to + r >= far.min()))
        products = wanted[active] @ points.T
        out_query, out_id, out_score = [], [], []
        held = (carried != NO_ID).sum(axis=1)
        for row, q in enumerate(active.tolist()):
            good = np.flatnonzero(products[row] >= beat[q])
            if not len(good):
                continue
            good = good[np.argsort(-products[row][good], kind="stable")]
            enough = np.searchsorted(np.cumsum(held[good]), k + 1)
            least = products[row][good[min(enough, len(good) - 1)]]
            good = good[products[row][good] >= least]
            found = carried[good]
            scores = np.repeat(products[row][good], held[good])
            flat = found[found != NO_ID]
            best = np.lexsort((flat, -scores))[: k + 1]
            out_query.append(np.full(len(best), ids[q]))
            out_id.append(flat[best])
            out_score.append(scores[best])
        if out_id:
            yield {
                "query": np.concatenate(out_query),
                "id": np.concatenate(out_id),
                "score": np.concatenate(out_score).astype(np.int64),
            }

    return visited(keys, queries, pairs, visit, "query long, id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` from ``vectors(vec_id, vector)``, all of them keys, those with
    ``is_query`` queries. Components are whole numbers (as doubles).

    The ``k`` largest inner products of every query, ties to the smaller id, the query's own row left
    out; fewer rows if there are fewer keys. Shorter vectors count as padded with zeros. Rows without id
    take no part; rows that share an id are one row when their vectors are equal. An empty table gives no
    rows."""
    rows = durable(
        vectors.filter("vec_id is not null")
        .select("vec_id", "vector", F.coalesce(is_query, F.lit(False)).alias("is_query"))
        .distinct()
    )
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    shape = rows.agg(F.max(square).alias("norm"), F.max(F.size("vector")).alias("width")).first()
    width, norm = shape["width"] or 0, shape["norm"] or 0.0
    # the k + 1 smallest ids of every distinct vector; the limit acts before the shuffle
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    keys = durable(
        rows.withColumn("_r", F.row_number().over(by_id))
        .filter(F.col("_r") <= k + 1)
        .groupBy("vector")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .select(F.get("ids", F.lit(0)).alias("id"), "vector", "ids")
    )
    asked = rows.filter("is_query")
    queries = durable(asked.groupBy("vector").agg(F.min("vec_id").alias("id")).select("id", "vector"))
    sample = keys.orderBy(F.xxhash64("vector"), "id").limit(SAMPLE).select("vector").collect()
    points = np.zeros((len(sample), width))
    for row, r in zip(points, sample, strict=True):
        row[: len(r["vector"])] = r["vector"]
    space = Space(points, norm, PIVOTS)

    order = [F.col("grp"), F.col("far"), F.col("id")]
    key_blocks = durable(
        blocked(_placed(keys, space, width, k, False), order, "long", KEY_BLOCK)
    )
    annuli = durable(_annuli(key_blocks, width))

    def query_blocks(known: DataFrame) -> DataFrame:
        placed = _placed(known.select("id", "vector", "beat"), space, width, k, True)
        return durable(blocked(placed, order, "long", QUERY_BLOCK))

    # around each query's own distance to its own pivot
    near = query_blocks(queries.withColumn("beat", F.lit(None).cast("double")))
    own = _annuli(near, width).select(
        F.col("grp").alias("guest_grp"), "block", F.col("low").alias("from"), F.col("high").alias("to")
    )
    close = own.join(
        annuli.withColumnRenamed("block", "host"),
        (F.col("guest_grp") == F.col("grp")) & (F.col("low") <= F.col("to")) & (F.col("high") >= F.col("from")),
    ).select("grp", "host", "guest_grp", "block")
    first = durable(_best(_searched(key_blocks, near, close, space, width, k), k + 1))
    beat = first.filter(F.col("rank") == k + 1).select(
        F.col("query").alias("id"), F.col("score").cast("double").alias("beat")
    )
    # the rest, as far out as each query's radius asks for
    wide = query_blocks(queries.join(beat, "id", "left"))
    rest = _reach(wide, space, width).join(
        annuli.withColumnRenamed("block", "host"), "grp"
    ).filter("low <= to and high >= from").select("grp", "host", "guest_grp", "block")
    every = _best(_searched(key_blocks, wide, rest, space, width, k), k + 1)
    best = every.select(F.col("query").alias("_query"), "id", "score")
    asked_by = asked.join(queries.withColumnRenamed("id", "_query"), "vector").select(
        F.col("vec_id").alias("query"), "_query"
    )
    answers = asked_by.join(best, "_query").filter("id <> query")
    return _best(answers, k).select(
        F.col("query").alias("query_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("vec_id"),
        "score",
    )
