"""What several of the operators need: reliable checkpoints, scratch folders, hashing in NumPy
and connected components."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.sources.scratch import remove_path, scratch_path, shared_dir

__all__ = ["remove_path", "scratch_path", "shared_dir"]

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Rows of two or three numbers that are worth a task of their own.
ROWS_PER_TASK = 1 << 17


def _let_go(spark: SparkSession) -> None:
    """Lets Spark delete what was shuffled for frames that are of no more use. py4j holds a frame that was
    run in a cycle, which Python's collector ends; then the driver's collector finds its shuffles."""
    gc.collect()
    spark._jvm.System.gc()


def durable(df: DataFrame) -> DataFrame:
    """Computed now and kept in the shared folder: survives lost executors, and is not computed
    again by each consumer. ``spark.cleaner.referenceTracking.cleanCheckpoints`` removes it when
    no frame refers to it any more.

    What was shuffled on the way is of no more use then. Spark deletes it when the driver's garbage
    collector finds that out, so that is asked for here and does not wait for a full heap: before the
    work too, as py4j tells the driver up to a second late."""
    spark = df.sparkSession
    shared_dir(spark)
    _let_go(spark)
    kept = df.checkpoint()
    del df
    _let_go(spark)
    return kept


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column as one array, and the offsets of its rows (NULL: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the text of one holds about ``most`` bytes; a longer row alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(
            zero_copy_only=False
        )
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def gathered(kept: DataFrame, rows: int) -> DataFrame:
    """A ``durable`` frame of that many short rows in no more tasks than they are worth. What a shuffle
    leaves of a few links is a file, a task and a Python worker a partition, and each of them again in
    every later step."""
    return kept.coalesce(max(1, -(-rows // ROWS_PER_TASK)))


def _forest(batches: Iterator[pa.RecordBatch], roots: bool = False) -> Iterator[pa.RecordBatch]:
    """Edges of a partition reduced to one star per local component; with ``roots`` the middle of a star
    is one of its rows."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def stars() -> pa.RecordBatch:
        pairs = [(x, r) for x in parent if (r := find(x)) != x or roots]
        parent.clear()
        columns = [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, names=["id", "component_id"] if roots else ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        if len(parent) > 1_000_000:  # bounded memory: what is known goes out
            yield stars()
    yield stars()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(id, component_id)`` for the ends of ``edges(a, b)``: the smallest id reachable.

    Partitions first shrink their edges to stars. What is left goes to as many tasks as its number asks
    for, which shrink it again; a single one has joined everything. Of more, alternating large-star and
    small-star rounds (Kiveris et al.) hang every vertex on the smallest vertex it knows, until nothing
    changes. Each round aggregates with map-side combining and is checkpointed.
    """
    pairs = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    stars = durable(pairs.filter("a <> b").mapInArrow(_forest, "a long, b long"))
    rows = stars.count()
    stars = gathered(stars, rows)
    if rows <= ROWS_PER_TASK:
        return durable(stars.mapInArrow(partial(_forest, roots=True), "id long, component_id long"))
    links = durable(stars.mapInArrow(_forest, "a long, b long").distinct())

    def star(links: DataFrame, large: bool) -> DataFrame:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        if not large:
            both = links.select(
                F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
            )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        joined = both.join(least.withColumn("m", F.least("u", "m")), "u")
        if large:
            moved = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            )
        return moved.filter("a <> b").distinct()

    before = None
    for _ in range(most_rounds):
        links = durable(star(star(links, True), False))
        mark = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    roots = links.groupBy("a").agg(F.min("b").alias("component_id"))
    return durable(
        roots.select(F.col("a").alias("id"), "component_id").unionByName(
            links.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()
        )
    )
