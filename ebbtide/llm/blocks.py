"""Rows gathered to blocks, and blocks that visit one another.

A group of any size is cut into blocks of at most ``most`` rows with their vectors side by side, by a
range partitioning over (group, order), so that a large group lies in many partitions. Which blocks
have to meet is decided over their summaries; then each visiting block is sent to its hosts, sorted
behind the host, and a task holds one host and one visitor at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of results sent on together; most visits have few.
OUT_ROWS = 8192
BLOCK = "grp {group}, block long, n int, ids binary, data binary"

Visit = Callable[[np.ndarray, bytes, np.ndarray, bytes, bool], Iterator[dict]]


def blocked(
    rows: DataFrame, order: list[Column], group_type: str, most: int, most_bytes: int | None = None
) -> DataFrame:
    """Blocks of ``rows(grp, id long, data binary)``: ``grp, block, n, ids, data``, sorted by
    ``order`` inside a group. ``block`` is the smallest id in it; ids are unique within a group. With
    ``most_bytes`` a block ends too when its data reach that size."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, data, held = None, [], [], 0
        types = {}

        def flushed() -> pa.RecordBatch:
            own = np.array(ids, np.int64)
            values = [group, int(own.min()), len(ids), own.tobytes(), b"".join(data)]
            kinds = [types["grp"], pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, kinds, strict=True)],
                names=["grp", "block", "n", "ids", "data"],
            )

        for batch in batches:
            types["grp"] = batch.schema.field(0).type
            for g, i, d in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                full = len(ids) == most or (most_bytes is not None and held >= most_bytes)
                if ids and (g != group or full):
                    yield flushed()
                    ids, data, held = [], [], 0
                group = g
                ids.append(i)
                data.append(d)
                held += len(d)
        if ids:
            yield flushed()

    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.select("grp", "id", "data").mapInArrow(gather, BLOCK.format(group=group_type))


class _Results:
    """Results of visits, sent on together."""

    def __init__(self, schema: str):
        kinds = {"long": pa.int64(), "double": pa.float64()}
        self.names = [c.split()[0] for c in schema.split(", ")]
        self.types = [kinds[c.split()[1]] for c in schema.split(", ")]
        self.held: list[dict] = []
        self.rows = 0

    def add(self, outs: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        for out in outs:
            self.held.append(out)
            self.rows += len(out[self.names[0]])
            if self.rows >= OUT_ROWS:
                yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [np.concatenate([h[n] for h in self.held]) for n in self.names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, self.types, strict=True)], names=self.names
            )
        self.held, self.rows = [], 0


def with_itself(blocks: DataFrame, visit: Visit, schema: str) -> DataFrame:
    """``visit`` of every block to itself, where it lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results = _Results(schema)
        for batch in batches:
            for ids, data in zip(batch.column(0), batch.column(1), strict=True):
                own = np.frombuffer(ids.as_buffer(), np.int64)
                raw = data.as_buffer()
                yield from results.add(visit(own, raw, own, raw, True))
        yield from results.rest()

    return blocks.select("ids", "data").mapInArrow(run, schema)


def visited(
    hosts: DataFrame, guests: DataFrame, pairs: DataFrame, visit: Visit, schema: str
) -> DataFrame:
    """``visit(host_ids, host_data, ids, data, same)`` for every row of ``pairs(grp, host, guest_grp,
    block)``; it yields columns of ``schema``, whose fields are long or double. ``same`` says that the
    names of host and guest are equal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, host_ids, host_data = None, np.zeros(0, np.int64), b""
        results = _Results(schema)
        for batch in batches:
            for row in range(batch.num_rows):
                group, at, guest_group, guest = (batch.column(i)[row].as_py() for i in range(4))
                ids = np.frombuffer(batch.column(4)[row].as_buffer(), np.int64)
                data = batch.column(5)[row].as_buffer()
                if guest is None:
                    host, host_ids, host_data = (group, at), ids.copy(), data.to_pybytes()
                    continue
                if (group, at) != host:
                    raise RuntimeError("a guest came before its host")
                same = (guest_group, guest) == host
                yield from results.add(visit(host_ids, host_data, ids, data, same))
        yield from results.rest()

    called = pairs.select("grp", F.col("host").alias("block")).distinct()
    none = F.lit(None)
    home = hosts.join(called, ["grp", "block"], "left_semi").select(
        "grp",
        F.col("block").alias("host"),
        none.cast(pairs.schema["guest_grp"].dataType).alias("guest_grp"),
        none.cast("long").alias("block"),
        "ids",
        "data",
    )
    own = guests.select(F.col("grp").alias("guest_grp"), "block", "ids", "data")
    away = pairs.join(own, ["guest_grp", "block"]).select(home.columns)
    met = home.unionByName(away).repartition("grp", "host")
    ordered = met.sortWithinPartitions(
        "grp", "host", F.col("block").asc_nulls_first(), F.col("guest_grp").asc_nulls_first()
    )
    return ordered.mapInArrow(run, schema)


def met_within(blocks: DataFrame) -> DataFrame:
    """All pairs of blocks of one group, each once, and every block with itself."""
    names = blocks.select("grp", "block")
    met = names.withColumnRenamed("block", "host").join(names, "grp").filter("host <= block")
    return met.withColumn("guest_grp", F.col("grp"))
