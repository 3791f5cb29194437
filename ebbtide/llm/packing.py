"""Packing token sequences: shortest-pack-first over the length histogram.

Documents are tokenised and cut into pieces of at most ``max_tokens``; only the last piece of a
document is shorter. The histogram of piece lengths has at most ``max_tokens`` entries, whatever
the corpus, so the packing itself is planned on the driver: lengths go longest first, each into
the pattern with the most room left (the shortest pack), and whole counts of equal patterns move
at once. The plan names, for each length, which ranks go to which sequences at which offset.
Pieces then take their rank within their length, in two steps so that a length held by a third
of all pieces is spread over many tasks, and look their place up in the plan.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import durable

MAX_TOKENS = 1024
END_ID = 0
RANK_BUCKETS = 4096
SPECIAL = "<|endoftext|>"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _encoder(path: str):
    """Ids of the vocabulary file. The same vocabulary as ranks, where it lies beside the file,
    is encoded several times faster; tests hold the two against each other."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def plain(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    try:
        import public_tokenizers
        import tiktoken

        with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding(
            "ranks",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={},
        )
    except (ImportError, OSError):
        return plain
    # texts that spell out a special token go to the tokenizer that knows it
    return lambda text: plain(text) if SPECIAL in text else fast.encode_ordinary(text)


PIECES = "start long, length long, ids_crc32 long, doc_tokens long"


def tokenized_pieces(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    max_tokens: int = MAX_TOKENS,
    vocabulary: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of every document: ``id, start, length, ids_crc32, doc_tokens`` and, on request,
    the ids themselves. NULL text is empty; every document ends with ``END_ID``, so an empty one
    is a single piece of length 1. ``vocabulary`` is a path every executor can open."""
    path = vocabulary or vocabulary_path()
    names = [id_column, "start", "length", "ids_crc32", "doc_tokens", *(["ids"] * with_ids)]
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {id_type}, {PIECES}" + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)

        def packed(keys: pa.Array, rows: list, took: list[int], ids: list) -> pa.RecordBatch:
            columns = [keys.take(pa.array(took, pa.int64()))]
            columns += [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            keys, rows, took, ids = batch.column(0), [], [], []
            for i, text in enumerate(batch.column(1)):
                own = np.array([*encode(text.as_py() or ""), END_ID], "<u4")
                for start in range(0, len(own), max_tokens):
                    piece = own[start : start + max_tokens]
                    rows.append((start, len(piece), zlib.crc32(piece.tobytes()), len(own)))
                    took.append(i)
                    if with_ids:
                        ids.append(piece.astype(np.int32))
                if len(rows) >= 4096:
                    yield packed(keys, rows, took, ids)
                    rows, took, ids = [], [], []
            if rows:
                yield packed(keys, rows, took, ids)

    return docs.select(
        F.col(id_column), F.col(text_column).cast("string")
    ).mapInArrow(cut, schema)


@dataclass(frozen=True)
class Plan:
    """Slots sorted by length, then by first rank: pieces of ``length`` with ranks from
    ``rank`` on go to sequences from ``sequence`` on, each at ``offset``."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def shortest_pack_first(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> Plan:
    """Plan for ``{length: count}``. Time and size depend on ``max_tokens`` alone."""
    # a pattern in the making: (used tokens, order of creation) -> (count, lengths)
    heap: list[tuple[int, int, int, tuple[int, ...]]] = []
    made = 0
    done: list[tuple[int, tuple[int, ...]]] = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= max_tokens:
            raise ValueError(f"length {length} is not in 1..{max_tokens}")
        while left:
            if heap and heap[0][0] + length <= max_tokens:
                used, _, count, lengths = heapq.heappop(heap)
                take = min(left, count)
                if count > take:
                    made += 1
                    heapq.heappush(heap, (used, made, count - take, lengths))
            else:  # the emptiest pattern has no room, so no pattern has
                used, take, lengths = 0, left, ()
            left -= take
            made += 1
            grown = (used + length, made, take, (*lengths, length))
            if grown[0] == max_tokens:
                done.append(grown[2:])
            else:
                heapq.heappush(heap, grown)
    done += [entry[2:] for entry in heap]
    slots: list[tuple[int, int, int, int]] = []
    ranks: dict[int, int] = {}
    sequence = 0
    for count, lengths in done:
        offset = 0
        for length in lengths:
            slots.append((length, ranks.get(length, 0), sequence, offset))
            ranks[length] = ranks.get(length, 0) + count
            offset += length
        sequence += count
    slots.sort()
    columns = np.array(slots, np.int64).reshape(-1, 4).T
    return Plan(*columns, sequences=sequence)


def _ranked(pieces: DataFrame, order: list[str], buckets: int) -> DataFrame:
    """``rank`` from 0 within each length. The order within a length is by hash bucket, then by
    ``order``; no task ever sees more than one bucket of one length together."""
    spread = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = spread.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    first = counts.select(
        "length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    inside = Window.partitionBy("length", "_bucket").orderBy(*order)
    return (
        spread.withColumn("_place", F.row_number().over(inside) - 1)
        .join(first, ["length", "_bucket"])
        .withColumn("rank", F.col("_first") + F.col("_place"))
        .drop("_bucket", "_place", "_first")
    )


def pack(
    pieces: DataFrame,
    order: list[str],
    max_tokens: int = MAX_TOKENS,
    buckets: int = RANK_BUCKETS,
) -> DataFrame:
    """``pieces`` (any columns, with ``length``) plus ``sequence_id`` and ``offset``.

    ``order`` names columns that tell pieces apart; rows equal in all of them are interchangeable.
    ``pieces`` is read twice, so it should be cheap to read (a checkpoint or a table).
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(
        F.count("*").alias("n")).collect()}  # at most max_tokens rows
    plan = shortest_pack_first(counts, max_tokens)
    ranked = _ranked(pieces, order, buckets)
    width = max(counts.values(), default=0) + 1
    first = plan.length * width + plan.rank

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        slot = np.searchsorted(first, length.to_numpy() * width + rank.to_numpy(), "right") - 1
        ids = plan.sequence[slot] + rank.to_numpy() - plan.rank[slot]
        return pd.DataFrame({"sequence_id": ids, "offset": plan.offset[slot]})

    placed = ranked.withColumn("_at", place("length", "rank"))
    return placed.select(*pieces.columns, "_at.sequence_id", "_at.offset")


def sequences(placed: DataFrame, ids_column: str = "ids") -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids`` from pieces placed with their ids.
    A sequence has at most ``max_tokens`` ids, so no group is large."""
    parts = F.array_sort(F.collect_list(F.struct("offset", ids_column)))
    return placed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p[ids_column])).alias("ids")
    )


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Placement of every piece of ``docs``: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``, without the ids. NULL and empty texts are one piece of one id;
    repeated rows are packed as often as they occur; an empty table gives no rows; further
    columns of ``docs`` are ignored."""
    pieces = durable(tokenized_pieces(docs, with_ids=False, **options))
    return pack(pieces, ["doc_id", "start", "ids_crc32"])
