"""Near-duplicate documents by HyperMinHash sketches.

A document's set of word shingles is sketched in 128 registers. A register keeps, for the smallest hash
of its part of the hash space, the number of leading zeros and ten mantissa bits (two bytes in all).
Bands of four registers give the candidates: two sets with a Jaccard similarity of 0.8 share no band
with a probability of 5e-8. Then:

1. Equal sets are one class from the start, whatever their number.
2. Within a bucket every set is paired with the bucket's smallest id. The collision-corrected estimate
   from the registers drops pairs that cannot reach the threshold; of the others each set verifies the
   one with the highest estimate on the full sets, and what is confirmed is joined to components.
3. Only pairs of one bucket that are still in different components can add anything. They are estimated
   in blocks of a bucket, so that a large one is many tasks. A few merging rounds verify for every set
   only its best partner outside its component, in a few of its buckets; as a rule that joins what
   belongs together.
4. At last the sets that still have promising pairs are put in clusters: what such pairs connect. Of a
   block's pairs only those go out that connect more of it, fewer than it has rows. A set is in one
   cluster and goes there whole; blocks of a cluster visit one another, every promising pair still apart
   is verified on the full sets where the two blocks lie, and only links that join components go out.

So no link is lost, a group of any size never becomes rows of its pairs, linked or not, and a bucket has
no cap.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.blocks import Visit, blocked, met_within, visited, with_itself
from ebbtide.llm.common import (
    components,
    durable,
    gathered,
    mixed,
    remove_path,
    scratch_path,
    slices,
    text_bytes,
)

REGISTERS = 128
REGISTER_BITS = 7
MANTISSA = 10
BAND = 4
SLICE_BYTES = 2 << 20
#: Standard errors by which an estimate may miss the threshold: one pair in two million.
MARGIN = 4.9
#: Pairs of sketches compared at a time.
PAIRS = 4096
#: Pairs of texts that are Python strings at a time.
TEXTS = 256
#: Bytes of full sets in a block, and members of sets counted at a time.
SET_BYTES = 4 << 20
COUNTED = 1 << 18

# A random odd multiplier, its inverse modulo 2**64, and a multiplier for chaining.
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CHAIN = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class NearConfig:
    shingle: int = 5
    percent: int = 80
    block: int = 2048
    merge_rounds: int = 2
    merge_buckets: int = 4


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows in order, A-Z lower-cased, and each word's row."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    before = np.concatenate([[True], space[:-1]])
    first = offsets[:-1]
    before[first[first < n]] = True
    starts = np.flatnonzero(~space & before)
    after = np.concatenate([before[1:], [True]]) | np.concatenate([space[1:], [True]])
    ends = np.flatnonzero(~space & after) + 1
    lower = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    values = mixed(np.arange(1, 257, dtype=np.uint64) * _P)[lower]
    power = np.full(n, _P, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    values *= power
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    # the sum over a word, moved to exponent 0 by the inverse of the power at its start
    inverse = np.full(n, _P_INVERSE, np.uint64)
    inverse[0] = 1
    np.cumprod(inverse, out=inverse)
    hashes = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(offsets, starts, "right") - 1


def shingle_sets(
    raw: np.ndarray, offsets: np.ndarray, shingle: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted within each row, and the border of each row."""
    words, row = word_hashes(raw, offsets)
    rows = len(offsets) - 1
    counts = np.bincount(row, minlength=rows)
    hashes = words.copy()
    full = np.ones(len(words), bool)
    for j in range(1, shingle):
        if len(words) > j:
            hashes[:-j] = mixed(hashes[:-j] * _CHAIN + words[j:])
            full[:-j] &= row[:-j] == row[j:]
        full[-j:] = False
    out, sizes = [], np.zeros(rows, np.int64)
    ends = np.cumsum(counts)
    for i in np.flatnonzero(counts):
        a, b = ends[i] - counts[i], ends[i]
        if counts[i] < shingle:  # the whole sequence as one, told apart by its length
            whole = words[a : a + 1]
            for j in range(a + 1, b):
                whole = mixed(whole * _CHAIN + words[j : j + 1])
            own = mixed(whole ^ np.uint64(counts[i]))
        else:
            own = np.unique(hashes[a:b][full[a:b]])
        out.append(own)
        sizes[i] = len(own)
    flat = np.concatenate(out) if out else np.zeros(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def registers(flat: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """``uint16`` registers of each sorted set; 0 is an empty register."""
    rows = len(borders) - 1
    sketch = np.zeros(rows * REGISTERS, np.uint16)
    if len(flat):
        row = np.repeat(np.arange(rows), np.diff(borders))
        place = row * REGISTERS + (flat >> np.uint64(64 - REGISTER_BITS)).astype(np.int64)
        smallest = np.concatenate([[True], place[1:] != place[:-1]])
        rest = (flat[smallest] << np.uint64(REGISTER_BITS)) >> np.uint64(12)  # 52 bits
        length = np.frexp(rest.astype(np.float64))[1]  # significant bits
        zeros = np.uint64(52) - length.astype(np.uint64)
        head = (rest << (zeros + np.uint64(1))) & np.uint64((1 << 52) - 1)
        bits = head >> np.uint64(52 - MANTISSA)
        sketch[place[smallest]] = (zeros * np.uint64(1 << MANTISSA) + bits + np.uint64(1)).astype(
            np.uint16
        )
    return sketch.reshape(rows, REGISTERS)


def band_keys(sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the bands with at least one register, and which bands those are."""
    bands = sketch.reshape(len(sketch), REGISTERS // BAND, BAND).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, REGISTERS // BAND + 1, dtype=np.uint64), bands.shape[:2])
    for j in range(BAND):
        keys = mixed(keys * _CHAIN + bands[:, :, j])
    return keys.view(np.int64), (bands > 0).any(axis=2)


def estimates(
    a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard similarity of sketches, corrected for registers that agree by chance, and the number of
    registers it rests on."""
    used = ((a > 0) | (b > 0)).sum(axis=-1)
    equal = ((a == b) & (a > 0)).sum(axis=-1)
    ratio = np.maximum(na, nb) / np.maximum(1, np.minimum(na, nb))
    # Fixed value: expected share of accidental collisions for large sets of equal size.
    chance = used * 0.169919487159739 * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(0, equal - chance) / np.maximum(1, used), used


def promising(similarity: np.ndarray, used: np.ndarray, percent: int) -> np.ndarray:
    """Whether the true similarity may reach the threshold; few registers decide nothing."""
    t = percent / 100
    return (used < 24) | (similarity >= t - MARGIN * math.sqrt(t * (1 - t)) / np.sqrt(np.maximum(1, used)))


def _buckets(classes: DataFrame) -> DataFrame:
    """``rep, key`` for every band of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = b"".join(batch.column(1).to_pylist())
                keys, used = band_keys(np.frombuffer(raw, np.uint16).reshape(-1, REGISTERS))
                reps = np.repeat(batch.column(0).to_numpy(), used.sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reps), pa.array(keys[used])], names=["rep", "key"]
                )

    return classes.select("rep", "sketch").mapInArrow(run, "rep long, key long")


def _texts(docs: DataFrame, config: NearConfig, emit, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            flat, borders = shingle_sets(*text_bytes(batch.column("text")), config.shingle)
            yield emit(batch.column("doc_id"), flat, borders)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def sketches(docs: DataFrame, config: NearConfig) -> DataFrame:
    """``doc_id, n_shingles, set_id, sketch``; ``set_id`` is NULL for an empty set."""

    def emit(ids: pa.Array, flat: np.ndarray, borders: np.ndarray) -> pa.RecordBatch:
        sketch = registers(flat, borders)
        sizes = np.diff(borders)
        named = [
            hashlib.md5(flat[a:b].tobytes(), usedforsecurity=False).digest() if b > a else None
            for a, b in zip(borders[:-1], borders[1:], strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array(sizes, pa.int64()),
                pa.array(named, pa.binary()),
                pa.array([s.tobytes() for s in sketch], pa.binary()),
            ],
            names=["doc_id", "n_shingles", "set_id", "sketch"],
        )

    schema = "doc_id long, n_shingles long, set_id binary, sketch binary"
    return _texts(docs, config, emit, schema)


def _linked(
    left: list[str], right: list[str], shingle: int, percent: int
) -> Iterator[bool]:
    """Whether the sets of pairs of texts reach the threshold. Some pairs at a time; each text of them is
    hashed once, together with the others."""
    start = 0
    while start < len(left):
        texts: dict[str, int] = {}
        held, end = 0, start
        while end < len(left) and (held < SLICE_BYTES or end == start):
            for text in (left[end], right[end]):
                if text not in texts:
                    texts[text] = len(texts)
                    held += len(text)
            end += 1
        raw = [text.encode() for text in texts]
        borders = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        flat, at = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), borders, shingle)
        for a, b in zip(left[start:end], right[start:end], strict=True):
            x, y = (flat[at[texts[t]] : at[texts[t] + 1]] for t in (a, b))
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                yield False
                continue
            if len(x) > len(y):
                x, y = y, x
            common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(y) else 0
            yield 100 * common >= percent * (len(x) + len(y) - common)
        start = end


def verified(pairs: DataFrame, docs: DataFrame, config: NearConfig) -> DataFrame:
    """The ``pairs(a, b)`` whose full shingle sets reach the threshold.

    Texts travel, not sets, as they are smaller; the shuffle of the documents by id serves both ends of
    the pairs, and from there on only texts of candidates move."""
    percent, shingle = config.percent, config.shingle

    def linked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            flags: list[bool] = []
            for low in range(0, len(left), TEXTS):
                some = [side[low : low + TEXTS].to_pylist() for side in (left, right)]
                flags.extend(_linked(*some, shingle, percent))
            yield pa.array(flags, pa.bool_())

    linked.__annotations__ = {
        "batches": Iterator[tuple[pa.Array, pa.Array]],
        "return": Iterator[pa.Array],
    }
    reached = F.arrow_udf(linked, "boolean")
    right = pairs.join(docs, pairs.b == docs.doc_id).select("a", "b", F.col("text").alias("_right"))
    left = (
        pairs.select("a").distinct().join(docs, F.col("a") == docs.doc_id)
        .select("a", F.col("text").alias("_left"))
    )
    return right.join(left, "a").filter(reached("_left", "_right")).select("a", "b")


def near_duplicates(docs: DataFrame, config: NearConfig = NearConfig()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when their shingle sets have a Jaccard similarity of ``percent`` or more; the
    component is named by its smallest ``doc_id``. NULL and empty texts, and texts without words, have
    no shingles and are linked with nothing; fewer words than a shingle are one shingle. Rows that share
    a ``doc_id`` share its component. An empty table gives no rows; further columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    known = durable(sketches(docs, config))
    filled = known.filter("set_id is not null and doc_id is not null")
    classes = durable(
        filled.groupBy("set_id", "n_shingles").agg(
            F.min("doc_id").alias("rep"), F.min("sketch").alias("sketch")
        )
    )
    buckets = _buckets(classes)
    hubs = (
        buckets.groupBy("key")
        .agg(F.min("rep").alias("a"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("key", "a")
    )
    shared = durable(buckets.join(hubs, "key").select("key", "rep", "a"))
    hub_pairs = shared.filter("a <> rep").select("a", F.col("rep").alias("b")).distinct()
    percent = config.percent

    def reach(left: pa.Array, right: pa.Array, n_left: pa.Array, n_right: pa.Array) -> pa.Array:
        a = np.frombuffer(b"".join(left.to_pylist()), np.uint16).reshape(-1, REGISTERS)
        b = np.frombuffer(b"".join(right.to_pylist()), np.uint16).reshape(-1, REGISTERS)
        close, used = estimates(a, b, n_left.to_numpy(), n_right.to_numpy())
        return pa.array(np.where(promising(close, used, percent), close, -1.0))

    reach = F.arrow_udf(reach, "double")

    sketch = classes.select("rep", "sketch", "n_shingles")
    side = lambda c: sketch.select(*[F.col(x).alias(f"{c}{x}") for x in sketch.columns])
    candidates = (
        hub_pairs.join(side("b"), F.col("b") == F.col("brep"))
        .join(side("a"), F.col("a") == F.col("arep"))
        .filter(
            100 * F.least("an_shingles", "bn_shingles") >= percent * F.greatest("an_shingles", "bn_shingles")
        )
        .select("a", "b", reach("asketch", "bsketch", "an_shingles", "bn_shingles").alias("score"))
        .filter("score >= 0")
    )
    # the best hub of each set; what this leaves apart comes up again below
    best = candidates.groupBy("b").agg(F.max_by("a", F.struct("score", "a")).alias("a"))
    tested = durable(best.select("a", "b"))
    tested = gathered(tested, tested.count())
    parts = components(durable(verified(tested, docs, config)))
    path = None
    for turn in [*range(config.merge_rounds), None]:
        blocks = durable(_open_blocks(shared, parts, sketch, config, turn))
        if blocks.isEmpty():
            break
        if path is None:
            # only these documents can still be compared; their texts are all that later steps read
            path = scratch_path(docs.sparkSession, "open")
            _texts_of(blocks, docs).write.parquet(path)
            texts = docs.sparkSession.read.parquet(path)
        # the stars stand for all links found before
        known_links = parts.select(F.col("id").alias("a"), F.col("component_id").alias("b"))
        if turn is None:
            clusters = components(_connected(blocks, config))
            del blocks
            if clusters.isEmpty():
                break
            new = _joining(clusters, classes, parts, texts, config)
            parts = components(known_links.unionByName(new))
            break
        fresh = durable(_best_apart(blocks, config).join(tested, ["a", "b"], "left_anti"))
        del blocks
        count = fresh.count()
        if not count:
            continue
        fresh = gathered(fresh, count)
        new = durable(verified(fresh, texts, config))
        tested, parts = tested.unionByName(fresh), components(known_links.unionByName(new))
    if path is not None:
        remove_path(docs.sparkSession, path)
    named = classes.join(parts, classes.rep == parts.id, "left").select(
        "set_id", "n_shingles", F.coalesce("component_id", "rep").alias("component_id")
    )
    own = F.when(F.col("doc_id").isNotNull(), F.col("set_id")).alias("set_id")
    out = known.select("doc_id", "n_shingles", own).join(named, ["set_id", "n_shingles"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _long_bytes(name: str) -> Column:
    """The eight bytes of a long, big-endian."""
    return F.unhex(F.lpad(F.hex(F.col(name)), 16, "0"))


def _open_blocks(
    shared: DataFrame, parts: DataFrame, sketch: DataFrame, config: NearConfig, turn: int | None
) -> DataFrame:
    """Blocks of the buckets that hold more than one component; a row is its sketch, component, set
    size and bucket. In a merging ``turn`` a set goes to a few of its open buckets only, those that come
    first in an order by hash: alike sets choose alike."""
    placed = shared.join(parts, shared.rep == parts.id, "left").select(
        "key", "rep", F.coalesce("component_id", "rep").alias("component")
    )
    open_keys = (
        placed.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .filter("lo < hi")
        .select("key")
    )
    rows = placed.join(open_keys, "key", "left_semi")
    if turn is not None:
        chosen = Window.partitionBy("rep").orderBy(F.xxhash64(F.lit(turn), "key"), "key")
        rows = rows.withColumn("_place", F.row_number().over(chosen))
        rows = rows.filter(F.col("_place") <= config.merge_buckets).drop("_place")
    rows = rows.join(sketch, "rep")
    data = F.concat("sketch", *[_long_bytes(c) for c in ("component", "n_shingles", "key")])
    named = rows.select(F.col("key").alias("grp"), F.col("rep").alias("id"), data.alias("data"))
    return blocked(named, [F.col("grp"), F.col("id")], "long", config.block)


def _texts_of(blocks: DataFrame, docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids in batch.column(0):
                own = np.frombuffer(ids.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own)], names=["doc_id"])

    wanted = blocks.select("ids").mapInArrow(run, "doc_id long").distinct()
    return docs.join(wanted, "doc_id", "left_semi").select("doc_id", "text")


def _block_columns(raw, n: int) -> tuple[np.ndarray, ...]:
    rows = np.frombuffer(raw, np.uint8).reshape(n, -1)
    tail = np.ascontiguousarray(rows[:, REGISTERS * 2 :]).view(">i8").astype(np.int64)
    return np.ascontiguousarray(rows[:, : REGISTERS * 2]).view(np.uint16), *tail.T


def _apart(part_a, part_b, n_a, n_b, percent: int) -> np.ndarray:
    """Which pairs are of different components and not ruled out by the sizes of their sets alone."""
    near = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return (part_a != part_b) & near


def _met(blocks: DataFrame, visit: Visit, schema: str) -> DataFrame:
    """``visit`` of every block to itself and to the others of its group, each pair once."""
    found = with_itself(blocks, visit, schema)
    # most groups are one block
    across = durable(met_within(blocks).filter("host < block"))
    if across.isEmpty():
        return found
    return found.unionByName(visited(blocks, blocks, across, visit, schema))


def _best_apart(blocks: DataFrame, config: NearConfig) -> DataFrame:
    """For every set the promising pair ``a, b`` of one bucket and different components that has the
    highest estimate."""
    percent = config.percent

    def compare(host_ids, host_data, ids, data, same):
        sketch_a, part_a, n_a, _ = _block_columns(host_data, len(host_ids))
        sketch_b, part_b, n_b, _ = _block_columns(data, len(ids))
        top_a, top_b = np.full(len(host_ids), -1.0), np.full(len(ids), -1.0)
        mate_a, mate_b = host_ids.copy(), ids.copy()
        rows = max(1, PAIRS // len(ids))
        for low in range(0, len(host_ids), rows):
            here = slice(low, low + rows)
            other = _apart(part_a[here, None], part_b, n_a[here, None], n_b, percent)
            if same:
                other &= np.arange(low, low + len(other))[:, None] < np.arange(len(ids))
            x, y = np.nonzero(other)
            if not len(x):
                continue
            x += low
            close, used = estimates(sketch_a[x], sketch_b[y], n_a[x], n_b[y])
            good = promising(close, used, percent)
            x, y, close = x[good], y[good], close[good]
            order = np.argsort(close)  # of values for one place the last, the largest, stays
            x, y, close = x[order], y[order], close[order]
            for top, mate, at, names in ((top_a, mate_a, x, ids[y]), (top_b, mate_b, y, host_ids[x])):
                better = close > top[at]
                top[at[better]], mate[at[better]] = close[better], names[better]
        for own, mate, top in ((host_ids, mate_a, top_a), (ids, mate_b, top_b)):
            found = np.flatnonzero(top >= 0)
            yield {"a": own[found], "b": mate[found], "score": top[found]}

    found = _met(blocks, compare, "a long, b long, score double")
    found = found.groupBy("a").agg(F.max_by("b", F.struct("score", "b")).alias("b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _connected(blocks: DataFrame, config: NearConfig) -> DataFrame:
    """Promising pairs ``a, b`` of one bucket and different components that connect all sets which such
    pairs connect; two blocks give fewer pairs than they have rows."""
    percent = config.percent

    def compare(host_ids, host_data, ids, data, same):
        sketch_a, part_a, n_a, _ = _block_columns(host_data, len(host_ids))
        sketch_b, part_b, n_b, _ = _block_columns(data, len(ids))
        shift = 0 if same else len(host_ids)
        label = np.arange(shift + len(ids))  # rows of one label are connected already
        rows = max(1, PAIRS // len(ids))
        for low in range(0, len(host_ids), rows):
            here = slice(low, low + rows)
            other = label[: len(host_ids)][here, None] != label[shift:]
            other &= _apart(part_a[here, None], part_b, n_a[here, None], n_b, percent)
            if same:
                other &= np.arange(low, low + len(other))[:, None] < np.arange(len(ids))
            x, y = np.nonzero(other)
            if not len(x):
                continue
            x += low
            good = promising(*estimates(sketch_a[x], sketch_b[y], n_a[x], n_b[y]), percent)
            x, y = x[good], y[good]
            ends_a, ends_b = [], []
            while len(x):
                ends_a.append(host_ids[x[0]])
                ends_b.append(ids[y[0]])
                label[label == label[shift + y[0]]] = label[x[0]]
                left = label[x] != label[shift + y]
                x, y = x[left], y[left]
            if ends_a:
                yield {"a": np.array(ends_a, np.int64), "b": np.array(ends_b, np.int64)}

    return _met(blocks, compare, "a long, b long")


def _full_sets(docs: DataFrame, config: NearConfig) -> DataFrame:
    """``rep, set_id, members``: the sorted shingle hashes of every document."""

    def emit(ids: pa.Array, flat: np.ndarray, borders: np.ndarray) -> pa.RecordBatch:
        raw = [flat[a:b].tobytes() for a, b in zip(borders[:-1], borders[1:], strict=True)]
        named = [hashlib.md5(r, usedforsecurity=False).digest() if r else None for r in raw]
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(named, pa.binary()), pa.array(raw, pa.binary())],
            names=["rep", "set_id", "members"],
        )

    return _texts(docs, config, emit, "rep long, set_id binary, members binary")


def _set_columns(raw, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sketches, components, set sizes, borders and members of the sets of a block."""
    rows = np.frombuffer(raw, np.uint8)
    fixed = REGISTERS * 2 + 16
    heads, members, at = np.empty((n, fixed), np.uint8), [], 0
    sizes = np.empty(n, np.int64)
    for i in range(n):
        heads[i] = rows[at : at + fixed]
        sizes[i] = int.from_bytes(heads[i, -8:].tobytes(), "big")
        at += fixed
        members.append(rows[at : at + 8 * sizes[i]])
        at += 8 * int(sizes[i])
    part = np.ascontiguousarray(heads[:, -16:-8]).view(">i8")[:, 0].astype(np.int64)
    sketch = np.ascontiguousarray(heads[:, : REGISTERS * 2]).view(np.uint16)
    borders = np.concatenate([[0], np.cumsum(sizes)])
    return sketch, part, sizes, borders, np.concatenate(members).view(np.uint64)


def _joining(
    clusters: DataFrame, classes: DataFrame, parts: DataFrame, docs: DataFrame, config: NearConfig
) -> DataFrame:
    """Links ``a, b`` between components that join all components which confirmed pairs inside a cluster
    join; two blocks give fewer links than they have components."""
    percent = config.percent
    sets = _full_sets(docs.join(clusters.select(F.col("id").alias("doc_id")), "doc_id", "left_semi"), config)
    rows = (
        classes.join(clusters.select(F.col("id").alias("rep"), F.col("component_id").alias("grp")), "rep")
        .join(parts.select(F.col("id").alias("rep"), "component_id"), "rep", "left")
        .join(sets, ["rep", "set_id"])
        .dropDuplicates(["set_id", "n_shingles"])
        .withColumn("component", F.coalesce("component_id", "rep"))
        .withColumn("id", F.xxhash64("set_id"))
    )
    data = F.concat("sketch", *[_long_bytes(c) for c in ("component", "n_shingles")], "members")
    named = rows.select("grp", "id", data.alias("data"))
    blocks = durable(blocked(named, [F.col("grp"), F.col("id")], "long", config.block, SET_BYTES))

    def compare(host_ids, host_data, ids, data, same):
        sketch_a, part_a, n_a, at_a, members_a = _set_columns(host_data, len(host_ids))
        sketch_b, part_b, n_b, at_b, members_b = _set_columns(data, len(ids))
        known, code_b = np.unique(members_b, return_inverse=True)
        names, label = np.unique(np.concatenate([part_a, part_b]), return_inverse=True)
        label_a, label_b = label[: len(part_a)], label[len(part_a) :]
        joined = np.arange(len(names))  # components of one value are joined already
        for i in range(len(host_ids)):
            apart = _apart(joined[label_a[i]], joined[label_b], n_a[i], n_b, percent)
            if same:
                apart[: i + 1] = False
            y = np.flatnonzero(apart)
            if not len(y):
                continue
            close = estimates(sketch_a[i], sketch_b[y], n_a[i], n_b[y])
            y = y[promising(*close, percent)]
            if not len(y):
                continue
            own = members_a[at_a[i] : at_a[i + 1]]
            place = np.minimum(np.searchsorted(known, own), len(known) - 1)
            mark = np.zeros(len(known), bool)
            mark[place[known[place] == own]] = True
            step = max(1, COUNTED // int(n_b[y].max()))
            for low in range(0, len(y), step):
                some = y[low : low + step]
                some = some[joined[label_b[some]] != joined[label_a[i]]]
                if not len(some):
                    continue
                ends = np.cumsum(n_b[some])
                begins = ends - n_b[some]
                which = np.arange(ends[-1]) + np.repeat(at_b[some] - begins, n_b[some])
                common = np.add.reduceat(mark[code_b[which]], begins, dtype=np.int64)
                linked = some[100 * common >= percent * (n_a[i] + n_b[some] - common)]
                ends_b = []
                for other in np.unique(label_b[linked]):
                    if joined[other] != joined[label_a[i]]:
                        ends_b.append(names[other])
                        joined[joined == joined[other]] = joined[label_a[i]]
                if ends_b:
                    yield {"a": np.full(len(ends_b), part_a[i]), "b": np.array(ends_b, np.int64)}

    return durable(_met(blocks, compare, "a long, b long"))
