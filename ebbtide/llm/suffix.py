"""Removal of repeated byte strings by longest-previous-factor arrays.

A byte is removed when a string of ``length`` bytes covers it that also starts earlier. In suffix order
the longest earlier match of a position is with its previous or next smaller position (by document,
then start); the position is a later copy when that longest previous factor reaches ``length``.

One suffix array of the whole corpus does not fit a task, so it is cut where no match is lost. Every
window of ``length`` bytes names an anchor inside itself: its smallest 24-byte gram by hash, the
leftmost of equals. Equal windows have equal anchors, so windows only need to meet those of the same
anchor gram. Windows that follow one another and share an anchor form a context, about 40 of them a row.

1. Contexts are shuffled once by anchor gram. Of equal contexts (all windows equal) the first stays
   and the others are later copies as a whole.
2. The first ones of grams that occur in several different contexts bring their bytes: these are the
   ends of matches. They are gathered by gram, and a suffix array over the gathered bytes, with common
   prefixes and previous and next smaller positions, gives the longest previous factor of each window
   (followed only as far as ``length``) and so which are later copies.
3. The hits go back to their documents.

Grams that hold more than a ten-thousandth of all anchors are found beforehand on a sample of documents
and dealt out over several tasks by context; what is first in one of these tasks is then compared
across them by the digest of the window. The sample decides only where rows go, never what is found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import durable, mixed, scratch_path, slices, text_bytes

GRAM = 24
SLICE_BYTES = 2 << 20
BUCKET_BYTES = 1 << 20
#: Sorts behind every id; stands for a NULL id.
LAST_ID = (1 << 63) - 1
HOT_SAMPLE = 64
#: Ways in which what needs no company is dealt out.
SPREAD = 4096
HOT_KEYS = 10_000
HOT_CONTEXTS = 2048

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


@dataclass(frozen=True)
class Hot:
    """Anchor grams to be dealt out, sorted, and over how many tasks each."""

    keys: np.ndarray
    salts: np.ndarray


NO_HOT = Hot(np.zeros(0, np.int64), np.zeros(0, np.int64))


def document(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


# A place is a stretch of windows of one text in 63 bits: start, number of windows, mark of the text.
# Places of one document sort by start.


def places(start: np.ndarray, n: np.ndarray, mark: np.ndarray) -> np.ndarray:
    return (start << 31) | (n << 24) | mark


def place_parts(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 31, (place >> 24) & 0x7F, place & 0xFFFFFF


def text_mark(text: bytes) -> int:
    """24 bits that tell apart the texts of rows that share a document id."""
    return int.from_bytes(hashlib.md5(text, usedforsecurity=False).digest()[:3], "big")


def _chained(values: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` values, by doubling."""
    out, done, power, block = None, 0, values, 1
    rest = length
    while True:
        if rest & 1:
            part = power[done : len(values) - block + 1]
            if out is None:
                out = part
            else:
                n = min(len(out), len(part))
                out = mixed(out[:n] * _P) + part[:n]
            done += block
        rest >>= 1
        if not rest:
            return mixed(out[: len(values) - length + 1])
        n = len(power) - block
        power = mixed(power[: max(0, n)] * _P) + power[block:]
        block *= 2


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    least, block = values, 1
    while block * 2 <= width:
        least = np.minimum(least[:-block], least[block:])
        block *= 2
    rest = width - block
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def contexts(
    raw: np.ndarray, offsets: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor gram, context hash, row, start in the row and number of windows of every context."""
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    values = _TABLE[raw]
    grams = _chained(values, GRAM)
    # hash above, position below: the smallest value tells the leftmost smallest gram
    low = np.uint64(max(1, int(len(raw)).bit_length()))
    ranked = (grams >> low << low) | np.arange(len(grams), dtype=np.uint64)
    least = _sliding_least(ranked, length - GRAM + 1)
    anchor = (least & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(len(anchor)), "right") - 1
    inside = np.arange(len(anchor)) + length <= offsets[row + 1]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | ~inside[:-1]
    start = np.flatnonzero(new & inside)
    if not len(start):
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    # windows of a run that lie inside: runs end where the next begins or the row's windows end
    bounds = np.flatnonzero(new | ~inside)
    following = np.searchsorted(bounds, start, "right")
    end = np.where(following < len(bounds), bounds[np.minimum(following, len(bounds) - 1)], len(anchor))
    n = end - start
    power = np.full(len(raw), _P, np.uint64)
    power[0] = 1
    inverse = np.full(len(raw), _P_INVERSE, np.uint64)
    inverse[0] = 1
    np.cumprod(power, out=power)
    np.cumprod(inverse, out=inverse)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(values * power, out=sums[1:])
    last = end + length - 1
    context = mixed((sums[last] - sums[start]) * inverse[start] + n.astype(np.uint64))
    return grams[anchor[start]], context, row[start], start - offsets[row[start]], n


def _context_rows(docs: DataFrame, length: int, hot: Hot) -> DataFrame:
    """``key, salt, context, doc, place`` of every context of ``docs(doc, text)``.

    Equal contexts of one slice of texts need not meet again to tell that all but the first are later
    copies; these get a negative salt, which spreads them evenly. So a context that fills whole texts
    or is in a third of them leaves a task once per slice."""
    schema = "key long, salt long, context long, doc long, place long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            raw, offsets = text_bytes(batch.column("text"))
            key, context, row, start, n = contexts(raw, offsets, length)
            marks = np.array(
                [text_mark(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.int64
            )
            key, context = key.view(np.int64), context.view(np.int64)
            salt = np.zeros(len(key), np.int64)
            if len(hot.keys):
                at = np.minimum(np.searchsorted(hot.keys, key), len(hot.keys) - 1)
                salt = np.where(hot.keys[at] == key, 1 + np.abs(context % hot.salts[at]), 0)
            docs_here = batch.column("doc").to_numpy()[row]
            place = places(start, n, marks[row])
            order = np.lexsort((place, docs_here, context, key))
            new = np.ones(len(order), bool)
            new[1:] = (key[order[1:]] != key[order[:-1]]) | (context[order[1:]] != context[order[:-1]])
            first = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
            copies = order[(docs_here[order] != docs_here[first]) | (start[order] > start[first])]
            salt[copies] = -1 - np.arange(len(copies)) % SPREAD
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (key, salt, context, docs_here, place)],
                names=["key", "salt", "context", "doc", "place"],
            )

    return docs.mapInArrow(run, schema)


def find_hot(docs: DataFrame, length: int) -> Hot:
    """Grams with more than a ``HOT_KEYS``-th of the anchors in a sample of documents; so at most
    ``HOT_KEYS`` of them."""
    sample = docs.filter(F.pmod(F.xxhash64("doc"), F.lit(HOT_SAMPLE)) == 0)
    counts = durable(
        _context_rows(sample, length, NO_HOT).filter("salt >= 0").groupBy("key").agg(F.count("*").alias("n"))
    )
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = counts.filter(F.col("n") > max(8, total // HOT_KEYS)).collect()
    rows.sort(key=lambda r: r["key"])
    return Hot(
        np.array([r["key"] for r in rows], np.int64),
        np.array([1 + r["n"] * HOT_SAMPLE // HOT_CONTEXTS for r in rows], np.int64),
    )


def _first_contexts(rows: DataFrame) -> DataFrame:
    """Later copies (``later`` true) and first contexts of grams with several (``later`` false)."""
    schema = "later boolean, key long, salt long, doc long, place long"
    columns = ["key", "salt", "context", "doc", "place"]

    def judged(data: np.ndarray) -> pa.RecordBatch:
        key, salt, context, doc, place = data
        new_key = np.ones(len(key), bool)
        new_key[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
        new = new_key.copy()
        new[1:] |= context[1:] != context[:-1]
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)[group]
        # rows that share document and start with the first one are no later than it
        later = (doc != doc[first]) | (place >> 31 > place[first] >> 31)
        kinds = np.add.reduceat(new, np.flatnonzero(new_key))
        later |= salt < 0
        several = (kinds[np.cumsum(new_key) - 1] > 1) | (salt > 0)
        out = later | several
        return pa.RecordBatch.from_arrays(
            [pa.array(c[out]) for c in (later, key, salt, doc, place)],
            names=["later", "key", "salt", "doc", "place"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((5, 0), np.int64)
        for batch in batches:
            held = np.hstack([held, np.stack([batch.column(c).to_numpy() for c in columns])])
            if not held.shape[1]:
                continue
            same = (held[0] == held[0, -1]) & (held[1] == held[1, -1])
            cut = int(np.argmax(same))  # sorted, so the last group begins here
            if cut:
                yield judged(held[:, :cut])
                held = held[:, cut:]
        if held.shape[1]:
            yield judged(held)

    ordered = rows.repartition("key", "salt").sortWithinPartitions(*columns)
    return ordered.mapInArrow(run, schema)


def doubled_ranks(rank: np.ndarray, width: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Rank in suffix order of the ``length`` symbols from each of ``starts``, equal strings alike, from
    the ranks of all strings of ``width`` symbols: prefix doubling, the last step with overlapping halves."""
    while width * 2 <= length:
        after = np.zeros(len(rank), np.int64)
        after[: max(0, len(rank) - width)] = rank[width:]
        rank = np.unique(rank * (len(rank) + 1) + after, return_inverse=True)[1]
        width *= 2
    tail = np.minimum(starts + length - width, len(rank) - 1)
    return np.unique(rank[starts] * (len(rank) + 1) + rank[tail], return_inverse=True)[1]


def rank_levels(data: np.ndarray, length: int) -> list[np.ndarray]:
    """Ranks of the strings of 8, 16, 32, ... bytes at every position, up to the last width that is not
    above ``length``; behind the end come zeros."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.zeros(len(data), np.uint64)
    for j in range(8):
        word = (word << np.uint64(8)) | padded[j : j + len(data)]
    levels, width = [np.unique(word, return_inverse=True)[1]], 8
    while width * 2 <= length:
        rank = levels[-1]
        after = np.zeros(len(rank), np.int64)
        after[: max(0, len(rank) - width)] = rank[width:]
        levels.append(np.unique(rank * (len(rank) + 1) + after, return_inverse=True)[1])
        width *= 2
    return levels


def suffix_classes(
    data: np.ndarray, starts: np.ndarray, length: int, levels: list[np.ndarray] | None = None
) -> np.ndarray:
    """Rank in suffix order of the strings of ``length`` bytes at ``starts``, equal ones alike: the widest
    level at the start, then at the end, which overlap."""
    levels = levels or rank_levels(data, length)
    top, width = levels[-1], 8 << (len(levels) - 1)
    tail = np.minimum(starts + length - width, len(top) - 1)
    return np.unique(top[starts] * (len(top) + 1) + top[tail], return_inverse=True)[1]


def common_prefixes(
    data: np.ndarray, levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, length: int
) -> np.ndarray:
    """Bytes, at most ``length``, in which the strings at positions ``a`` and ``b`` agree. Widths are
    tried from the largest down; strings of ``length`` bytes end inside the data."""
    agreed = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        width = 8 << k
        for _ in range(length // width if k == len(levels) - 1 else 1):
            room = agreed + width <= length
            x, y = np.where(room, a + agreed, 0), np.where(room, b + agreed, 0)
            agreed += width * (room & (levels[k][x] == levels[k][y]))
    last = len(data) - 1
    open_ = np.ones(len(a), bool)
    for _ in range(7):  # what is left is less than eight bytes
        same = data[np.minimum(a + agreed, last)] == data[np.minimum(b + agreed, last)]
        open_ &= same & (agreed < length)
        agreed += open_
    return agreed


def previous_smaller(values: np.ndarray, between: np.ndarray) -> np.ndarray:
    """For each entry the least of ``between`` from its previous smaller value to itself, 0 where there is
    none; ``between[k]`` belongs to the entries k - 1 and k. Pointers skip what is known not to be smaller."""
    pointer = np.arange(len(values)) - 1
    least = between.copy()
    open_ = np.flatnonzero(pointer >= 0)
    while len(open_):
        at = pointer[open_]
        open_ = open_[values[at] >= values[open_]]
        at = pointer[open_]
        least[open_], pointer[open_] = np.minimum(least[open_], least[at]), pointer[at]
        open_ = open_[pointer[open_] >= 0]
    least[pointer < 0] = 0
    return least


def longest_previous_factors(
    data: np.ndarray, starts: np.ndarray, earlier: np.ndarray, length: int
) -> np.ndarray:
    """For the strings at ``starts`` the longest common prefix, up to ``length`` bytes, with any string
    at ``starts`` of smaller ``earlier``.

    In suffix order the string that agrees longest is the nearest one before or behind with a smaller
    value; the agreement with it is the least common prefix of neighbours on the way."""
    levels = rank_levels(data, length)
    order = np.lexsort((earlier, suffix_classes(data, starts, length, levels)))
    placed, values = starts[order], earlier[order]
    common = np.zeros(len(order) + 1, np.int64)
    common[1:-1] = common_prefixes(data, levels, placed[:-1], placed[1:], length)
    before = previous_smaller(values, common[:-1])
    behind = previous_smaller(values[::-1], common[1:][::-1])[::-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(before, behind)
    return out


def later_copies(
    data: np.ndarray, starts: np.ndarray, doc: np.ndarray, position: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """For the windows of ``length`` bytes at ``starts``: whether the longest previous factor reaches
    ``length``, and whether the window is the first of its class. Windows at one place, of texts that
    share an id, are not earlier than one another."""
    if not len(starts):
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.lexsort((position, doc))
    new = np.ones(len(order), np.int64)
    new[1:] = (np.diff(doc[order]) != 0) | (np.diff(position[order]) != 0)
    earlier = np.empty(len(order), np.int64)
    earlier[order] = np.cumsum(new)
    later = longest_previous_factors(data, starts, earlier, length) >= length
    return later, ~later


def _with_bytes(docs: DataFrame, ends: DataFrame, length: int) -> DataFrame:
    """``key, salt, doc, place, data`` for the contexts in ``ends``."""
    schema = "key long, salt long, doc long, place long, data binary"
    wanted = ends.groupBy("doc").agg(
        F.collect_list(F.struct("key", "salt", "place")).alias("wanted")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                doc = batch.column(0)[row].as_py()
                raw = batch.column(1)[row].as_buffer().to_pybytes()
                mark = text_mark(raw)
                items = batch.column(2)[row].values
                key, salt, place = (items.field(i).to_numpy() for i in range(3))
                start, n, of = place_parts(place)
                own = of == mark
                data = [
                    raw[a : a + m + length - 1]
                    for a, m in zip(start[own].tolist(), n[own].tolist(), strict=True)
                ]
                columns = [pa.array(c[own]) for c in (key, salt, np.full(len(key), doc), place)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(data, pa.binary())],
                    names=["key", "salt", "doc", "place", "data"],
                )

    return docs.join(wanted, "doc").select("doc", "text", "wanted").mapInArrow(run, schema)


def _window_hits(rows: DataFrame, length: int) -> DataFrame:
    """Later windows as places (``digest`` NULL), and what is first among the windows of dealt-out
    grams, window by window with its digest."""
    schema = "doc long, place long, digest binary"

    def found(held: list[tuple]) -> pa.RecordBatch:
        salt, doc, place = (np.array([h[i] for h in held], np.int64) for i in (1, 2, 3))
        data = np.frombuffer(b"".join(h[4] for h in held), np.uint8)
        start, n, mark = place_parts(place)
        base = np.cumsum(n + length - 1) - (n + length - 1)
        of = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        starts, position = base[of] + step, start[of] + step
        later, leads = later_copies(data, starts, doc[of], position, length)
        # neighbouring hits of one context in one place
        hit = np.flatnonzero(later)
        new = np.ones(len(hit), bool)
        new[1:] = (hit[1:] != hit[:-1] + 1) | (of[hit[1:]] != of[hit[:-1]])
        run = np.flatnonzero(new)
        counts = np.diff(np.append(run, len(hit)))
        at = hit[run]
        out_doc = [doc[of[at]]]
        out_place = [places(position[at], counts, mark[of[at]])]
        lead = np.flatnonzero(leads & (salt[of] > 0))
        out_doc.append(doc[of[lead]])
        out_place.append(places(position[lead], np.ones(len(lead), np.int64), mark[of[lead]]))
        digests: list[bytes | None] = [None] * len(at)
        digests += [
            hashlib.md5(data[a : a + length], usedforsecurity=False).digest()
            for a in starts[lead].tolist()
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(out_doc)),
                pa.array(np.concatenate(out_place)),
                pa.array(digests, pa.binary()),
            ],
            names=["doc", "place", "digest"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # a bucket holds whole grams
                if size >= BUCKET_BYTES and row[:2] != held[-1][:2]:
                    yield found(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield found(held)

    gathered = rows.repartition("key", "salt").sortWithinPartitions("key", "salt")
    return gathered.mapInArrow(run, schema)


def _across(leads: DataFrame) -> DataFrame:
    """Later ones among windows that are first where they were compared."""
    start = F.shiftright("place", 31)
    least = leads.groupBy("digest").agg(
        F.min(F.struct("doc", start.alias("start"))).alias("least"), F.count("*").alias("n")
    ).filter("n > 1")
    later = (F.col("doc") != F.col("least.doc")) | (start > F.col("least.start"))
    return leads.join(least, "digest").filter(later).select("doc", "place")


def later_places(docs: DataFrame, length: int) -> DataFrame:
    """``doc, place`` for all windows of ``docs(doc, text)`` that also start earlier."""
    spark = docs.sparkSession
    hot = find_hot(docs, length)
    path = scratch_path(spark, "contexts")
    _first_contexts(_context_rows(docs, length, hot)).write.parquet(path)
    judged = spark.read.parquet(path)
    spark._jvm.System.gc()  # the shuffle of the contexts is done with
    windows = durable(_window_hits(_with_bytes(docs, judged.filter("not later"), length), length))
    return (
        judged.filter("later").select("doc", "place")
        .unionByName(windows.filter("digest is null").select("doc", "place"))
        .unionByName(_across(windows.filter("digest is not null")))
    )


REMOVED = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, length: int = 100, with_kept: bool = False) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, on request also the
    remaining bytes (``kept``).

    Every byte goes that is covered by a string of ``length`` bytes which also starts earlier: in a
    document of smaller id, or in the same document further ahead. NULL text is empty; shorter texts
    stay whole; NULL ids are the largest. Rows that share an id are the same document: between them
    only a smaller start is earlier. An empty table gives no rows; further columns are ignored.
    ``length`` is between 64 and 127."""
    if not 64 <= length <= 127:
        raise ValueError("length must be between 64 and 127")
    rows = docs.select(
        "doc_id", document().alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    hits = later_places(rows.select("doc", "text"), length)
    by_doc = hits.groupBy("doc").agg(F.collect_list("place").alias("found"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, {REMOVED}" + ", kept binary" * with_kept
    names = [c.split()[0] for c in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names[1:]]
            for row in range(batch.num_rows):
                raw = batch.column(1)[row].as_buffer().to_pybytes()
                found = batch.column(2)[row]
                gone = np.zeros(len(raw) + 1, np.int64)
                if found.is_valid:
                    start, n, mark = place_parts(found.values.to_numpy())
                    own = mark == text_mark(raw)
                    np.add.at(gone, start[own], 1)
                    np.add.at(gone, start[own] + n[own] + length - 1, -1)
                removed = np.cumsum(gone)[:-1] > 0
                kept = np.frombuffer(raw, np.uint8)[~removed].tobytes()
                spans = int((removed & ~np.concatenate([[False], removed[:-1]])).sum())
                values = [len(raw), int(removed.sum()), spans, hashlib.sha256(kept).hexdigest()]
                for column, value in zip(out, [*values, kept], strict=False):
                    column.append(value)
            types = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(out, types, strict=False)]],
                names=names,
            )

    joined = rows.join(by_doc, "doc", "left").select("doc_id", "text", "found")
    return joined.mapInArrow(cut, schema)
