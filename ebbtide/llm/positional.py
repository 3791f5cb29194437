"""A distributed positional inverted index, and exact phrase and proximity matches from it.

The index is cut by documents. A task gathers about 1 MB of texts into one segment: the distinct words
it holds, and for each the sorted list of its positions, whole texts counted through with a gap between
them. A segment is one row, so the index is a table that is written once and read by any test set; no
word is a key of a shuffle, and one that makes up a third of the corpus is only a longer list in every
segment.

A phrase is answered inside each segment: of its words the one with the shortest list comes first; its
positions, less the word's offset in the phrase, are the possible starts. They are intersected with the
list of the next rarest word less its offset, and so on, until none is left or all words agree. That
runs for all phrases side by side. Words are compared as bytes, not as hashes.

Test sets go to the segments in blocks of bounded size, one pass over the index each.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType
from pyspark.taskcontext import TaskContext

from ebbtide.llm.common import scratch_path, shared_dir, slices, text_bytes

#: Text bytes of a segment (a longer text is one by itself), and texts at most.
SEGMENT = 1 << 20
SEGMENT_TEXTS = 1 << 14
#: Words of test texts that are sent to the tasks at once, and of the pieces they are dealt in.
BLOCK_WORDS = 1 << 18
PIECE_WORDS = 1 << 13
#: Possible starts held at once while lists are intersected; more are taken in turns.
STARTS = 1 << 20
WINDOW = 10
#: Free positions after each text: what lies further apart is never near.
GAP = 64

# A-Z become a-z; all that is not a digit, a letter or beyond ASCII becomes a blank.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def words_of(data: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 text after A-Z became a-z."""
    return data.translate(_WORD_BYTES).split()


# --- the index --------------------------------------------------------------------------------


def _postings(texts: list[bytes]) -> tuple[np.ndarray, bytes, np.ndarray, np.ndarray]:
    """Words per text, the distinct words, the length of each one's list, the lists end to end."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    parts, lengths = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = words_of(text)
        lengths[i] = len(found)
        parts.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
    terms = np.concatenate(parts)
    place = np.arange(len(terms)) + np.repeat(GAP * np.arange(len(texts)), lengths)
    counts = np.bincount(terms, minlength=len(numbers))
    return lengths, b" ".join(numbers), counts, place[np.argsort(terms, kind="stable")]


def build_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Segments of all texts of ``docs``, written to the shared folder and read from there.

    Every row takes part: one without text has no words, one without id or with the id of another row
    is known by its segment and its place in it. Other columns are not read. No rows give no segments.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    schema = StructType().add("segment", "long").add("ids", ArrayType(rows.schema["id"].dataType))
    for name in ("lengths", "words", "counts", "positions"):
        schema = schema.add(name, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        ids: list[pa.Array] = []
        texts: list[bytes] = []
        size = 0

        def segment() -> pa.RecordBatch:
            lengths, words, counts, places = _postings(texts)
            held = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held),
                    pa.array([lengths.astype("<i4").tobytes()], pa.binary()),
                    pa.array([words], pa.binary()),
                    pa.array([counts.astype("<i4").tobytes()], pa.binary()),
                    pa.array([places.astype("<i4").tobytes()], pa.binary()),
                ],
                names=schema.names,
            )

        for batch in slices(batches, "text", SEGMENT):
            raw, at = text_bytes(batch.column(1))
            data = raw.tobytes()
            texts += [data[a:b] for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]
            ids.append(batch.column(0))
            size += len(data)
            if size >= SEGMENT or len(texts) >= SEGMENT_TEXTS:
                yield segment()
                ids, texts, size, number = [], [], 0, number + 1
        if texts:
            yield segment()

    shared_dir(spark)
    path = scratch_path(spark, "positions")
    # small row groups, so that a reader holds few segments at a time
    rows.mapInArrow(run, schema).write.option("parquet.block.size", 4 << 20).parquet(path)
    return spark.read.schema(schema).parquet(path)


@dataclass
class _Segment:
    """One row of the index in NumPy."""

    ids: pa.Array
    begins: np.ndarray
    words: dict[bytes, int]
    first: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, i: int) -> _Segment:
        value = {n: batch.column(n)[i] for n in ("lengths", "words", "counts", "positions")}
        numbers = {
            n: np.frombuffer(v.as_buffer(), "<i4").astype(np.int64)
            for n, v in value.items()
            if n != "words"
        }
        words = value["words"].as_py().split()
        return cls(
            batch.column("ids")[i].values,
            np.concatenate([[0], np.cumsum(numbers["lengths"] + GAP)]),
            dict(zip(words, range(len(words)), strict=True)),
            np.concatenate([[0], np.cumsum(numbers["counts"])]),
            numbers["positions"],
        )

    def located(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the text in the segment, and position in it."""
        row = np.searchsorted(self.begins, places, side="right") - 1
        return row, places - self.begins[row]


def indexed_rows(index: DataFrame) -> DataFrame:
    """``(segment, row, id, n_words)`` of every row that was indexed."""
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, ids, lengths in zip(*batch.columns, strict=True):
                n = np.frombuffer(lengths.as_buffer(), "<i4").astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), segment.as_py())),
                        pa.array(np.arange(len(n))),
                        ids.values,
                        pa.array(n),
                    ],
                    names=["segment", "row", "id", "n_words"],
                )

    kept = index.select("segment", "ids", "lengths")
    return kept.mapInArrow(run, f"segment bigint, row bigint, id {kind}, n_words bigint")


# --- test texts -------------------------------------------------------------------------------


def _pieces(items: DataFrame, text: str, item_id: str, overlap: int) -> DataFrame:
    """Test texts as words, in pieces of bounded length that overlap by ``overlap`` words, so that
    every run of one word more lies in exactly one piece. ``(item_id, first, words, n)``."""
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SEGMENT):
            raw, at = text_bytes(batch.column(1))
            data, source, first, words, sizes = raw.tobytes(), [], [], [], []
            for i in range(batch.num_rows):
                found = words_of(data[at[i] : at[i + 1]])
                for start in range(0, max(len(found) - overlap, min(1, len(found))), PIECE_WORDS):
                    part = found[start : start + PIECE_WORDS + overlap]
                    source.append(i)
                    first.append(start)
                    words.append(b" ".join(part))
                    sizes.append(len(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(source, pa.int64())),
                    pa.array(first, pa.int64()),
                    pa.array(words, pa.binary()),
                    pa.array(sizes, pa.int64()),
                ],
                names=["item_id", "first", "words", "n"],
            )

    return rows.mapInArrow(run, f"item_id {kind}, first bigint, words binary, n bigint")


def _blocks(pieces: DataFrame) -> Iterator[pa.Table]:
    """The pieces in blocks of about ``BLOCK_WORDS`` words, one at a time on the driver."""
    total = pieces.agg(F.sum("n")).first()[0] or 0
    count = -(-total // BLOCK_WORDS)
    place = F.pmod(F.xxhash64("item_id", "first", "words"), F.lit(max(count, 1)))
    for i in range(count):
        yield pieces.filter(place == i).toArrow()


# --- phrases ----------------------------------------------------------------------------------


@dataclass
class _Phrases:
    """Windows of a block of pieces: word numbers (-1 past the end of a short one), the piece and
    the offset in it."""

    words: list[bytes]
    windows: np.ndarray
    sizes: np.ndarray
    piece: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, pieces: list[bytes], window: int) -> _Phrases:
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        rows, sizes, piece, offset = [], [], [], []
        for i, data in enumerate(pieces):
            terms = np.array([numbers[w] for w in data.split()], np.int64)
            if len(terms) >= window:
                part = np.lib.stride_tricks.sliding_window_view(terms, window)
            else:
                part = np.full((1, window), -1)
                part[0, : len(terms)] = terms
            rows.append(part)
            sizes.append(np.full(len(part), min(len(terms), window)))
            piece.append(np.full(len(part), i))
            offset.append(np.arange(len(part)))
        return cls(list(numbers), *[np.concatenate(x) for x in (rows, sizes, piece, offset)])


def _starts(seg: _Segment, phrases: _Phrases, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the windows found in a segment, and the positions they start at."""
    term = np.array([seg.words.get(w, -1) for w in phrases.words], np.int64)
    terms = np.where(phrases.windows >= 0, term[phrases.windows], -1)
    known = np.flatnonzero((terms >= 0).sum(axis=1) == phrases.sizes)
    if not len(known):
        return
    terms, sizes = terms[known], phrases.sizes[known]
    frequency = np.diff(seg.first)
    lists = np.where(terms >= 0, frequency[terms], np.iinfo(np.int64).max)
    rarest = np.argsort(lists, axis=1, kind="stable")
    # the lists of all words as one sorted array
    span = int(seg.begins[-1]) + 1
    postings = np.repeat(np.arange(len(frequency)), frequency) * span + seg.places

    shortest = np.take_along_axis(lists, rarest[:, :1], axis=1)[:, 0]
    turn = (np.cumsum(shortest) - shortest) // most
    for chosen in np.split(np.arange(len(known)), np.flatnonzero(np.diff(turn)) + 1):
        n = shortest[chosen]
        which = np.repeat(chosen, n)
        rank = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        start = seg.places[seg.first[terms[which, rarest[which, 0]]] + rank] - rarest[which, 0]
        kept = start >= 0
        which, start = which[kept], start[kept]
        for step in range(1, rarest.shape[1]):
            if not len(which):
                break
            offset = rarest[which, step]
            place = start + offset
            wanted = terms[which, offset] * span + place
            found = np.minimum(np.searchsorted(postings, wanted), len(postings) - 1)
            kept = (step >= sizes[which]) | ((postings[found] == wanted) & (place < span))
            which, start = which[kept], start[kept]
        yield known[which], start


def phrase_matches(
    index: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
) -> DataFrame:
    """Where ``window`` consecutive words of a test text (all its words, if it has fewer) stand in an
    indexed text: ``(segment, row, id, item_id, item_start, start, n_words)``, one row per longest run
    of such windows on one diagonal. A run that passes the border of two pieces of a test text of more
    than 8,192 words comes as two rows that overlap.

    Test texts that are NULL or without words match nothing. Equal texts and ids match each for itself.
    """
    kind = index.schema["ids"].dataType.elementType.simpleString()
    item_kind = items.schema[item_id].dataType.simpleString()
    schema = (
        f"segment bigint, row bigint, id {kind}, item_id {item_kind}, item_start bigint, "
        "start bigint, n_words bigint"
    )

    def search(block: pa.Table):
        block = block.combine_chunks()
        texts, most = block["words"].to_pylist(), STARTS
        ids, first = block["item_id"].combine_chunks(), block["first"].to_numpy()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases = _Phrases.of(texts, window)
            for batch in batches:
                for i in range(batch.num_rows):
                    seg = _Segment.of(batch, i)
                    found = [x for x in _starts(seg, phrases, most) if len(x[0])]
                    if not found:
                        continue
                    which, start = (np.concatenate(x) for x in zip(*found, strict=True))
                    piece, offset = phrases.piece[which], phrases.offset[which]
                    order = np.lexsort((offset, start - offset, piece))
                    which, start, piece, offset = (x[order] for x in (which, start, piece, offset))
                    goes_on = (np.diff(piece) == 0) & (np.diff(start) == 1) & (np.diff(offset) == 1)
                    head = np.flatnonzero(np.concatenate([[True], ~goes_on]))
                    tail = np.append(head[1:], len(which)) - 1
                    row, local = seg.located(start[head])
                    n = start[tail] + phrases.sizes[which[tail]] - start[head]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(head), batch.column("segment")[i].as_py(), np.int64)),
                            pa.array(row),
                            seg.ids.take(pa.array(row)),
                            ids.take(pa.array(piece[head])),
                            pa.array(first[piece[head]] + offset[head]),
                            pa.array(local),
                            pa.array(n),
                        ],
                        names=["segment", "row", "id", "item_id", "item_start", "start", "n_words"],
                    )

        return run

    found = [
        index.mapInArrow(search(block), schema)
        for block in _blocks(_pieces(items, text, item_id, window - 1))
        if block.num_rows
    ]
    if not found:
        return index.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)


def contamination_report(index: DataFrame, matches: DataFrame) -> DataFrame:
    """Per indexed row: its words, how many of them a match covers, which test items match.

    ``(segment, row, id, n_words, n_hit, n_items, items)``, items as sorted strings. An item without an
    id covers words and is not listed.
    """
    key = ["segment", "row"]
    spans = matches.select(*key, "start", (F.col("start") + F.col("n_words")).alias("end")).distinct()
    before = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    new = spans.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", reached)))
    hit = new.groupBy(*key).agg(F.sum("new").alias("n_hit"))
    named = matches.filter("item_id IS NOT NULL").select(*key, F.col("item_id").cast("string")).distinct()
    items = named.groupBy(*key).agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    report = indexed_rows(index).join(hit, key, "left").join(items, key, "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return report.select(
        *key,
        "id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        listed.alias("items"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs(doc_id, text)`` how much of it stands in ``benchmark(item_id, text)``:
    ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    NULL and empty texts have no words and match nothing; rows that repeat an id are reported each for
    itself; other columns, whatever their names, are not read; an empty table on either side gives no
    rows or rows without hits.
    """
    index = build_index(docs)
    report = contamination_report(index, phrase_matches(index, benchmark, window=window))
    return report.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# --- proximity --------------------------------------------------------------------------------


def _near(lists: list[np.ndarray], within: int) -> tuple[np.ndarray, np.ndarray]:
    """Least intervals that hold a position of every list and at most ``within`` positions. Right ends
    are sought only near the shortest list."""
    lists = sorted(lists, key=len)
    ends = np.unique(np.concatenate(lists))
    rare = lists[0]
    after = np.searchsorted(rare, ends, side="right") - 1
    ends = ends[(after >= 0) & (ends - rare[after] < within)]
    low = ends
    for held in lists:
        last = np.searchsorted(held, ends, side="right") - 1
        kept = last >= 0
        ends, low = ends[kept], np.minimum(low[kept], held[last[kept]])
        kept = ends - low < within
        ends, low = ends[kept], low[kept]
    low, shortest = np.unique(low, return_index=True)  # of one left end the nearest right end
    return low, ends[shortest]


def proximity_matches(
    index: DataFrame,
    queries: DataFrame,
    within: int,
    text: str = "text",
    item_id: str = "item_id",
) -> DataFrame:
    """Least spans of an indexed text that hold all distinct words of a query, in any order, within
    ``within`` words: ``(segment, row, id, item_id, start, n_words)``. No span holds another of the same
    query. A query is one row of ``queries`` with at most 8,192 words; one without words matches nothing.
    """
    if not 1 <= within <= GAP:
        raise ValueError(f"within must lie between 1 and {GAP}")
    kind = index.schema["ids"].dataType.elementType.simpleString()
    item_kind = queries.schema[item_id].dataType.simpleString()
    schema = f"segment bigint, row bigint, id {kind}, item_id {item_kind}, start bigint, n_words bigint"

    def search(block: pa.Table):
        block = block.combine_chunks()
        wanted = [sorted(set(w.split())) for w in block["words"].to_pylist()]
        ids = block["item_id"].combine_chunks()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    seg = _Segment.of(batch, i)
                    for q, words in enumerate(wanted):
                        terms = [seg.words.get(w) for w in words]
                        if None in terms or len(terms) > within:
                            continue
                        low, high = _near(
                            [seg.places[seg.first[t] : seg.first[t + 1]] for t in terms], within
                        )
                        row, start = seg.located(low)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(low), batch.column("segment")[i].as_py(), np.int64)),
                                pa.array(row),
                                seg.ids.take(pa.array(row)),
                                ids.take(pa.array(np.full(len(low), q))),
                                pa.array(start),
                                pa.array(high - low + 1),
                            ],
                            names=["segment", "row", "id", "item_id", "start", "n_words"],
                        )

        return run

    pieces = _pieces(queries, text, item_id, 0)
    long = F.raise_error(F.lit(f"a query has more than {PIECE_WORDS} words")).cast("bigint")
    whole = pieces.withColumn("first", F.when(F.col("first") == 0, F.col("first")).otherwise(long))
    found = [
        index.mapInArrow(search(block), schema) for block in _blocks(whole) if block.num_rows
    ]
    if not found:
        return index.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)
