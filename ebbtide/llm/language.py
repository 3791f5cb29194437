"""Language identification by Bloom filters whose positions hold language bitmasks.

Training keeps the commonest character trigrams of every language (by the share of its documents that
hold them, unless another language uses them far more) and enters each at ``HASHES`` positions of one table. A position is a mask with a bit per
language, so that a lookup reads ``HASHES`` masks and their conjunction names all languages that
contain the trigram: the filters of all languages in slices of one table. A text's score for a language
is the number of its trigrams in that language's filter, less what the filter's false positives are
expected to add.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import durable, mixed

UNDETERMINED = "und"
_BLANK = re.compile(r"\s")
GRAM = 3
HASHES = 3
#: Characters worked on at once. A longer text is cut after white space, where no trigram is.
SLICE_CHARS = 1 << 17


@dataclass(frozen=True)
class LanguageConfig:
    #: Documents learned from, per language: those with the smallest hashes. Bounds the training.
    sample: int = 3000
    #: Trigrams entered per language.
    grams: int = 4096
    #: A language contains a trigram if it uses it at this share of the highest rate at least.
    least_rate: float = 0.2
    #: Positions of the filter table; a power of two.
    positions: int = 1 << 17


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    #: ``positions x words`` masks, 64 languages a word.
    table: np.ndarray
    #: Chance that a trigram that was never entered is found, per language.
    false_positive: np.ndarray


@cache
def _letters() -> np.ndarray:
    """Once a worker."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


def _trigrams(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigrams of the lower-cased letters, words parted and enclosed by one space: values, the row of
    each, and whether a row has any letter."""
    # two line ends between rows: neither is a letter, so the one belongs to the row before, the
    # other to the row after
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) for t in lowered], np.int64) + 2
    joined = "\n" + "\n\n".join(lowered) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)), sizes)
    letter = letters[points]
    before = np.concatenate([[False], letter[:-1]])
    after = np.concatenate([letter[1:], [False]])
    first = np.cumsum(sizes) - sizes
    some = np.add.reduceat(letter, first) > 0
    # of the gap between two words of a row the first character stays; a gap at the start of a row
    # keeps its last one
    opens = np.zeros(len(points), bool)
    head = np.flatnonzero(~letter & after & ~before)
    heads = row[head]
    gap_start = np.concatenate([[True], letter[:-1] | (row[1:] != row[:-1])]) & ~letter
    start_of = np.maximum.accumulate(np.where(gap_start, np.arange(len(points)), 0))
    opens[head[first[heads] == start_of[head]]] = True
    keep = letter | (before & ~letter) | opens
    clean = np.where(letter, points, 32)[keep].astype(np.uint64)
    row = row[keep]
    if len(clean) < GRAM:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), some
    bits = np.uint64(21)
    grams = ((clean[:-2] << bits) | clean[1:-1]) << bits | clean[2:]
    one = (row[:-2] == row[2:]) & (clean[1:-1] != 32)
    return grams[one], row[:-2][one], some


def _places(grams: np.ndarray, positions: int) -> list[np.ndarray]:
    hashed = mixed(grams)
    return [
        ((hashed >> np.uint64(21 * k)) & np.uint64(positions - 1)).astype(np.int64)
        for k in range(HASHES)
    ]


def _pieces(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > SLICE_CHARS:
        blank = _BLANK.search(text, start + SLICE_CHARS)
        if blank is None:
            break
        yield text[start : blank.end()]
        start = blank.end()
    yield text[start:] if start else text


def _sliced(column: pa.Array) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Texts of an Arrow column, some at a time: the row of each, and the texts. Of a long one come
    several pieces; NULL is empty."""
    held, rows, part = 0, [], []
    for i, value in enumerate(column):
        for piece in _pieces(value.as_py() or ""):
            if part and held + len(piece) > SLICE_CHARS:
                yield np.array(rows), part
                held, rows, part = 0, [], []
            rows.append(i)
            part.append(piece)
            held += len(piece)
    if part:
        yield np.array(rows), part


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: every fourth by a checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(labelled: DataFrame, config: LanguageConfig = LanguageConfig()) -> LanguageModel:
    """Learn from ``labelled(text, lang)``; rows without text or language are left out.

    The sample takes, of each language, the ``config.sample`` texts with the smallest hashes, so it
    does not depend on how the rows are laid out; what reaches the driver are ``config.grams`` trigrams
    a language."""
    rows = labelled.filter("text is not null and lang is not null").select(
        "text", "lang", F.xxhash64("text").alias("_h")
    )
    # the smallest hashes of distinct texts; those far beyond the sample go before anything is ranked
    texts = rows.select("lang", "_h").distinct()
    known = texts.groupBy("lang").agg(F.count("*").alias("_texts"))  # one row a language
    share = F.col("_h").cast("double") / float(1 << 64) + 0.5
    near = texts.join(F.broadcast(known), "lang").filter(share * F.col("_texts") <= 4 * config.sample)
    by_hash = Window.partitionBy("lang").orderBy("_h")
    keys = (
        near.withColumn("_n", F.row_number().over(by_hash))
        .filter(F.col("_n") <= config.sample)
        .select("lang", "_h")
    )
    # keys: config.sample rows a language; of equal texts one is enough
    one = Window.partitionBy("lang", "_h").orderBy("text")
    chosen = durable(
        rows.join(F.broadcast(keys), ["lang", "_h"])
        .withColumn("_n", F.row_number().over(one))
        .filter("_n = 1")
        .select("lang", "text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for start in range(0, batch.num_rows, 64):
                here = langs[start : start + 64]
                pairs: dict[str, list[np.ndarray]] = {}
                for owner, part in _sliced(batch.column(1).slice(start, 64)):
                    grams, row, _ = _trigrams(part, letters)
                    row = owner[row]
                    for lang in set(here[owner]):
                        own = here[row] == lang
                        # documents that hold a trigram: distinct (row, trigram) pairs
                        found = np.unique(np.stack([row[own].astype(np.uint64), grams[own]], 1), axis=0)
                        pairs.setdefault(lang, []).append(found)
                for lang, found in sorted(pairs.items()):
                    distinct = np.unique(np.concatenate(found), axis=0)
                    values, counts = np.unique(distinct[:, 1], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(values), pa.string()),
                            pa.array(values.view(np.int64)),
                            pa.array(counts, pa.int64()),
                        ],
                        names=["lang", "gram", "n"],
                    )

    by_count = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    sizes = chosen.groupBy("lang").agg(F.count("*").alias("docs"))  # one row a language
    rate = F.col("n") / F.col("docs")
    top = (
        chosen.mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .join(F.broadcast(sizes), "lang")
        .withColumn("_most", F.max(rate).over(Window.partitionBy("gram")))
        .filter(rate >= F.col("_most") * config.least_rate)
        .withColumn("_r", F.row_number().over(by_count))
        .filter(F.col("_r") <= config.grams)
        .select("lang", "gram")
        .toPandas()
    )
    languages = tuple(sorted(top["lang"].unique()))
    table = np.zeros((config.positions, len(languages) // 64 + 1), np.uint64)
    chance = np.zeros(len(languages))
    for i, lang in enumerate(languages):
        grams = top.loc[top["lang"] == lang, "gram"].to_numpy().view(np.uint64)
        word, bit = i // 64, np.uint64(1) << np.uint64(i % 64)
        for at in _places(grams, config.positions):
            table[at, word] |= bit
        chance[i] = ((table[:, word] & bit) > 0).mean() ** HASHES
    return LanguageModel(languages, table, chance)


def predict(
    docs: DataFrame,
    model: LanguageModel,
    text_column: str = "text",
    names: tuple[str, ...] = ("lang_pred", "score"),
) -> DataFrame:
    """``docs`` plus the language and a score, the share of the winner in what all languages get; they
    are called ``names``, which must not clash with columns of ``docs``. A third name asks for the coverage:
    the corrected share of the text's own trigrams in the winner's filter, whatever the other languages.

    ``und`` with score 0 for NULL and for texts without letters, and for all texts if nothing was
    learned. A text none of whose trigrams is known gets the first language with score 0; ties go to
    the first language too."""
    languages, table, chance = model.languages, model.table, model.false_positive

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        letters = _letters()
        for texts in batches:
            n = len(texts)
            some = np.zeros(n, bool)
            hits, total = np.zeros((n, len(languages))), np.zeros(n)
            for owner, part in _sliced(texts):
                grams, row, lettered = _trigrams(part, letters)
                some[owner[lettered]] = True
                row = owner[row]
                total += np.bincount(row, minlength=n)
                places = _places(grams, len(table))
                for word in range(table.shape[1]):
                    found = table[places[0], word] & table[places[1], word] & table[places[2], word]
                    for i in range(64 * word, min(len(languages), 64 * (word + 1))):
                        known = row[(found >> np.uint64(i % 64)) & np.uint64(1) > 0]
                        hits[:, i] += np.bincount(known, minlength=n)
            # found = true + (total - true) * chance
            true = np.maximum(0.0, hits - total[:, None] * chance) / (1 - chance)
            if not languages:
                some[:] = False
            winners, scores, covered = [], [], []
            for known, counts, size in zip(some, true, total, strict=True):
                whole = counts.sum() if known else 0.0
                winners.append(languages[int(np.argmax(counts))] if known else UNDETERMINED)
                scores.append(float(counts.max() / whole) if whole > 0 else 0.0)
                covered.append(float(counts.max() / size) if whole > 0 else 0.0)
            yield pa.StructArray.from_arrays(
                [pa.array(winners, pa.string()), pa.array(scores, pa.float64()), pa.array(covered, pa.float64())],
                names=["lang_pred", "score", "coverage"],
            )

    judge.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    found_in = F.arrow_udf(judge, "lang_pred string, score double, coverage double")
    judged = docs.withColumn("_judged", found_in(F.col(text_column).cast("string")))
    found = [F.col(f"_judged.{c}").alias(n) for c, n in zip(("lang_pred", "score", "coverage"), names)]
    return judged.select(*docs.columns, *found)


def language_report(docs: DataFrame, config: LanguageConfig = LanguageConfig()) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, lang_pred, score``.

    Learns from rows with a language that are not held out. Repeated rows are judged alike; an empty
    table gives no rows; further columns are ignored."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))), config)
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
