"""Language identification: held-out accuracy, trigrams against brute force, edge cases."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ebbtide.llm.language import (
    LanguageConfig,
    LanguageModel,
    _letters,
    _sliced,
    _trigrams,
    fit,
    held_out,
    language_report,
    predict,
)

LETTERS = _letters()


def plain_trigrams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    s = " " + " ".join(words) + " "
    return Counter(s[i : i + 3] for i in range(len(s) - 2)) if words else Counter()


def plain(text):
    """Trigrams whose middle is a letter, with or without a gap at their ends."""
    return Counter({g: n for g, n in plain_trigrams(text).items() if g[1] != " "})


def test_trigrams_equal_brute_force():
    texts = [
        "", "a", "Hello, world!", "  x  ", "12 34", "é É\n\nß", "a b", "l'été d'Été -- fin.", "ab", "\n", "日本語 text", "x" * 300,
        "İstanbul ẞ",
    ]
    grams, row, some = _trigrams(texts, LETTERS)
    mask = np.uint64((1 << 21) - 1)
    for i, text in enumerate(texts):
        got = Counter()
        for g in grams[row == i]:
            got["".join(chr(int((g >> np.uint64(s)) & mask)) for s in (42, 21, 0))] += 1
        assert got == plain(text), text
        assert some[i] == any(c.isalpha() for c in text.lower())


def test_long_texts_are_cut_without_loss():
    rng = random.Random(2)
    text = "".join(rng.choice("abcÉß ,.\n'") for _ in range(400_000))
    column = pa.array(["x y", None, text, "", "a" * 200_000 + " b"])
    counts, parts = [Counter() for _ in column], 0
    for owner, part in _sliced(column):
        grams, row, _ = _trigrams(part, LETTERS)
        assert sum(map(len, part)) < (1 << 17) + 200_100
        parts += 1
        for i in set(owner):
            values, n = np.unique(grams[owner[row] == i], return_counts=True)
            counts[i].update(dict(zip(values.tolist(), n.tolist())))
    whole, row, _ = _trigrams([t.as_py() or "" for t in column], LETTERS)
    assert parts > 3
    for i in range(len(column)):
        values, n = np.unique(whole[row == i], return_counts=True)
        assert counts[i] == Counter(dict(zip(values.tolist(), n.tolist())))


def test_held_out_rule(spark):
    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_accuracy_on_held_out_documents(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    rows = language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if r.held_out and r.lang]
    assert len(out) > 200
    assert sum(r.lang == r.lang_pred for r in out) / len(out) >= 0.99
    assert all(0 <= r.score <= 1 for r in rows)


DATA = [
    (1, "the cat and the dog", "en"), (2, "the house of the man", "en"), (3, "der hund und die katze", "de"),
    (4, "das haus und der mann", "de"), (5, None, "en"), (6, "", None), (7, "12 !!", "de"), (8, "the end", None),
    (9, "und die", None), (10, "ξ", None), (11, "the " * 50_000, None), (12, "the cat and the dog", "en"),
    (None, "the dog", "en"),
]


def test_small_table(spark):
    docs = spark.createDataFrame([(*r, "x", "y") for r in DATA], "doc_id long, text string, lang string, score string, lang_pred string")
    got = {r.doc_id: r for r in language_report(docs).collect()}
    assert len(got) == len(DATA)
    assert [got[i].lang_pred for i in (5, 6, 7)] == ["und"] * 3
    assert [got[i].score for i in (5, 6, 7)] == [0.0] * 3
    assert [got[i].lang_pred for i in (8, 9, 11)] == ["en", "de", "en"]
    assert got[10].lang_pred == "de" and got[10].score == 0.0  # nothing known: the first language
    assert not got[None].held_out
    assert language_report(docs.limit(0)).count() == 0


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    row = language_report(docs).first()
    assert (row.lang_pred, row.score) == ("und", 0.0)


def test_sample_is_bounded_and_does_not_depend_on_layout(spark):
    rows = [(f"the text number {i} " + "abc"[i % 3] * 5, "en") for i in range(300)]
    rows += [("ein text ist das", "de")] * 200
    df = spark.createDataFrame(rows, "text string, lang string")
    config = LanguageConfig(sample=20)
    a, b = fit(df, config), fit(df.repartition(11), config)
    assert a.languages == b.languages == ("de", "en") and (a.table == b.table).all()


def test_more_than_64_languages(spark):
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    rows = [(f"{alphabet[i % 26]}{alphabet[i // 26]}q " * 20, f"l{i:03}") for i in range(80)]
    df = spark.createDataFrame(rows, "text string, lang string")
    model = fit(df)
    assert len(model.languages) == 80 and model.table.shape[1] == 2
    assert all(r.lang == r.lang_pred for r in predict(df, model).collect())


def test_false_positives_are_taken_off(spark):
    """A filter that contains everything gives no evidence for its language."""
    table = np.full((1 << 10, 1), 1, np.uint64)
    model = LanguageModel(("full", "empty"), table, np.array([0.999999, 0.0]))
    row = predict(spark.createDataFrame([("some text",)], "text string"), model).first()
    assert row.lang_pred in model.languages
