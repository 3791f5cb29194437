"""The corpus pipeline: stage by stage, and as a whole."""

import random
import re
import struct
import zlib
from collections import Counter

import pytest
from test_mixing import hashes_of, plain_mix
from test_secrets import base_spans

import corpus_pipeline as P
from ebbtide.llm import stages
from ebbtide.llm.packing import tokenized_pieces, vocabulary_path

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def passed(spark, medium, tmp_path_factory):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], medium).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages(passed):
    docs, known, single, clean, mixed, packed = passed
    assert [n for n, _ in P.STAGES] == ["language", "near_duplicates", "secrets", "mixture", "packing"]
    for table in (known, single, clean, mixed):
        assert table.columns == docs.columns
    assert known.count() == docs.filter("text is not null").count()  # all are in one of four languages
    groups = single.count()
    assert groups < known.count() and single.select("doc_id").distinct().count() == groups
    assert clean.count() == groups and clean.filter("text rlike '[0-9a-f]{24}'").count() == 0
    assert clean.filter("n_chars <> char_length(text)").count() == single.filter("n_chars <> char_length(text)").count()
    wanted = tokenized_pieces(mixed, with_ids=False).groupBy().sum("length").first()[0]
    assert packed.groupBy().sum("length").first()[0] == wanted


def test_untouched_documents_keep_their_text(passed):
    docs, _, _, clean, _, _ = passed
    changed = clean.join(docs.withColumnRenamed("text", "before"), "doc_id").filter("text <> before")
    assert changed.filter("text not like '%[SECRET]%'").count() == 0


def plain_groups(rows):
    """Of every group of near-duplicates, exact on sets of five words, the row with the smallest id."""
    sets = {}
    for doc, text, _ in rows:
        w = text.translate({c: c + 32 for c in range(65, 91)})
        w = re.findall(r"[^\x20\x09-\x0D]+", w)
        sets[doc] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [r for r in rows if find(r[0]) == r[0]]


def plain_clean(text):
    spans = sorted((a, b) for a, _, b in base_spans(text))
    out, at = [], 0
    for a, b in spans:
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def test_run_equals_plain_python(spark, small):
    """All pieces of the small table; it holds no random token beside the base kinds, and all its texts
    are in one of its languages."""
    from tokenizers import Tokenizer

    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    kept = plain_groups([r for r in docs if r[1] is not None and any(c.isalpha() for c in r[1])])
    clean = [(doc, plain_clean(text), source) for doc, text, source in kept]
    frame = spark.createDataFrame(clean, "doc_id long, text string, source string")
    taken = {doc: (n, words) for doc, n, words in plain_mix(clean, hashes_of(frame))}
    encode = Tokenizer.from_file(vocabulary_path()).encode
    want = Counter()
    for doc, text, _ in clean:
        size, words = taken[doc]
        times = int(words / size + 0.5) if size else 0
        ids = [*encode(text, add_special_tokens=False).ids, 0]
        for start in range(0, len(ids), 1024):
            piece = ids[start : start + 1024]
            crc = zlib.crc32(struct.pack(f"<{len(piece)}I", *piece))
            if times:
                want[doc, start, len(piece), crc, len(ids)] += times
    rows = P.run(spark, small).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    placed = {}
    for r in rows:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, "the end of the day", "en", "a", 18), (3, "the end of the day", "en", "a", 18),
    (None, "the other one of them all", "en", None, 25), (None, "the other one of them all", "en", None, 25), (4, "12 34", "de", "b", 5),
    (5, "der hund und die katze token=abcdefgh", "de", "b", 37), (6, "the " * 40_000, None, "a", 160_000),
]


def test_odd_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(*r, 1, 2) for r in ODD], COLUMNS + ", score int, kept int")
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0, name
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        out.collect()
    known = stages.known_language(spark, docs, "").collect()
    assert {r.doc_id for r in known} == {3, None, 5, 6}
    single = stages.one_of_each_group(spark, docs, "").collect()
    assert sorted(str(r.doc_id) for r in single) == sorted("1 2 3 4 5 6 None None".split())
    clean = {r.doc_id: r for r in stages.without_secrets(spark, docs, "").collect()}
    assert clean[5].text == "der hund und die katze [SECRET]" and clean[5].n_chars == 31
    assert clean[1].text is None and clean[3].text == "the end of the day"


def test_texts_that_share_an_id_stay_apart(spark):
    prose = lambda tag: " ".join(f"{tag}{i}" for i in range(40))
    rows = [(7, prose("a"), None, "s", 1), (7, prose("b"), None, "s", 1), (7, prose("b"), None, "s", 1)]
    rows += [(3, prose("b") + " end", None, "s", 1), (9, prose("a") + " end", None, "s", 1), (4, None, None, "s", 0)]
    docs = spark.createDataFrame(rows, COLUMNS)
    kept = {(r.doc_id, (r.text or "")[:2]) for r in stages.one_of_each_group(spark, docs, "").collect()}
    assert kept == {(7, "a0"), (3, "b0"), (4, "")}


def test_pipeline_without_languages_keeps_all(spark):
    docs = spark.createDataFrame([(1, "text", None, "a", 4)], COLUMNS)
    assert stages.known_language(spark, docs, "").count() == 1


def test_languages_are_judged_by_what_is_known_of_a_text(spark):
    """Ten related languages keep their documents; an unlearned one of the same script and letter
    garbage go."""
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(3, 7)))
    shared = [word("aeinrst") for _ in range(60)]
    own = [[word("aeilnorstu") for _ in range(40)] for _ in range(10)]
    prose = lambda words: " ".join(rng.choice(words) for _ in range(80))
    rows = [(i * 100 + j, prose(shared + own[i]), f"l{i}", "a", 0) for i in range(10) for j in range(40)]
    other = [word("bcdfghjkmoupvwyz") for _ in range(60)]
    rows += [(5000 + j, prose(other), None, "a", 0) for j in range(20)]
    garbage = lambda: word("abcdefghijklmnopqrstuvwxyz")
    rows += [(6000 + j, " ".join(garbage() for _ in range(80)), None, "a", 0) for j in range(20)]
    docs = spark.createDataFrame(rows, COLUMNS)
    kept = {r.doc_id for r in stages.known_language(spark, docs, "").collect()}
    assert kept == {r[0] for r in rows if r[2] is not None}
