"""WARC: round trip, revisits, and salvage of damaged archives."""

import base64
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ebbtide.llm.warc import RECORD_END, record_text, records, read_warc, round_trip, salvage, write_warc

PAGES = [
    (1, "u", "same"), (2, "u", "same"), (3, None, None), (4, "x", ""), (None, "u", "same"), (2, "u", "same"),
    (5, "u\r\nX: y", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (6, "v", "z" * 200_000), (7, "v", "a\n"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(
        [(*p, "noise") for p in PAGES], "page_id long, url string, html string, payload string"
    )


@pytest.mark.parametrize("gzip", [False, True])
def test_round_trip(pages, tmp_path, gzip):
    rows = round_trip(pages, str(tmp_path / "w"), gzip).collect()
    assert len(rows) == len(PAGES)
    key = lambda r: (r[0] is None, r[0] or 0)
    for (page, _, html), r in zip(sorted(PAGES, key=key), sorted(rows, key=key), strict=True):
        raw = (html or "").encode()
        assert r.page_id == page and r.payload_bytes == len(raw)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        holder = {"same": 2, "": 4}.get(html or "")
        revisit = holder is not None and page != holder
        assert r.record_type == ("revisit" if revisit else "response")
        assert r.refers_to == (holder if revisit else None)


def test_payloads_come_back(pages, spark, tmp_path):
    write_warc(records(pages.drop("payload")), str(tmp_path / "w"), gzip=True)
    read = read_warc(spark, str(tmp_path / "w")).filter("record_type = 'response'").collect()
    assert {bytes(r.payload).decode() for r in read} == {h or "" for _, _, h in PAGES}


def test_short_payloads_are_all_responses(pages):
    held = records(pages.drop("payload"), min_revisit_bytes=5).collect()
    assert all(r.refers_to is None for r in held)


def test_empty_table(pages, tmp_path):
    assert round_trip(pages.limit(0), str(tmp_path / "w")).count() == 0


@pytest.fixture(scope="module", params=[False, True])
def archive(request, pages, tmp_path_factory):
    path = tmp_path_factory.mktemp("a") / "w"
    write_warc(records(pages.drop("payload")).coalesce(1), str(path), gzip=request.param)
    return b"".join(p.read_bytes() for p in sorted(path.glob("part-*")))


def test_sound_archive_has_no_gap(archive):
    found = list(salvage(archive))
    assert [kind for kind, *_ in found] == ["record"] * len(PAGES)


def test_salvage_recovers_what_follows_damage(archive):
    whole = list(salvage(archive))
    rng = random.Random(3)
    for _ in range(60):
        at = rng.randrange(len(archive))
        damaged = bytearray(archive)
        damaged[at] ^= 1 << rng.randrange(8)
        found = list(salvage(bytes(damaged)))
        good = {(o, n) for kind, o, n, _ in found if kind == "record"}
        hurt = [r for r in whole if r[1] <= at < r[1] + r[2]]
        for kind, offset, length, _ in whole:  # all records but the damaged one
            if not any(offset == h[1] for h in hurt):
                assert (offset, length) in good
        for kind, offset, length, reason in found:
            if kind == "gap":
                assert reason and any(h[1] <= offset <= h[1] + h[2] for h in hurt)


def test_salvage_of_cut_and_joined_files(archive):
    whole = list(salvage(archive))
    second = whole[1]
    cut = archive[: second[1] + second[2] // 2]
    found = list(salvage(b"garbage" + cut + archive))
    assert sum(kind == "record" for kind, *_ in found) == 1 + len(PAGES)
    gaps = [(o, n) for kind, o, n, _ in found if kind == "gap"]
    assert gaps[0] == (0, 7) and gaps[1] == (7 + second[1], len(cut) - second[1])


def test_gaps_are_logged(pages, spark, tmp_path):
    text = records(pages.drop("payload")).filter("page_id = 7").select(record_text().alias("r")).first().r
    good = (text + RECORD_END).encode()
    bad = re.sub(rb"Content-Length: (\d+)\r\n\r\nHTTP", rb"Content-Length: 9999\r\n\r\nHTTP", good)
    (tmp_path / "x.warc").write_bytes(good + bad + good)
    rows = read_warc(spark, str(tmp_path / "x.warc"), with_payload=False).orderBy("offset").collect()
    assert [(r.kind, r.offset, r.length) for r in rows] == [
        ("record", 0, len(good)), ("gap", len(good), len(bad)), ("record", len(good) + len(bad), len(good))]
    assert rows[1].reason == "truncated or wrong length"
    assert rows[0].payload_bytes == 2


@pytest.mark.parametrize("gzip", [False, True])
def test_very_long_urls_survive(spark, tmp_path, gzip):
    rows = [(1, "http://a/" + "u" * 2_000_000, "<p>x"), (2, "http://a/b", "<p>y"), (3, None, "<p>z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r for r in round_trip(df, str(tmp_path / "w"), gzip).collect()}
    assert {i: got[i].url for i in got} == {i: u for i, u, _ in rows}


def test_damage_behind_a_long_header_is_found(spark, tmp_path):
    rows = [(i, "http://a/" + "u" * 200_000, f"page {i} " * 50) for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    write_warc(records(df), str(tmp_path / "w"))
    data = bytearray(b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*"))))
    second = data.index(b"WARC/1", 100_000)
    data[second + 10 : second + 190_000] = b"v" * 189_990  # the second loses its lines, its type too
    found = list(salvage(bytes(data)))
    assert [k for k, *_ in found].count("record") == 5 and [k for k, *_ in found].count("gap") == 1
    assert sum(length for _, _, length, _ in found) == len(data)


def test_time_grows_with_the_file(spark):
    import time
    import zlib

    def members(n):
        out = []
        for i in range(n):
            body = (f"{i} " * 1500).encode()
            head = f"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: {len(body)}\r\n\r\n".encode()
            pack = zlib.compressobj(0, zlib.DEFLATED, 31)
            out.append(pack.compress(head + body + b"\r\n\r\n") + pack.flush())
        return b"".join(out)

    seconds = []
    for n in (1000, 8000):
        data = members(n)
        start = time.perf_counter()
        assert sum(kind == "record" for kind, *_ in salvage(data)) == n
        seconds.append((time.perf_counter() - start) / len(data))
    assert seconds[1] < 3 * seconds[0]
