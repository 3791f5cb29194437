"""Main text: markup roles, frames of a host, and the edge cases."""

import html
import random
from collections import Counter

import pytest

from ebbtide.llm import html as H
from ebbtide.llm.html import main_text, parse


def text_of(page: str) -> str:
    found = parse(page)
    return " ".join(found.rest if found.article is None else found.article)


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a&nbsp; b<p>c<b>d</b>e", "a b cde"),
        ("<head><title>t</title></head><body><nav>n</nav><article><h1>H</h1><p>x<br>y</article><footer>f", "H x y"),
        ("<main><p>m</p><aside>s</aside></main><p>out", "m"),
        ("<main>m<article>a</article></main>", "a"),
        ("<div class='cookie-notice'>c</div><p>text</p><div id=comments><article>c</article></div>", "text"),
        ("<article>a<section class='post-comments'>c</section>b</article>", "a b"),
        ("<article>a<form>f</form><div class='ad'>x</div><script>var t='</p>';</script>b", "a b"),
        ("<style>p{}</style><!-- <p>no</p> --><p hidden>h</p><p style='display: none'>h</p><p>yes", "yes"),
        ("<header>top</header><article><header><h1>H</h1></header>x", "H x"),
        ("<div role='navigation'>n</div><p>x < y</p>", "x < y"),
        ("<article><p>it's <a href='x>y'>linked</a> text</p></article>", "it's linked text"),
        ("<article></article><p>only here</p>", "only here"),
        ("<p>&lt;b&gt; &#233; &#x41; &unknown;</p>", "<b> é A &unknown;"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "a b c"),
        ("<script>never closed", ""),
        ("a<br/>b<svg><text>s</text></svg>c", "a b c"),
        ("<div class=reader-wrapper>kept</div>", "kept"),
    ],
)
def test_roles(page, want):
    assert text_of(page) == want


def site(host: int, pages: int) -> list:
    out = []
    for i in range(pages):
        own = "".join(
            f"<div>{' '.join(f'w{host}x{i}x{j}x{k}' for k in range(20))}</div>" for j in range(3)
        )
        out.append((
            host * 1000 + i, f"http://h{host}.org/{i}",
            f"<div>Home About us Contact Shop</div><div>Welcome to site {host} for you</div>{own}"
            f"<div>All rights reserved by the company {host}</div>", "extra",
        ))
    return out


SCHEMA = "page_id long, url string, html string, text string"


def test_frame_of_a_host_goes(spark):
    pages = site(1, 30) + site(2, 30)
    copies = [(5000 + i, "http://h1.org/copy", pages[4][2], "extra") for i in range(8)]
    odd = [(9000, None, None, "e"), (9001, "no url", "", "e"), (9002, None, "<p>alone here</p>", "e")]
    df = spark.createDataFrame(pages + copies + odd + odd[2:], SCHEMA)
    got = {}
    for r in main_text(df).collect():
        got.setdefault(r.page_id, []).append(r)
    for page, _, _, _ in pages:
        host, i = divmod(page, 1000)
        want = " ".join(f"w{host}x{i}x{j}x{k}" for j in range(3) for k in range(20))
        assert got[page][0].text == want and got[page][0].n_chars == len(want)
    for i in range(8):  # a page's copies do not make its text a frame
        assert got[5000 + i][0].text == got[1004][0].text
    assert got[9000][0].text == got[9001][0].text == "" and got[9000][0].n_chars == 0
    assert [r.text for r in got[9002]] == ["alone here"] * 2
    assert main_text(df.limit(0)).count() == 0


def test_many_shards_keep_all_pages(spark, monkeypatch):
    monkeypatch.setattr(H, "SHARD_BYTES", 4000)
    df = spark.createDataFrame(site(1, 40), SCHEMA)
    assert main_text(df).select("page_id").distinct().count() == 40


def article_of(page: str) -> str:
    article = page.split("<article>")[1].split("</article>")[0]
    article = article.replace("<b>", "").replace("</b>", "")
    for tag in ("p", "/p", "h1", "/h1", "br"):
        article = article.replace(f"<{tag}>", " ")
    return " ".join(html.unescape(article).split())


@pytest.mark.parametrize("table", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_every_article_of_the_table_is_whole(spark, table):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{table}/pages.parquet").collect()}
    rows = main_text(spark.read.parquet(f"{table}/pages.parquet")).collect()
    assert len(rows) == len(pages)
    assert [r.page_id for r in rows if r.text != article_of(pages[r.page_id])] == []


def plain_frames(pages: list) -> dict:
    """The frames of hosts in plain Python: strings of blocks, pages counted by their first block list."""
    hosts: dict = {}
    for _, url, page, *_ in pages:
        found = parse(page or "")
        hosts.setdefault(url, []).append(found)
    out = {}
    for url, found in hosts.items():
        loose = any(f.article is None for f in found)
        distinct = {tuple(f.rest if f.article is None else f.article): f for f in found}
        counts = Counter()
        for blocks, f in distinct.items():
            counts.update({s for b in [*blocks, *(f.outside if loose else [])] for s in strings(b.split(" "))})
        n = len(distinct)
        least = max(H.MIN_PAGES, (H.MIN_SHARE if loose else H.MOST_SHARE) * n)
        out[url] = {s: c >= H.MOST_SHARE * n for s, c in counts.items() if c >= least}
    return out


def strings(words: list) -> list:
    n = H.MIN_RUN
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)] or [(*words, len(words))]


def plain_text(page: str, frames: dict) -> str:
    found = parse(page or "")
    kept = []
    for block in found.rest if found.article is None else found.article:
        words = block.split(" ")
        strict = found.article is not None or len(words) < H.MIN_RUN
        cover = [False] * len(words)
        for i, s in enumerate(strings(words)):
            if frames.get(s, False) or (s in frames and not strict):
                cover[i : i + H.MIN_RUN] = [True] * len(cover[i : i + H.MIN_RUN])
        if sum(cover) / len(cover) < H.COVERED:
            kept.append(block)
    return " ".join(kept)


@pytest.mark.parametrize("shard_bytes", [2 << 20, 3000, 500])
def test_frames_equal_plain_python(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(H, "SHARD_BYTES", shard_bytes)
    rng = random.Random(11)
    common = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 14))) for _ in range(12)]
    pages = []
    for i in range(160):
        blocks = [" ".join(f"p{i}x{j}x{k}" for k in range(rng.randint(8, 20))) for j in range(2)]
        blocks += rng.sample(common, rng.randint(0, 5)) + ([common[0], common[1]] if rng.random() < 0.6 else [])
        rng.shuffle(blocks)
        body = "".join(f"<p>{b}</p>" for b in blocks)
        marked = i % 4 == 0 if i % 2 else i % 3 > 0
        side = "".join(f"<p>{b}</p>" for b in rng.sample(common, 2))
        page = f"<nav>{side}</nav><article>{body}</article>" if marked or i % 5 == 0 else f"<div>{body}</div><footer>{side}</footer>"
        pages.append((i, f"http://h{i % 5}.org/", page, "extra"))
    frames = plain_frames(pages)
    assert all(frames.values())
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert got == {i: plain_text(page, frames[url]) for i, url, page, _ in pages}


NOTICE = "This text may be shared under the usual terms of the site"


def articles(pages: int, with_notice: int) -> list:
    out = []
    for i in range(pages):
        own = " ".join(f"w{i}x{k}" for k in range(40))
        notice = f"<p>{NOTICE}</p>" if i < with_notice else ""
        out.append((i, "http://one.org/", f"<nav>menu</nav><article><p>{own}</p>{notice}</article>", "extra"))
    return out


def test_notice_inside_marked_articles_goes(spark):
    rows = main_text(spark.createDataFrame(articles(30, 30), SCHEMA)).collect()
    assert len(rows) == 30
    for r in rows:
        assert r.text == " ".join(f"w{r.page_id}x{k}" for k in range(40))


def test_notice_in_some_marked_articles_stays(spark):
    rows = main_text(spark.createDataFrame(articles(120, 40), SCHEMA)).collect()
    assert sum(NOTICE in r.text for r in rows) == 40


def test_frames_do_not_depend_on_the_number_of_shards(spark, monkeypatch):
    # in shards of a few pages the notice is seldom on three of them
    pages = [(i, url, h.replace("article", "div"), e) for i, url, h, e in articles(120, 12)]
    copies = [(1000 + i, "http://one.org/", pages[100][2].replace("w100x39", f"w100y{i}"), "e") for i in range(20)]
    df = spark.createDataFrame(pages + copies, SCHEMA)
    whole = {r.page_id: r.text for r in main_text(df).collect()}
    monkeypatch.setattr(H, "SHARD_BYTES", 1500)
    cut = {r.page_id: r.text for r in main_text(df).collect()}
    assert cut == whole and len(whole) == 140
    assert not any("usual terms" in t for t in whole.values())
    assert all(t.split() for t in whole.values())  # near copies do not make their text a frame
