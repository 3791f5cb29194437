"""Main text of web pages: markup roles, and a suffix array over the pages of a host.

Markup is the first filter: navigation, headers, footers, sidebars, forms, scripts, notices, adverts and
comments are left out, and of a page that marks its article (``article`` or ``main``) only that is a
candidate; what lies outside takes part as evidence where other pages of the host mark none.

The token streams of a host, one per block, are then sorted to suffix arrays. A string of ``MIN_RUN``
tokens or more that stands on several distinct pages of the host is boilerplate: what the pages share is
their frame. Blocks that such strings cover go; blocks with text of their own stay. What a page marks as
its article is part of the document, so a string goes from there only if most pages have it in theirs; so
does a block of fewer tokens, which is one string by itself, from any page. Pages whose candidates are
nearly equal count as one, so that a page's copies do not make its text a frame.

A host's pages are dealt to shards of bounded size, a suffix array each, so that no host, however large,
is one task. A string on a share of a host's pages has that share in at least one of its shards: what a
shard finds on too few of its own pages stays there, and what is left is counted in all shards of the
host. The frames go back to the pages of hosts that have any.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ebbtide.llm.common import mixed, scratch_path, shared_dir, slices
from ebbtide.llm.suffix import doubled_ranks

MIN_RUN = 6
#: A run is a frame when it is on this many distinct pages of the host, and on this share of them; in
#: marked articles, and for blocks shorter than a run, on the larger share.
MIN_PAGES = 3
MIN_SHARE = 0.05
MOST_SHARE = 0.5
#: Share of a block's tokens that must be covered for the block to go.
COVERED = 0.8
#: Bytes of text of a shard.
SHARD_BYTES = 2 << 20

# Elements by what they mean for the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
LEFT_OUT = frozenset(
    "applet aside audio button canvas datalist dialog embed footer form frame frameset head iframe map math "
    "menu nav noframes noscript object script select style svg template textarea title video".split()
)
#: Their content is no markup, up to their end tag.
RAW = frozenset("script style textarea title iframe noframes xmp".split())
LEFT_OUT_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "toolbar".split()
)
#: Words in class or id that mark what is not the article.
LEFT_OUT_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs captcha comment comments "
    "consent cookie cookies copyright disqus footer gdpr header login masthead menu modal "
    "nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion "
    "related respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "toolbar widget".split()
)
#: Elements that hold the whole page or article; their class says nothing of their text's role.
WHOLE = frozenset("html body main article".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.S
)
_ATTRIBUTE = re.compile(
    r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.S
)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Parsed:
    """Blocks of the article (None where the page marks none), of the rest that may be text, and of what
    was left out."""

    article: list[str] | None
    rest: list[str]
    outside: list[str]


def _left_out(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in LEFT_OUT or (tag == "header" and not in_article):
        return True
    if not attributes.strip():
        return False
    given = {
        m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)
    }
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true":
        return True
    if given.get("role", "").lower() in LEFT_OUT_ROLES or _HIDDEN.search(given.get("style", "")):
        return True
    if tag in WHOLE:
        return False
    words = _WORD.findall(f"{given.get('class', '')} {given.get('id', '')}")
    return any(w.lower() in LEFT_OUT_WORDS for w in words)


def parse(page: str) -> Parsed:
    """Blocks of a page in order, references decoded, white space made one space."""
    blocks: dict[str, list[str]] = {"article": [], "main": [], "rest": [], "outside": []}
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, left out, in article, in main
    seen = {"article": False, "main": False}
    text: list[str] = []
    where = "rest"

    def close_block() -> None:
        if text:
            clean = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if clean:
                blocks[where].append(clean)

    def place() -> str:
        if not stack:
            return "rest"
        _, out, article, main = stack[-1]
        return "outside" if out else "article" if article else "main" if main else "rest"

    at = 0
    while True:
        match = _TAG.search(page, at)
        if match is None:
            text.append(page[at:])
            break
        if match.start() > at:
            text.append(page[at : match.start()])
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCK:
            close_block()
        if match[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                del stack[depth:]
        elif tag not in VOID:
            if tag in _SCOPE:
                _imply_end(stack, tag)
            _, out, article, main = stack[-1] if stack else ("", False, False, False)
            out = out or _left_out(tag, match[3] or "", article or main)
            if not out:
                article, main = article or tag == "article", main or tag == "main"
                for name in seen:
                    seen[name] |= tag == name
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            elif not (match[3] or "").endswith("/") or tag not in ("svg", "math"):
                stack.append((tag, out, article, main))
        if place() != where:  # what was read so far belongs to the old place
            close_block()
            where = place()
    close_block()
    found = "article" if seen["article"] and blocks["article"] else "main" if seen["main"] else None
    if found == "main" and not (blocks["main"] or blocks["article"]):
        found = None
    if found is None:
        return Parsed(None, blocks["rest"] + blocks["main"] + blocks["article"], blocks["outside"])
    return Parsed(blocks[found], [], blocks["outside"] + blocks["rest"])


#: What an element may be inside of and still end an open one of its kind.
_SCOPE = {
    "p": frozenset("body div section article main td th li blockquote".split()),
    "li": frozenset("ul ol menu".split()),
    "td": frozenset(["tr", "table"]),
    "th": frozenset(["tr", "table"]),
    "tr": frozenset("table tbody thead tfoot".split()),
    "dd": frozenset(["dl"]),
    "dt": frozenset(["dl"]),
    "option": frozenset(["select", "datalist"]),
}


def _imply_end(stack: list, tag: str) -> None:
    """An open element of this kind ends where the next one begins, unless a container lies between."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == tag or {stack[i][0], tag} == {"td", "th"} or {stack[i][0], tag} == {"dd", "dt"}:
            del stack[i:]
            return
        if stack[i][0] in _SCOPE[tag]:
            return


def host_of(url: Column) -> Column:
    """Lower-case host; empty for NULL and for what is no URL."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.coalesce(F.lower(host), F.lit(""))


_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD1B54A32D192ED03)
MOST_WORDS = 1 << 20


class Words:
    """64-bit hashes of words, kept as long as they are few."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def of(self, block: str) -> np.ndarray:
        """Hashes of the tokens of a block."""
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        out = []
        for word in block.split(" "):
            value = self.known.get(word)
            if value is None:
                digest = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
                value = self.known[word] = int.from_bytes(digest, "little")
            out.append(value)
        return np.array(out, np.uint64)


def runs_of(words: np.ndarray) -> np.ndarray:
    """Hash of the run of ``MIN_RUN`` tokens at every start; of a shorter block one of all its tokens and
    their number, which is unlike any run's."""
    if len(words) < MIN_RUN:
        total = np.array([len(words)], np.uint64)
        for word in words:
            total = total * _STEP + word
        return mixed(total ^ _OTHER).view(np.int64)
    n = len(words) - MIN_RUN + 1
    total = np.zeros(n, np.uint64)
    for k in range(MIN_RUN):
        total = total * _STEP + words[k : k + n]
    return mixed(total).view(np.int64)


def likeness(blocks: list[np.ndarray]) -> int:
    """Equal for equal pages, and for nearly equal ones most likely: two least hashes of their runs."""
    runs = np.concatenate([runs_of(w) for w in blocks]).view(np.uint64) if blocks else np.zeros(1, np.uint64)
    least = np.array([runs.min(), mixed(runs ^ _OTHER).min()], np.uint64)
    return int((mixed(least[:1]) * _STEP + mixed(least[1:])).view(np.int64)[0])


def counted_runs(pages: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct runs of a shard, and on how many pages each is. A page is a list of blocks.
    In suffix order the starts of equal runs are neighbours."""
    short = [(i, w) for i, page in enumerate(pages) for w in page if len(w) < MIN_RUN]
    long = [(i, w) for i, page in enumerate(pages) for w in page if len(w) >= MIN_RUN]
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    if long:
        sizes = np.array([len(w) for _, w in long])
        first = np.cumsum(sizes) - sizes
        starts = np.concatenate([at + np.arange(n - MIN_RUN + 1) for at, n in zip(first, sizes, strict=True)])
        page = np.repeat(np.array([i for i, _ in long]), sizes - MIN_RUN + 1)
        tokens = np.unique(np.concatenate([w for _, w in long]), return_inverse=True)[1]
        rank = doubled_ranks(tokens, 1, starts, MIN_RUN)
        values, at, rank = np.unique(rank, return_index=True, return_inverse=True)
        on = np.unique(rank * len(pages) + page) // len(pages)
        runs = np.concatenate([runs_of(w) for _, w in long])[at]
        found.append((runs, np.bincount(on, minlength=len(values))))
    if short:
        keys = np.concatenate([runs_of(w) for _, w in short])
        values, which = np.unique(keys, return_inverse=True)
        on = np.unique(which * len(pages) + np.array([i for i, _ in short])) // len(pages)
        found.append((values, np.bincount(on, minlength=len(values))))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def without_frame(blocks: list[str], words: Words, some: np.ndarray, most: np.ndarray) -> list[str]:
    """The blocks that the runs ``some`` (short blocks: ``most``) do not cover."""
    kept = []
    for block in blocks:
        tokens = words.of(block)
        if len(tokens) < MIN_RUN:
            framed = 1.0 if np.isin(runs_of(tokens), most)[0] else 0.0
        else:
            hit = np.flatnonzero(np.isin(runs_of(tokens), some))
            cover = np.zeros(len(tokens) + 1, np.int64)
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + MIN_RUN, -1)
            framed = (np.cumsum(cover)[:-1] > 0).mean()
        if framed < COVERED:
            kept.append(block)
    return kept


# --- hosts ------------------------------------------------------------------------------------

_PARSED = (
    "url string, host string, marked boolean, blocks array<string>, outside array<string>, "
    "likeness long, mark long, bytes long"
)


def _parsed(rows: DataFrame, id_type: str) -> DataFrame:
    """Every page parsed once, in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in slices(batches, "html", 4 << 20):
            out = []
            for page in batch.column(2):
                parsed = parse(page.as_py() or "")
                marked = parsed.article is not None
                blocks = parsed.article if marked else parsed.rest
                text = "\n".join([*blocks, "", *parsed.outside]).encode("utf-8", "surrogatepass")
                mark = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)
                alike = likeness([words.of(b) for b in blocks])
                out.append((marked, blocks, parsed.outside, alike, mark, len(text)))
            kinds = [pa.bool_(), pa.list_(pa.string()), pa.list_(pa.string()), *[pa.int64()] * 3]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), *columns],
                names=["page_id", "url", "host", "marked", "blocks", "outside", "likeness", "mark", "bytes"],
            )

    schema = f"page_id {id_type}, {_PARSED}"
    parsed = rows.select("page_id", "url", "html", "host").mapInArrow(run, schema)
    return _stored(parsed, "pages")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: the files say how large it is."""
    spark = df.sparkSession
    shared_dir(spark)
    path = scratch_path(spark, name)
    df.write.option("parquet.block.size", 16 << 20).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _evidence(parsed: DataFrame, hosts: DataFrame) -> DataFrame:
    """``host, shard, shards, loose, likeness, mark, size, packed``: what the pages of a host are counted
    by, their blocks compressed. Of pages that are alike only those with the smallest mark so far leave a
    task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple[str, int], int] = {}
        for batch in batches:
            kept = []
            columns = (batch.column(n).to_pylist() for n in ("host", "likeness", "mark"))
            for i, (host, alike, mark) in enumerate(zip(*columns, strict=True)):
                if mark < least.get((host, alike), 1 << 63):
                    least[host, alike] = mark
                    kept.append(i)
            if len(least) > MOST_WORDS:
                least.clear()
            chosen = batch.take(pa.array(kept, pa.int64()))
            raw = ["\n".join(b).encode("utf-8", "surrogatepass") for b in chosen.column("blocks").to_pylist()]
            packed = [pa.compress(r, codec="zstd", asbytes=True) if r else b"" for r in raw]
            yield pa.RecordBatch.from_arrays(
                [
                    *[chosen.column(n) for n in ("host", "shard", "shards", "loose", "likeness", "mark")],
                    pa.array([len(r) for r in raw], pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
                names=["host", "shard", "shards", "loose", "likeness", "mark", "size", "packed"],
            )

    blocks = F.when(F.col("loose"), F.concat("blocks", "outside")).otherwise(F.col("blocks"))
    dealt = parsed.join(hosts, "host").select(
        "host",
        F.pmod("likeness", F.col("shards")).alias("shard"),
        "shards",
        "loose",
        "likeness",
        "mark",
        blocks.alias("blocks"),
    )
    return dealt.mapInArrow(
        run,
        "host string, shard long, shards long, loose boolean, likeness long, mark long, size long, "
        "packed binary",
    )


def _distinct_pages(shard: pa.Table) -> list[list[np.ndarray]]:
    held: dict[int, dict] = {}
    for row in shard.select(["likeness", "mark", "size", "packed"]).to_pylist():
        if row["likeness"] not in held or row["mark"] < held[row["likeness"]]["mark"]:
            held[row["likeness"]] = row
    words, pages = Words(), []
    for row in held.values():
        raw = pa.decompress(row["packed"], row["size"], codec="zstd", asbytes=True) if row["size"] else b""
        blocks = raw.decode("utf-8", "surrogatepass").split("\n") if raw else []
        pages.append([words.of(b) for b in blocks])
    return pages


def frames_of(parsed: DataFrame, hosts: DataFrame, groups: int) -> DataFrame:
    """``host, run, most``: the frames of whole hosts, and whether most pages have them."""
    counted = "host string, run long, n long, pages long, loose boolean, whole boolean"
    nothing = to_arrow_schema(StructType.fromDDL(counted)).empty_table()

    def least(pages: int, loose: bool) -> float:
        """Pages that make a frame, if all are known."""
        return max(MIN_PAGES, (MIN_SHARE if loose else MOST_SHARE) * pages)

    def table(shard: pa.Table, runs: np.ndarray, n: np.ndarray, pages: int) -> pa.Table:
        first = {c: shard.column(c)[0].as_py() for c in ("host", "loose", "shards")}
        size = len(runs) + 1
        return pa.table(
            {
                "host": pa.array([first["host"]] * size, pa.string()),
                "run": pa.array([None, *runs.tolist()], pa.int64()),
                "n": pa.array([pages, *n.tolist()], pa.int64()),
                "pages": pa.array([pages] * size, pa.int64()),
                "loose": pa.array([first["loose"]] * size, pa.bool_()),
                "whole": pa.array([first["shards"] == 1] * size, pa.bool_()),
            }
        )

    def count(shard: pa.Table) -> pa.Table:
        pages = _distinct_pages(shard)
        runs, n = counted_runs(pages)
        loose, whole = shard.column("loose")[0].as_py(), shard.column("shards")[0].as_py() == 1
        share = (MIN_SHARE if loose else MOST_SHARE) * len(pages)
        kept = n >= (least(len(pages), loose) if whole else share)
        return table(shard, runs[kept], n[kept], len(pages))

    def recount(shard: pa.Table, wanted: pa.Table) -> pa.Table:
        if not shard.num_rows:
            return nothing
        pages = _distinct_pages(shard)
        candidates = np.unique(wanted.column("run").to_numpy()) if wanted.num_rows else np.zeros(0, np.int64)
        n = np.zeros(len(candidates), np.int64)
        for page in pages if len(candidates) else []:
            runs = np.unique(np.concatenate([runs_of(w) for w in page])) if page else np.zeros(0, np.int64)
            n += np.isin(candidates, runs)
        return table(shard, candidates, n, len(pages))

    key = ["host", "shard"]
    dealt = _evidence(parsed, hosts)
    first = _stored(
        dealt.repartition(groups, *key).groupBy(*key).applyInArrow(count, counted), "runs"
    )
    whole = first.filter("whole AND run IS NOT NULL")
    # hosts of several shards: what some shard has on enough of its pages is counted in all of them
    wanted = first.filter("NOT whole AND run IS NOT NULL").select("host", "run").distinct()
    spread = wanted.join(hosts.filter("shards > 1"), "host").select(
        "host", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), "run"
    )
    asked = parsed.join(wanted.select("host").distinct(), "host", "left_semi")
    again = (
        _evidence(asked, hosts.filter("shards > 1"))
        .repartition(groups, *key)
        .groupBy(*key)
        .cogroup(spread.repartition(groups, *key).groupBy(*key))
        .applyInArrow(recount, counted)
        .groupBy("host", "run")
        .agg(F.sum("n").alias("n"), F.first("loose").alias("loose"))
    )
    again = _stored(again, "recounted")
    totals = again.filter("run IS NULL").select("host", F.col("n").alias("pages"))
    share = F.when(F.col("loose"), F.lit(MIN_SHARE)).otherwise(F.lit(MOST_SHARE))
    across = (
        again.filter("run IS NOT NULL")
        .join(totals, "host")
        .filter((F.col("n") >= MIN_PAGES) & (F.col("n") >= share * F.col("pages")))
    )
    most = (F.col("n") >= MOST_SHARE * F.col("pages")).alias("most")
    return whole.select("host", "run", most).unionByName(across.select("host", "run", most))


def _texts(parsed: DataFrame, hosts: DataFrame, frames: DataFrame, id_type: str, groups: int) -> DataFrame:
    """Texts of all pages without the frames of their hosts; pages of hosts without frames stay where
    they are."""
    own = ["page_id", "url"]
    framed = frames.select("host").distinct()
    plain = parsed.join(framed, "host", "left_anti").select(
        *own, F.array_join("blocks", " ").alias("text")
    )
    deal = F.pmod(F.xxhash64("page_id", "url", "mark"), F.col("shards"))
    dealt = (
        parsed.join(framed, "host", "left_semi")
        .join(hosts, "host")
        .select("host", deal.alias("shard"), *own, "marked", "blocks")
    )
    told = frames.join(hosts, "host").select(
        "host",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"),
        "run",
        "most",
    )

    def judge(pages: pa.Table, told: pa.Table) -> pa.Table:
        texts = []
        if pages.num_rows:
            runs = told.column("run").to_numpy() if told.num_rows else np.zeros(0, np.int64)
            high = np.array(told.column("most").to_pylist(), bool)
            words, most = Words(), runs[high]
            for marked, blocks in zip(*[pages.column(c).to_pylist() for c in ("marked", "blocks")], strict=True):
                texts.append(" ".join(without_frame(blocks, words, most if marked else runs, most)))
        return pa.table(
            {
                "page_id": pages.column("page_id"),
                "url": pages.column("url"),
                "text": pa.array(texts, pa.string()),
            }
        )

    out = f"page_id {id_type}, url string, text string"
    by = ("host", "shard")
    judged = (
        dealt.repartition(groups, *by)
        .groupBy(*by)
        .cogroup(told.repartition(groups, *by).groupBy(*by))
        .applyInArrow(judge, out)
    )
    return plain.unionByName(judged)


def main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars`` (code points).

    NULL and empty html, and pages without text, give an empty text; a NULL url is a host of its own;
    repeated rows are extracted as often as they occur; an empty table gives no rows; further columns
    are ignored."""
    rows = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    rows = rows.withColumn("host", host_of(F.col("url")))
    id_type = pages.schema["page_id"].dataType.simpleString()
    parsed = _parsed(rows, id_type)
    hosts = _stored(
        parsed.groupBy("host").agg(
            F.ceil((F.sum("bytes") + 1) / SHARD_BYTES).alias("shards"),
            F.bool_or(~F.col("marked")).alias("loose"),
        ),
        "hosts",
    )
    # tasks by the work of a shard, not by the bytes of its rows
    total = parsed.agg(F.sum("bytes")).first()[0] or 0
    groups = 2 * (1 + total // SHARD_BYTES)
    frames = _stored(frames_of(parsed, hosts, groups), "frames")
    texts = _texts(parsed, hosts, frames, id_type, groups)
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
