"""Secrets in texts: fixed patterns, and a battery of randomness tests for long tokens.

Candidates are tokens of 20 characters or more that fit an encoding (hex, base 32, base 36, base 64, or
letters of one case). Hyphens and underscores that part the groups of a token of one case, as in a UUID,
do not count. The battery asks of each:

* Chi-squared uniformity over the encoding's alphabet, the runs test about the middle of the alphabet and
  the lag-1 serial correlation, the smallest p-value of the three corrected for three tests. Tokens that
  fail (ordered, repeated, periodic) are left alone.
* The likelihood ratio of random against written text: drawn from the encoding's alphabet, or made of
  words, names and numbers, where letters follow one another as in words and characters of one class
  (lower case, upper case, digits) stand together. For a written token the ratio is r or more with a
  probability of 1/r at most, so 1/r is a p-value of "written by people".

As many candidates are tested, a candidate counts as random only under false-discovery control
(Benjamini-Hochberg) of the ratio, apart for each length level and encoding, because evidence grows with
length and with the size of the alphabet.

Only DataFrame functions. The control needs one number per length level and encoding; its counts are kept in
bins of the p-value, so what the driver sees is bounded (levels times encodings times bins), whatever the
corpus.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns and the least length of what counts.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 6
ACCESS = "AKIA[A-Z0-9]{16,}"  # runs of 20 characters or more
HEX = "[0-9a-f]{24,}"  # whole runs, as no shorter run can hold a match
#: In the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
# Alphabets of the encodings, in their own order.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = (DIGITS + "abcdef", LOWER + "234567", DIGITS + LOWER, UPPER + LOWER + DIGITS + "+/", LOWER)
#: -4 ln P(next letter | letter) of words, "a" for 0: a row per letter, a column per next letter. Half
#: from English, French, German and Spanish prose, half from program sources; a tenth is uniform.
PAIR_COSTS = (
    "rqmnpurtmvtlngrqvkkhmstutw", "mvqtfwvvolwfvvltwqqumwwwlv", "lwsvkvwfjwmmtviuvpskquwwvw",
    "lqtpeuwpivwpvpjvwpnnnwsvtw", "ktolmptsnwvlqipqthklrstptt", "kutrmmtthwvnutgswjpnlvvwtv",
    "kqtvewsnlwuntmntwnjomtswwt", "hquwewuolwuqvoluwpomsurwwu", "qsnrlmrutwvnofirvqkjwrvtws",
    "ewqwewwwswswwwjswvtvkwwwvw", "owsrcusvlwvnvprrvrltqumwvw", "kuuqfjvwjwwkvumtwvnoovvwjw",
    "iovsevwwkwvspukjwuospwwwuw", "lqniitjpnvtptoktuqmhqsrwuv", "sqpntltwpvtqofrovhnnjtrvwv",
    "hvtsimwtnwvkvujmwjrkotvwow", "wwwvwwwwwwwvwuvvwsuwawwwww", "krrseuoqlwtrqmktwmmmqtswqv",
    "otmugvsjlvurssnpuslgovtwrw", "mtsujuvehwvrusltwlopnvtwqr", "opquhqssowvlnipnuimlttulwu",
    "gwvwdvwvhwwwtumvwvvwwwvwww", "ivvslvwdhwwswpnwwmqvwwuvww", "kuhujswulwwpqwokrprfwrwrtu",
    "npstjtunmwwppmlhwpiiuuowvv", "mqpugwsrmusqqtostsqqetwwvs",
)
#: Share of neighbours of different classes in written tokens.
WRITTEN_CHANGES = 0.25
DISCOVERY_RATE = 0.01
LEAST_RANDOM = 0.001
BIN = 0.05  # of -log10(p)
MOST_BIN = 400

#: Least bin by length level and encoding.
Thresholds = dict[tuple[int, int], int]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside lambda functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def located(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, value>>`` of the leftmost non-overlapping matches, in code points.

    The text is its gaps and its matches in turn, so a match starts where the lengths before it end.
    Sums go by chunks of 256 matches, which keeps texts with very many matches cheap."""
    chunk = 256
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)

    def spans(hits: Column, gaps: Column, steps: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / chunk).cast("int"))
        sums = F.transform(chunks, lambda c: total(F.slice(steps, c * chunk + 1, chunk)))

        def one(hit: Column, i: Column, sums: Column) -> Column:
            whole = F.floor(i / chunk).cast("int")
            before = total(F.slice(sums, F.lit(1), whole)) + total(
                F.slice(steps, whole * chunk + 1, i % chunk)
            )
            return let(
                before + F.length(F.get(gaps, i)),
                lambda start: F.struct(
                    start.alias("start"),
                    (start + F.length(hit)).alias("end"),
                    hit.alias("value"),
                ),
            )

        return let(sums, lambda s: F.transform(hits, lambda hit, i: one(hit, i, s)))

    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    found = let(
        F.struct(hits.alias("hits"), gaps.alias("gaps")),
        lambda x: let(
            F.zip_with(
                x["hits"],
                F.slice(x["gaps"], F.lit(1), F.size(x["hits"])),
                lambda hit, gap: F.length(hit) + F.length(gap),
            ),
            lambda steps: spans(x["hits"], x["gaps"], steps),
        ),
    )
    # the pattern alone decides first: most texts have no match
    return F.when(text.rlike(pattern), found).otherwise(empty)


def normal_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, with small relative error in the far tail too."""
    # Coefficients of a rational Chebyshev fit of erfc.
    fit = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
           0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)

    def erfc(x: Column) -> Column:
        def of(t: Column) -> Column:
            power = F.lit(fit[-1])
            for c in fit[-2::-1]:
                power = power * t + c
            return t * F.exp(power - x * x)

        return let(1.0 / (1.0 + 0.5 * x), of)

    return let(
        F.abs(z) / math.sqrt(2), lambda x: let(erfc(x), lambda e: F.when(z >= 0, e / 2).otherwise(1 - e / 2))
    )


def two_sided(z: Column) -> Column:
    return 2.0 * normal_tail(F.abs(z))


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))


def _pairs(a: Column, body: Callable[[Column, Column], Column]) -> Column:
    n = F.size(a)
    return F.zip_with(F.slice(a, F.lit(1), n - 1), F.slice(a, F.lit(2), n - 1), body)


def encoding(token: Column) -> Column:
    """Index of the inferred alphabet, or NULL."""
    body = F.rtrim(token, F.lit("="))
    mixed_case = body.rlike("[a-z]") & body.rlike("[A-Z]")
    return (
        F.when(~body.rlike("[A-Za-z]"), F.lit(None))
        .when(mixed_case, F.lit(3))
        .when(body.rlike("[+/]"), F.lit(None))
        .when(~body.rlike("[0-9]"), F.lit(4))
        .when(body.rlike("^([0-9a-f_-]+|[0-9A-F_-]+)$"), F.lit(0))
        .when(body.rlike("^([A-Z2-7_-]+|[a-z2-7_-]+)$"), F.lit(1))
        .otherwise(F.lit(2))
        .cast("int")
    )


def signs(token: Column, kind: Column) -> Column:
    """The characters of a token that its encoding reads; those of one case as lower case."""
    body = F.rtrim(token, F.lit("="))
    one_case = F.translate(body, "-_", "")
    return F.when(kind == 3, F.translate(body, "-_", "+/")).otherwise(F.lower(one_case))


def uniformity(places: Column, kinds: Column) -> Column:
    """Two-sided p-value of chi-squared uniformity (Wilson-Hilferty): too even is no more random
    than too uneven."""
    n = F.size(places)
    squares = _sum(
        F.transform(
            F.array_distinct(places), lambda d: F.pow(F.size(F.filter(places, lambda p: p == d)), F.lit(2))
        )
    )
    free = kinds - 1.0
    ratio = F.greatest((squares * kinds / n - n) / free, F.lit(0.0))
    return two_sided((F.cbrt(ratio) - (1.0 - 2.0 / (9.0 * free))) / F.sqrt(2.0 / (9.0 * free)))


def runs(places: Column, kinds: Column) -> Column:
    """Two-sided p-value of the number of runs above and below the middle of the alphabet."""
    high = F.transform(places, lambda p: (p >= kinds / 2).cast("double"))

    def of(high: Column) -> Column:
        n = F.size(high).cast("double")
        found = 1.0 + _sum(_pairs(high, lambda a, b: F.abs(a - b)))

        def test(upper: Column) -> Column:
            product = 2.0 * upper * (n - upper)
            mean = product / n + 1.0
            variance = product * (product - n) / (n * n * (n - 1.0))
            return F.when(variance > 0, two_sided((found - mean) / F.sqrt(variance))).otherwise(0.0)

        return let(_sum(high), test)

    return let(high, of)


def serial_correlation(places: Column) -> Column:
    """Two-sided p-value of the correlation of neighbours."""
    n = F.size(places).cast("double")

    def of(centred: Column) -> Column:
        spread = _sum(F.transform(centred, lambda x: x * x))
        r = _sum(_pairs(centred, lambda a, b: a * b)) / spread
        return F.when(spread > 0, two_sided((r + 1.0 / n) * F.sqrt(n))).otherwise(0.0)

    return let(
        _sum(places) / n,
        lambda mean: let(F.transform(places, lambda p: p.cast("double") - mean), of),
    )


def _costs() -> tuple[str, list[str]]:
    """Signs of written tokens (all digits as 0, all of +/ as +), and by sign a string of what the next
    one costs: four times -ln P, as code points from 48 on."""
    signs_ = LOWER + UPPER + "0+"
    share = {"L": 26, "U": 26, "0": 10, "+": 2}
    class_of = lambda c: "L" if c in LOWER else "U" if c in UPPER else c

    def cost(a: str, b: str) -> float:
        x, y = class_of(a), class_of(b)
        paired = 0.0
        if x in "LU" and y in "LU":
            paired = (ord(PAIR_COSTS[LOWER.index(a.lower())][LOWER.index(b.lower())]) - 97) / 4
        if x == "U" and y in "LU":  # a capital opens a word or stands in a run of capitals
            return paired - math.log((1 - WRITTEN_CHANGES) / 2)
        if x == y:
            return (paired or math.log(share[y])) - math.log(1 - WRITTEN_CHANGES)
        return math.log(share[y]) - math.log(WRITTEN_CHANGES / (2 if x == "U" else 3))

    return signs_, ["".join(chr(48 + round(4 * cost(a, b))) for b in signs_) for a in signs_]


def written(plain: Column, kinds: Column) -> Column:
    """-log10 of the p-value of the signs ``plain`` if people had written them: the likelihood ratio of
    ``kinds`` equally likely signs against the pairs of written tokens."""
    signs_, rows = _costs()
    table = F.array(*[F.lit(r) for r in rows])
    folded = F.translate(plain, "123456789/", "000000000+")
    at = F.transform(
        F.filter(F.split(folded, ""), lambda c: c != ""), lambda c: F.position(c, F.lit(signs_)) - 1
    )
    cost = lambda a, b: F.ascii(F.substring(F.get(table, a), b + 1, F.lit(1))) - 48
    of = lambda at: _sum(_pairs(at, cost)) / 4.0 - (F.size(at) - 1.0) * F.log(kinds)
    return let(at, of) / math.log(10)


def tested(candidates: Column) -> Column:
    """Candidates of ``located`` that fit an encoding: their span, length level, encoding, bin of the
    p-value for written tokens, and whether the other tests take them for random."""
    alphabets = F.array(*[F.lit(a) for a in ALPHABETS])

    def one(x: Column) -> Column:
        def of(kind: Column, plain: Column) -> Column:
            alphabet = F.get(alphabets, kind)
            kinds = F.length(alphabet).cast("double")
            places = F.transform(
                F.filter(F.split(plain, ""), lambda c: c != ""), lambda c: F.position(c, alphabet) - 1
            )

            def battery(places: Column) -> Column:
                worst = F.least(
                    uniformity(places, kinds), runs(places, kinds), serial_correlation(places)
                )
                return 3.0 * worst >= LEAST_RANDOM

            bin_ = F.floor(written(plain, kinds) / BIN)
            return F.struct(
                x["start"].alias("start"),
                x["end"].alias("end"),
                F.floor(F.log2(F.length(plain))).cast("int").alias("level"),
                kind.alias("encoding"),
                F.greatest(F.lit(0), F.least(bin_, F.lit(MOST_BIN))).cast("int").alias("bin"),
                let(places, battery).alias("random"),
            )

        return let(
            encoding(x["value"]),
            lambda k: F.when(k.isNotNull(), let(signs(x["value"], k), lambda plain: of(k, plain))),
        )

    return F.filter(F.transform(candidates, one), lambda t: t.isNotNull())


def discovery_thresholds(
    docs: DataFrame, text_column: str = "text", rate: float = DISCOVERY_RATE
) -> Thresholds:
    """Least bins by Benjamini-Hochberg over all candidates of ``docs``."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    counts = (
        docs.select(F.explode(tested(located(text, CANDIDATE))).alias("c"))
        .groupBy("c.level", "c.encoding", "c.bin")
        .agg(F.count("*").alias("n"))
        .collect()  # levels x encodings x bins at most
    )
    groups: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for r in counts:
        groups.setdefault((r["level"], r["encoding"]), []).append((r["bin"], r["n"]))
    thresholds: Thresholds = {}
    for group, bins in sorted(groups.items()):
        total, seen = sum(n for _, n in bins), 0
        for bin_, n in sorted(bins, reverse=True):
            seen += n
            if 10 ** (-BIN * bin_) <= rate * seen / total:
                thresholds[group] = bin_
    return thresholds


def with_spans(
    docs: DataFrame, thresholds: Thresholds, text_column: str = "text", name: str = "spans"
) -> DataFrame:
    """``docs`` plus ``array<struct<start, kind, end>>`` of all spans, ordered by start, then kind
    (its place in ``KINDS``). Random tokens that a base span covers are not listed again."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    span = lambda x, kind: F.struct(
        x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")
    )
    of_kind = lambda kind, found: F.transform(found, lambda x: span(x, kind))
    value = lambda x: F.regexp_extract(x["value"], ASSIGN, 2)
    assigned = F.filter(located(text, ASSIGN), lambda x: F.length(value(x)) >= ASSIGN_LEAST)
    base = F.concat(
        *[
            of_kind(k, found)
            for k, found in enumerate((assigned, located(text, ACCESS), located(text, HEX)))
        ]
    )
    def found(t: Column) -> Column:
        wanted = F.lit(False)
        for (level, kind), bin_ in thresholds.items():
            wanted = wanted | ((t["level"] == level) & (t["encoding"] == kind) & (t["bin"] >= bin_))
        return wanted & t["random"]

    tokens = F.filter(tested(located(text, CANDIDATE)), found)
    spans = let(
        base,
        lambda base: F.concat(
            base,
            F.transform(
                F.filter(
                    tokens,
                    lambda t: ~F.exists(
                        base, lambda b: (b["start"] <= t["start"]) & (t["end"] <= b["end"])
                    ),
                ),
                lambda t: span(t, 3),
            ),
        ),
    )
    return docs.withColumn(name, F.array_sort(spans))


def listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )
    return F.array_join(F.transform(spans, one), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span replaced; spans that overlap become one mark."""
    # state: end of what is copied, and the pieces so far
    state = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")
    )

    def add(s: Column, x: Column) -> Column:
        inside = x["start"] < s["at"]
        piece = F.substring(text, s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0)))
        return F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(inside, s["parts"])
            .otherwise(F.concat(s["parts"], F.array(piece, F.lit(mark))))
            .alias("parts"),
        )

    def done(s: Column) -> Column:
        rest = F.substring(text, s["at"] + 1, F.length(text))
        return F.concat(F.array_join(s["parts"], ""), rest)

    return F.when(F.size(spans) > 0, F.aggregate(spans, state, add, done)).otherwise(text)


def secret_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    NULL and empty texts have no spans (the digest is that of nothing); repeated rows are reported as
    often as they occur; an empty table gives no rows; further columns of ``docs`` are ignored."""
    docs = docs.select("doc_id", "text")
    found = with_spans(docs, discovery_thresholds(docs), name="_spans")
    of_kind = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("_spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("_spans")).alias("spans"),
    )
