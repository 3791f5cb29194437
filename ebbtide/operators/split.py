"""Stratified splitting without a global sort.

Rows are ordered by a seeded hash of their key. Per label, each split takes a contiguous run of
that order, so a split is fully described by one cut ``(hash, key)`` per label and boundary.
Finding the cuts takes three narrow passes over key and label: a histogram of the leading hash
digits, the same for the next digits inside the few bins that hold a cut, and a running count over
the one remaining bin. What returns to the driver is bounded by bins x labels, whatever the
number of rows. Assigning the split afterwards is a projection: no shuffle, no join.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.columns import any_of, key_text, row_hash

# Split names, holdout share, share of the holdout kept for the internal test, seed.
TRAIN, VALIDATION, INTERNAL_TEST, EXTERNAL_TEST = (
    "training",
    "validation",
    "internal_test",
    "external_test",
)
HOLDOUT = 0.30
TEST_WITHIN_HOLDOUT = 0.50
SEED = 42

# Hex digits of the hash per histogram: 16^2 bins.
BIN_DIGITS = 2
# A bin of this many rows is ranked by one task; larger ones are divided further.
RANKABLE = 1_000_000
# Six histograms make 16^12 bins: what is still large then is one key with many copies.
MAX_DEPTH = 5


@dataclass(frozen=True)
class Cut:
    """Rows of ``label`` up to and including ``(hash, key)`` lie before the boundary."""

    label: object
    boundary: int
    hash: str
    key: str


@dataclass(frozen=True)
class SplitCuts:
    """Fitted split: per label, the end of the training run and of the validation run."""

    keys: tuple[str, ...]
    label: str
    seed: int
    cuts: tuple[Cut, ...]

    def assign(self, df: DataFrame, name: str = "split") -> DataFrame:
        """Add the split column. Copies of one key always land in the same split."""
        text = key_text(self.keys)
        hashed = df.withColumn("_hash", row_hash(text, self.seed))
        before = [
            any_of(
                (F.col(self.label) == F.lit(c.label))
                & (
                    (F.col("_hash") < F.lit(c.hash))
                    | ((F.col("_hash") == F.lit(c.hash)) & (text <= F.lit(c.key)))
                )
                for c in self.cuts
                if c.boundary == boundary
            )
            for boundary in (0, 1)
        ]
        split = F.when(before[0], TRAIN).when(before[1], VALIDATION).otherwise(INTERNAL_TEST)
        return hashed.withColumn(name, split).drop("_hash")


def _largest_remainder(sizes: Mapping[object, int], draws: int) -> dict[object, int]:
    """Share ``draws`` out in proportion to ``sizes``; left-over units go to the largest
    remainders, the earlier label first on ties. Exact integer arithmetic."""
    total = sum(sizes.values())
    quota = {k: n * draws // total for k, n in sizes.items()}
    by_remainder = sorted(sizes, key=lambda k: (-(sizes[k] * draws % total), k))
    for k in by_remainder[: draws - sum(quota.values())]:
        quota[k] += 1
    return quota


def quotas(
    sizes: Mapping[object, int],
    holdout: float = HOLDOUT,
    test_within_holdout: float = TEST_WITHIN_HOLDOUT,
) -> dict[object, tuple[int, int]]:
    """Rows per label for (training, validation); what remains is the internal test."""
    total = sum(sizes.values())
    held = math.ceil(holdout * total)
    train = _largest_remainder(sizes, total - held)
    left = {k: n - train[k] for k, n in sizes.items()}
    validation = _largest_remainder(left, held - math.ceil(test_within_holdout * held))
    return {k: (train[k], validation[k]) for k in sizes}


def _bin(depth: int) -> Column:
    return F.substring("_hash", 1, BIN_DIGITS * (depth + 1))


def _locate(bins: Sequence[tuple[str, int]], rank: int) -> tuple[str, int]:
    """The bin holding the row of this rank (1-based), and the rank within it."""
    for position, size in sorted(bins):
        if rank <= size:
            return position, rank
        rank -= size
    raise ValueError("rank beyond the histogram")


def fit_split(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    holdout: float = HOLDOUT,
    test_within_holdout: float = TEST_WITHIN_HOLDOUT,
    seed: int = SEED,
) -> SplitCuts:
    """Exact stratified split of rows with a unique key."""
    text = key_text(keys)
    rows = df.select(F.col(label).alias("_label"), row_hash(text, seed).alias("_hash"), text.alias("_key"))

    # bins x labels rows
    counted = rows.groupBy("_label", _bin(0).alias("_bin")).count().collect()
    histogram: dict[object, list[tuple[str, int]]] = defaultdict(list)
    for row in counted:
        histogram[row["_label"]].append((row["_bin"], row["count"]))
    if None in histogram:
        raise ValueError(f"NULL values in: {label}")
    sizes = {k: sum(n for _, n in bins) for k, bins in sorted(histogram.items())}

    # (label, boundary) -> bin and rank within it, for the boundaries that have rows before them
    open_cuts = {}
    for k, (train, validation) in quotas(sizes, holdout, test_within_holdout).items():
        for boundary, rank in enumerate((train, train + validation)):
            if rank:
                open_cuts[k, boundary] = _locate(histogram[k], rank)
    if not open_cuts:
        return SplitCuts(tuple(keys), label, seed, ())

    def inside(depth: int) -> Column:
        bins = sorted({(k, position) for (k, _), (position, _) in open_cuts.items()})
        return any_of((F.col("_label") == F.lit(k)) & (_bin(depth) == F.lit(p)) for k, p in bins)

    # Next digits, only inside the bins found so far, until a bin is small enough to rank.
    depth = 0
    held = {(k, p): n for k, bins in histogram.items() for p, n in bins}
    while depth < MAX_DEPTH and max(held[k, p] for (k, _), (p, _) in open_cuts.items()) > RANKABLE:
        outer, inner = _bin(depth).alias("_outer"), _bin(depth + 1).alias("_bin")
        finer: dict[tuple[object, str], list[tuple[str, int]]] = defaultdict(list)
        held = {}
        for row in rows.filter(inside(depth)).groupBy("_label", outer, inner).count().collect():
            finer[row["_label"], row["_outer"]].append((row["_bin"], row["count"]))
            held[row["_label"], row["_bin"]] = row["count"]
        open_cuts = {
            (k, boundary): _locate(finer[k, position], rank)
            for (k, boundary), (position, rank) in open_cuts.items()
        }
        depth += 1

    # A running count over the distinct keys of each bin; copies of a key are one entry. Of each
    # cut the one entry that reaches its rank comes back.
    entries = rows.filter(inside(depth)).withColumn("_bin", _bin(depth))
    entries = entries.groupBy("_label", "_bin", "_hash", "_key").count()
    in_order = Window.partitionBy("_label", "_bin").orderBy("_hash", "_key")
    upto = F.sum("count").over(in_order)
    running = entries.withColumns({"_upto": upto, "_before": upto - F.col("count")})

    def reaches(k: object, position: str, rank: int) -> Column:
        here = (F.col("_label") == F.lit(k)) & (F.col("_bin") == F.lit(position))
        return here & (F.col("_before") < F.lit(rank)) & (F.col("_upto") >= F.lit(rank))

    hits = any_of(reaches(k, position, rank) for (k, _), (position, rank) in open_cuts.items())
    cuts = [
        Cut(k, boundary, row["_hash"], row["_key"])
        for row in running.filter(hits).collect()
        for (k, boundary), (position, rank) in open_cuts.items()
        if (row["_label"], row["_bin"]) == (k, position) and row["_before"] < rank <= row["_upto"]
    ]
    return SplitCuts(tuple(keys), label, seed, tuple(cuts))


def split_exact(df: DataFrame, keys: Sequence[str], label: str, **options: object) -> DataFrame:
    """Exact stratified split: fit the cuts, then assign."""
    return fit_split(df, keys, label, **options).assign(df)


def split_hash(
    df: DataFrame,
    keys: Sequence[str],
    holdout: float = HOLDOUT,
    test_within_holdout: float = TEST_WITHIN_HOLDOUT,
    seed: int = SEED,
) -> DataFrame:
    """Approximate split by hash range: no pass over the data, stable as rows are appended."""
    digits = 12
    span = 16**digits
    train = int((1.0 - holdout) * span)
    validation = train + int(holdout * (1.0 - test_within_holdout) * span)
    place = row_hash(key_text(keys), seed)
    split = (
        F.when(F.col("_hash") < F.lit(f"{train:0{digits}x}"), TRAIN)
        .when(F.col("_hash") < F.lit(f"{validation:0{digits}x}"), VALIDATION)
        .otherwise(INTERNAL_TEST)
    )
    return df.withColumn("_hash", place).withColumn("split", split).drop("_hash")


def split_sizes(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy("split", *by).agg(F.count(F.lit(1)).alias("row_count"))
