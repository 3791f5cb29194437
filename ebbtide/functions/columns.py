"""Scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def all_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def any_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates, F.lit(False))


def filled(column: Column, dtype: T.DataType, value: object) -> Column:
    """Replace NULL by a typed value; in floating columns NaN counts as missing too."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        column = F.nanvl(column, F.lit(None).cast(dtype))
    return F.coalesce(column, F.lit(value).cast(dtype))


def one_hot(column: Column, value: str) -> Column:
    """1.0 when the column equals ``value`` ignoring case, else 0.0 (also for NULL)."""
    return F.coalesce((F.lower(column) == F.lit(value)).cast("double"), F.lit(0.0))


def missing(column: Column) -> Column:
    return column.isNull().cast("int")


def nonzero_scale(scale: Column) -> Column:
    """A constant feature has scale 0; divide it by 1 instead."""
    return F.when(scale == 0, F.lit(1.0)).otherwise(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL on a zero denominator, in ANSI mode as well."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def sigmoid(logit: Column) -> Column:
    """Logistic function, split by sign so that ``exp`` never overflows."""
    decay = F.exp(-F.abs(logit))
    return F.when(logit >= 0, 1.0 / (1.0 + decay)).otherwise(decay / (1.0 + decay))


def decision(probability: Column, threshold: float = 0.5) -> Column:
    """0/1 prediction; a probability on the threshold is positive."""
    return (probability >= F.lit(float(threshold))).cast("int")


def cross_entropy(logit: Column, label: Column) -> Column:
    """Binary cross-entropy of one row, from the logit."""
    return F.greatest(logit, F.lit(0.0)) - logit * label + F.log1p(F.exp(-F.abs(logit)))


def key_text(keys: Iterable[str]) -> Column:
    """One string per key, different for different keys: the parts joined with ':', a ':' or backslash
    inside a part escaped, NULL marked. Numbers keep their plain text."""

    def part(name: str) -> Column:
        text = F.col(name).cast("string")
        escaped = F.replace(
            F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:")
        )
        return F.coalesce(escaped, F.lit("\\N"))

    return F.concat_ws(":", *[part(k) for k in keys])


def row_hash(text: Column, seed: int) -> Column:
    """Seeded MD5 as 32 hex digits. Its text order is its numeric order, and its prefixes are
    bins of equal width, so it is never turned into a number."""
    return F.md5(F.concat(F.lit(f"{seed}:"), text).cast("binary"))


def upper_bound_index(value: Column, bounds: Column, n: int) -> list[tuple[str, Column]]:
    """Binary search of ``value`` in a sorted array of ``n - 1`` bounds; ``n`` is a power of two.

    Returns the named steps to add one after the other; the last one is the number of bounds
    smaller than ``value``. Kept as separate steps so that no expression is repeated.
    """
    steps: list[tuple[str, Column]] = []
    position: Column = F.lit(0)
    width = n // 2
    while width:
        hop = F.when(value > F.get(bounds, position + (width - 1)), width).otherwise(0)
        name = f"_at_{width}"
        steps.append((name, position + hop))
        position = F.col(name)
        width //= 2
    return steps
