"""Raw table -> cleaned table: rename, trim, complete rows, fill, one row per key, valid rows.

The order is part of the meaning. Trimming comes before filling, so a blank string stays empty.
Filling comes before de-duplication, and validity after it, so a key whose surviving copy is
invalid disappears even when another copy was valid (``validate_first=True`` reverses that).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.columns import all_of, filled
from ebbtide.spec import DatasetSpec


def conform(df: DataFrame, spec: DatasetSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Clean names, in order, with the categorical strings trimmed; ``keep`` passes through."""
    pairs = spec.rename.items() if spec.rename else [(c, c) for c in spec.columns]
    columns = [
        (F.trim(F.col(f"`{raw}`")) if name in spec.categorical else F.col(f"`{raw}`")).alias(name)
        for raw, name in pairs
    ]
    return df.select(*columns, *keep)


def complete(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows with a key and a label; written as IS NOT NULL so that it reaches the scan."""
    return df.filter(all_of(F.col(c).isNotNull() for c in (*spec.keys, spec.label)))


def fill(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    return df.select(
        *[
            filled(F.col(f.name), f.dataType, spec.fills[f.name]).alias(f.name)
            if f.name in spec.fills
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    prefer: Sequence[str] = (),
    copies: str | None = None,
) -> DataFrame:
    """One row per key: the greatest one by ``prefer``, then by every other column in order.

    The order is total over the columns, so the survivor does not depend on the partitioning.
    Spark turns ``row_number() = 1`` into a per-key limit on both sides of the exchange, so a key
    that holds a large share of the rows leaves each map task as one row. With ``copies`` the
    number of merged rows is carried along, in a max/count aggregate with the same survivor.
    """
    rest = [c for c in df.columns if c not in keys and c not in prefer]
    order = [*prefer, *rest]
    if copies is not None:
        best = F.max(F.struct(*order)).alias("_best")
        merged = df.groupBy(*keys).agg(best, F.count(F.lit(1)).alias(copies))
        survivors = [F.col(f"_best.{c}").alias(c) if c in order else F.col(c) for c in df.columns]
        return merged.select(*survivors, copies)
    place = F.row_number().over(
        Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    )
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def valid(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Binary label and no negative numeric value."""
    binary = F.col(spec.label).isin(0, 1)
    return df.filter(all_of([binary, *[F.col(c) >= 0 for c in spec.numeric]]))


def clean(
    df: DataFrame,
    spec: DatasetSpec,
    keep: Sequence[str] = (),
    validate_first: bool = False,
) -> DataFrame:
    rows = fill(complete(conform(df, spec, keep), spec), spec)
    if validate_first:
        return dedupe(valid(rows, spec), spec.keys)
    return valid(dedupe(rows, spec.keys), spec)


def clean_counted(df: DataFrame, spec: DatasetSpec, copies: str = "_copies") -> DataFrame:
    """The rows before validation with the number of raw rows behind each.

    Incomplete rows share the NULL key, so that ``sum(copies)`` is the raw row count. It is taken
    after the exchange and stays exact when a map stage runs again.
    """
    rows = fill(conform(df, spec), spec)
    is_complete = all_of(F.col(c).isNotNull() for c in (*spec.keys, spec.label))
    for key in spec.keys:
        rows = rows.withColumn(key, F.when(is_complete, F.col(key)))
    return dedupe(rows, spec.keys, copies=copies)
