"""Counts, frequency tables, NULL audit, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.columns import missing


def frequency(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value, ordered by value. Values are pre-counted before the exchange."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).orderBy(*columns)


def null_counts(columns: Sequence[str]) -> list[Column]:
    """One counting aggregate per column; 0 rather than NULL over no rows."""
    return [F.coalesce(F.sum(missing(F.col(c))), F.lit(0)).alias(c) for c in columns]


def null_audit(df: DataFrame) -> DataFrame:
    """NULLs per column: one pass, then one row per column."""
    wide = df.agg(*null_counts(df.columns))
    return wide.unpivot([], list(df.columns), "column_name", "null_rows")


def sample_rows(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by key: the same rows in every run."""
    return df.orderBy(*keys).limit(n)


def row_balance(raw: DataFrame, cleaned: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Raw, cleaned and removed rows, optionally per group."""
    tagged = raw.select(*by, F.lit(1).alias("_raw"), F.lit(0).alias("_cleaned")).unionByName(
        cleaned.select(*by, F.lit(0).alias("_raw"), F.lit(1).alias("_cleaned"))
    )
    raw_rows = F.coalesce(F.sum("_raw"), F.lit(0))
    cleaned_rows = F.coalesce(F.sum("_cleaned"), F.lit(0))
    return tagged.groupBy(*by).agg(
        raw_rows.alias("raw_rows"),
        cleaned_rows.alias("cleaned_rows"),
        (raw_rows - cleaned_rows).alias("removed_rows"),
    )


def positive_rate(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of ones in a 0/1 column."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"), F.avg(F.col(column).cast("double")).alias("rate")
    )


def displayed(df: DataFrame, digits: int = 4) -> DataFrame:
    """For reading only: all doubles rounded."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in doubles})
