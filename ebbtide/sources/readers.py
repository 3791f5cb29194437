"""Scans: CSV with a fixed schema, Parquet, and the contract-checked feature load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.spec import DatasetSpec


def read_csv(spark: SparkSession, path: str, spec: DatasetSpec) -> DataFrame:
    """CSV with a header row, bound to ``spec.raw_schema``.

    Malformed fields become NULL and short rows are padded. A header that differs from the
    schema fails the read: by default Spark would bind the columns by position.
    """
    return (
        spark.read.schema(spec.raw_schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", False)
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns absent from the dataset: {absent}")


def require_no_nulls(df: DataFrame, columns: Sequence[str]) -> None:
    """One aggregate over the listed columns; raises when any of them holds a NULL, or a NaN where
    the column is floating."""
    kinds = dict(df.dtypes)

    def absent(name: str) -> Column:
        gone = F.col(name).isNull()
        return gone | F.isnan(name) if kinds[name] in ("double", "float") else gone

    counts = df.agg(*[F.count_if(absent(c)).alias(c) for c in columns])
    nulls = {c: n for c, n in counts.first().asDict().items() if n}
    if nulls:
        raise ValueError(f"NULL or NaN values in: {nulls}")


def load_features(
    spark: SparkSession,
    path: str,
    spec: DatasetSpec,
    features: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Feature table reduced to key, features and label, after the column and NULL contract.

    ``features`` defaults to the spec; pass the list stored with a model to score with it.
    """
    required = [*(features if features is not None else spec.features), spec.label]
    df = spark.read.parquet(path)
    require_columns(df, [*spec.keys, *required, *keep])
    df = df.select(*spec.keys, *required, *keep)
    require_no_nulls(df, required)
    return df
