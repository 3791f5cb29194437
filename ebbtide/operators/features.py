"""Cleaned table -> numeric feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.columns import one_hot
from ebbtide.spec import DatasetSpec


def build_features(df: DataFrame, spec: DatasetSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Integral keys as long, numerics and label as double, one column per vocabulary value.

    A narrow projection. A value outside the vocabulary, or NULL, gives zeros in its group.
    """
    integral = {f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)}
    return df.select(
        *[F.col(k).cast("long").alias(k) if k in integral else F.col(k) for k in spec.keys],
        *[F.col(c).cast("double").alias(c) for c in spec.numeric],
        *[
            one_hot(F.col(column), value).alias(feature)
            for column, vocabulary in spec.categorical.items()
            for value, feature in vocabulary.items()
        ],
        F.col(spec.label).cast("double").alias(spec.label),
        *keep,
    )


def narrow(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Features and label as 4-byte floats."""
    return df.withColumns({c: F.col(c).cast("float") for c in (*spec.features, spec.label)})
