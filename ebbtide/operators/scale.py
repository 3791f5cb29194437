"""Standard scaling with statistics of the training split only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.columns import nonzero_scale

SCALER_SCHEMA = "position int, feature string, mean double, scale double"


def scaler_table(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation per feature: one pass, one row per feature."""
    wide = df.agg(
        *[F.avg(c).cast("double").alias(f"mean_{i}") for i, c in enumerate(features)],
        *[F.stddev_pop(c).alias(f"scale_{i}") for i, c in enumerate(features)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("feature"),
                F.col(f"mean_{i}").alias("mean"),
                nonzero_scale(F.col(f"scale_{i}")).alias("scale"),
            )
            for i, c in enumerate(features)
        ]
    )
    return wide.select(F.inline(rows))


@dataclass(frozen=True)
class Scaler:
    """Stored statistics, one triple per feature; applied as literals in a projection."""

    features: tuple[str, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]

    @staticmethod
    def from_table(table: DataFrame) -> Scaler:
        rows = table.orderBy("position").collect()  # one row per feature
        return Scaler(
            tuple(r["feature"] for r in rows),
            tuple(r["mean"] for r in rows),
            tuple(r["scale"] for r in rows),
        )

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = list(zip(range(len(self.features)), self.features, self.mean, self.scale, strict=True))
        return spark.createDataFrame(rows, SCALER_SCHEMA)

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {
            c: (F.col(c) - F.lit(m)) / F.lit(s if s != 0 else 1.0)
            for c, m, s in zip(self.features, self.mean, self.scale, strict=True)
        }
        return df.withColumns(scaled)


def fit_scaler(df: DataFrame, features: Sequence[str]) -> Scaler:
    return Scaler.from_table(scaler_table(df, features))
