"""Feature profiles that can be merged: moments per period, kept in a store.

A row holds, for one period and feature, the number and range of values, the means of feature and label
and their centred second and cross moments. Rows of any periods merge by Chan's formulas into the moments of all
their rows together, so the profile of a range of days needs none of its rows again. Values are taken
relative to an ``origin`` per feature, which is stored with them: a mean of 1e9 with a spread of 1 keeps
its digits, and rows with different origins still merge.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.functions.columns import ratio
from ebbtide.sources.writers import replace_partitions

#: Columns of a moment row beside its period; means are relative to the origin, of the label to 0.
MOMENTS = (
    "origin",
    "row_count",
    "x_min",
    "x_max",
    "x_mean",
    "x_moment",
    "y_mean",
    "y_moment",
    "xy_moment",
)


def origins(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """A number near the values of each feature, of few digits so that differences to it are exact: its
    mean in single precision, 0 where there are no values. For the start of a store; one aggregate."""
    near = df.agg(*[F.avg(c).cast("float").cast("double").alias(f"o{i}") for i, c in enumerate(features)])
    row = near.first()
    return {c: row[i] or 0.0 for i, c in enumerate(features)}


def _moments_of(feature: str, label: str, origin: float) -> dict[str, Column]:
    x = F.col(feature).cast("double") - F.lit(origin)
    y = F.when(x.isNotNull(), F.col(label).cast("double"))
    n = F.count(x)
    return {
        "row_count": n,
        "x_min": F.min(F.col(feature).cast("double")),
        "x_max": F.max(F.col(feature).cast("double")),
        "x_mean": F.avg(x),
        "x_moment": F.var_pop(x) * n,
        "y_mean": F.avg(y),
        "y_moment": F.var_pop(y) * n,
        "xy_moment": F.covar_pop(x, y) * n,
    }


def moment_aggregates(
    features: Sequence[str], label: str, origin: Mapping[str, float]
) -> list[Column]:
    """All moments of all features for one aggregate with partial aggregation."""
    return [
        column.alias(f"{name}_{i}")
        for i, feature in enumerate(features)
        for name, column in _moments_of(feature, label, origin.get(feature, 0.0)).items()
    ]


def moment_rows(features: Sequence[str], origin: Mapping[str, float]) -> Column:
    """The aggregates of ``moment_aggregates`` as one row per feature."""
    rows = [
        F.struct(
            F.lit(feature).alias("feature"),
            F.lit(float(origin.get(feature, 0.0))).alias("origin"),
            *[F.col(f"{name}_{i}").alias(name) for name in MOMENTS[1:]],
        )
        for i, feature in enumerate(features)
    ]
    return F.inline(F.array(*rows))


def feature_moments(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    by: Sequence[str] = (),
    origin: Mapping[str, float] | None = None,
) -> DataFrame:
    """One row per group and feature: the columns of ``MOMENTS``. One scan, rows are not exploded.

    NULL values of a feature are left out, with their labels. A group whose feature has no value has a
    ``row_count`` of 0 and NULL means and moments, and does not count when merged.
    """
    origin = origin or {}
    wide = df.groupBy(*by).agg(*moment_aggregates(features, label, origin))
    return wide.select(*by, moment_rows(features, origin))


def merge_moments(store: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The moments of all rows of each group of ``by`` and feature together.

    With n, m and M of each part: mean = sum(n m) / sum(n), moment = sum(M) + sum(n (m - mean)^2), and
    the like for the cross moment. Parts are brought to the least origin of their group first. A constant,
    whose parts' means may differ by rounding, is known by its range. One exchange, of rows that are as
    many as periods and features.
    """
    key = [*by, "feature"]
    group = Window.partitionBy(*key)
    base = F.min("origin").over(group)
    n = F.col("row_count")
    moved = store.withColumn("_base", base).withColumn(
        "x_mean", F.col("x_mean") + (F.col("origin") - F.col("_base"))
    )
    total = F.sum(n).over(group)
    centred = moved.withColumns(
        {f"_{c}": ratio(F.sum(n * F.col(c)).over(group), total) for c in ("x_mean", "y_mean")}
    )
    dx, dy = F.col("x_mean") - F.col("_x_mean"), F.col("y_mean") - F.col("_y_mean")
    spread = F.when(F.min("x_min") < F.max("x_max"), F.sum(F.col("x_moment") + n * dx * dx))
    return centred.groupBy(*key).agg(
        F.first("_base").alias("origin"),
        F.sum("row_count").alias("row_count"),
        F.min("x_min").alias("x_min"),
        F.max("x_max").alias("x_max"),
        F.first("_x_mean").alias("x_mean"),
        F.coalesce(spread, F.when(F.sum("row_count") > 0, F.lit(0.0))).alias("x_moment"),
        F.first("_y_mean").alias("y_mean"),
        F.sum(F.col("y_moment") + n * dy * dy).alias("y_moment"),
        F.sum(F.col("xy_moment") + n * dx * dy).alias("xy_moment"),
    )


def profile_of(moments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Moment rows as a profile: row_count, mean, sample deviation, correlation with the label. What is
    constant has no correlation, and a single value no deviation: NULL."""
    n = F.col("row_count")
    spread = F.sqrt(F.col("x_moment")) * F.sqrt(F.col("y_moment"))
    return moments.select(
        *by,
        "feature",
        "row_count",
        (F.col("origin") + F.col("x_mean")).alias("mean"),
        F.sqrt(ratio(F.col("x_moment"), n - 1)).alias("std"),
        ratio(F.col("xy_moment"), spread).alias("correlation"),
    )


def write_moments(moments: DataFrame, path: str, period: str) -> str:
    """Add rows to a store; periods that are there already are replaced, others stay."""
    return replace_partitions(moments.repartition(period), path, [period])


def read_moments(spark: SparkSession, path: str, period: str) -> DataFrame:
    """A store, the period as text; a filter on it reads only the periods it names."""
    means = ", ".join(f"{c} {'bigint' if c == 'row_count' else 'double'}" for c in MOMENTS)
    return spark.read.schema(f"feature string, {means}, {period} string").parquet(path)
