"""Feature statistics of two datasets and how they differ.

All statistics of all features come from one aggregate per dataset, with partial aggregation on
the map side; only afterwards are they turned into one row per feature. Rows are never exploded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import ratio

STATISTICS = ("row_count", "mean", "std", "correlation")
TOP = 10


def _statistics(feature: str, label: str) -> dict[str, Column]:
    """Mean, sample deviation and Pearson correlation with the label; NULL features are left out,
    the label is not NULL.

    The correlation is put together from its parts, because the built-in one raises a division
    error on a constant column in ANSI mode; here a constant column gives NULL. The label's part
    comes from plain sums, which are exact for 0 and 1.
    """
    x, y = F.col(feature), F.col(label)
    paired = F.when(x.isNotNull(), y)
    n, total, squares = F.count(x), F.sum(paired), F.sum(paired * paired)
    spread = F.sqrt(F.greatest(ratio(squares - total * ratio(total, n), n - 1), F.lit(0.0)))
    return {
        "row_count": n,
        "mean": F.avg(x).cast("double"),
        "std": F.stddev_samp(x),
        "correlation": ratio(F.covar_samp(x, y), F.stddev_samp(x) * spread),
    }


def feature_profile(
    df: DataFrame, features: Sequence[str], label: str, by: Sequence[str] = ()
) -> DataFrame:
    """One row per group and feature: row_count, mean, std, correlation with the label."""
    wide = df.groupBy(*by).agg(
        *[
            column.alias(f"{name}_{i}")
            for i, feature in enumerate(features)
            for name, column in _statistics(feature, label).items()
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(feature).alias("feature"),
                *[F.col(f"{name}_{i}").alias(name) for name in STATISTICS],
            )
            for i, feature in enumerate(features)
        ]
    )
    return wide.select(*by, F.inline(rows))


def report_numbers(label: str) -> list[str]:
    """The columns of a report after the feature."""
    return [
        "train_mean",
        "test_mean",
        "standardized_mean_shift",
        f"train_correlation_with_{label}",
        f"test_correlation_with_{label}",
        "correlation_change",
        "absolute_correlation_change",
    ]


def report_columns(
    aligned: DataFrame, label: str, by: Sequence[str | Column] = ()
) -> DataFrame:
    """Report columns from ``train_*`` and ``test_*`` statistics side by side."""
    std = F.nullif(F.col("train_std"), F.lit(0.0))
    change = F.col("test_correlation") - F.col("train_correlation")
    return aligned.select(
        *by,
        "feature",
        "train_mean",
        "test_mean",
        ratio(F.col("test_mean") - F.col("train_mean"), std).alias("standardized_mean_shift"),
        F.col("train_correlation").alias(f"train_correlation_with_{label}"),
        F.col("test_correlation").alias(f"test_correlation_with_{label}"),
        change.alias("correlation_change"),
        F.abs(change).alias("absolute_correlation_change"),
    )


def align_profiles(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Shift report of two stored profiles: full outer on the feature name, so a feature known
    to one side only is reported with NULLs. One row per feature on either side."""
    sides = [
        profile.select("feature", *[F.col(c).alias(f"{side}_{c}") for c in STATISTICS])
        for side, profile in (("train", train), ("test", test))
    ]
    return report_columns(sides[0].join(sides[1], "feature", "full_outer"), label)


def shift_report(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    dataset: str = "dataset",
    train: str = "train",
    test: str = "external",
) -> DataFrame:
    """Shift report of one table tagged by dataset: a single scan, no join."""
    pair = df.filter(F.col(dataset).isin(train, test))
    profile = feature_profile(pair, features, label, [dataset])
    picked = {
        f"{side}_{c}": F.max(F.when(F.col(dataset) == value, F.col(c)))
        for side, value in (("train", train), ("test", test))
        for c in STATISTICS
    }
    aligned = profile.groupBy("feature").agg(*[c.alias(k) for k, c in picked.items()])
    return report_columns(aligned, label)


def largest_changes(report: DataFrame, label: str, n: int = TOP) -> DataFrame:
    """The features whose relation to the label changed most. Changes are compared to 12 digits
    and then by name: complementary one-hot columns differ by rounding noise only."""
    return (
        report.orderBy(
            F.round("absolute_correlation_change", 12).desc_nulls_last(), F.col("feature")
        )
        .limit(n)
        .select(
            "feature",
            f"train_correlation_with_{label}",
            f"test_correlation_with_{label}",
            "correlation_change",
        )
    )


def drift_detected(report: DataFrame, tolerance: float) -> DataFrame:
    """One row: the largest absolute correlation change and whether it exceeds the tolerance."""
    largest = F.max("absolute_correlation_change")
    return report.agg(
        largest.alias("largest_change"),
        F.coalesce(largest > F.lit(tolerance), F.lit(False)).alias("detected"),
    )
