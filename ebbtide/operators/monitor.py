"""Drift of new batches against a stored profile, each batch once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.drift import STATISTICS, report_columns, report_numbers
from ebbtide.operators.moments import feature_moments, profile_of, read_moments, write_moments
from ebbtide.sources.writers import replace_partitions


@dataclass(frozen=True)
class Tolerance:
    """What a feature may move before it is flagged: its mean, in deviations of the reference, and its
    correlation with the label."""

    mean_shift: float = 0.1
    correlation: float = 0.1


def flagged(report: DataFrame, tolerance: Tolerance) -> DataFrame:
    """The report with ``drifted``; a change that is NULL (a constant, no values) is none."""
    moved = F.abs("standardized_mean_shift") > F.lit(tolerance.mean_shift)
    related = F.col("absolute_correlation_change") > F.lit(tolerance.correlation)
    return report.withColumn(
        "drifted", F.coalesce(moved, F.lit(False)) | F.coalesce(related, F.lit(False))
    )


def drift_rows(
    profiles: DataFrame, reference: DataFrame, label: str, by: Sequence[str], tolerance: Tolerance
) -> DataFrame:
    """One flagged report row per group of ``by`` and feature: the group's profile beside the reference.
    A feature that the reference does not know is reported with NULLs and not flagged. The reference is
    one row per feature, whatever the size of the data."""
    known = reference.select("feature", *[F.col(c).alias(f"train_{c}") for c in STATISTICS])
    own = profiles.select(*by, "feature", *[F.col(c).alias(f"test_{c}") for c in STATISTICS])
    aligned = own.join(known, "feature", "left")
    counted = report_columns(aligned, label, [*by, F.col("test_row_count").alias("row_count")])
    return flagged(counted, tolerance)


def recorded_batches(spark: SparkSession, path: str, batch: str) -> list[str]:
    """Names of the batches in a table that is partitioned by batch; none where it does not exist."""
    try:
        stored = spark.read.schema(f"{batch} string").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(r[0] for r in stored.distinct().collect())


def monitor_batches(
    rows: DataFrame,
    batch: str,
    features: Sequence[str],
    label: str,
    reference: DataFrame,
    target: str,
    tolerance: Tolerance | None = None,
    origin: Mapping[str, float] | None = None,
) -> list[str]:
    """Compare each batch of ``rows`` that ``target`` does not have yet with the reference profile, and
    add one flagged row per feature. Returns the names of the batches added.

    ``rows`` is read with a filter on the batches that are missing: if it is stored by batch, no file of
    another is opened. The moments of a batch go to ``target``/moments first and its report to
    ``target``/report last; both replace what a run that broke off has left of the batch, so a batch is
    reported once however often the job runs. Rows without a batch name are left out.
    """
    spark = rows.sparkSession
    done = recorded_batches(spark, f"{target}/report", batch)
    name = F.col(batch).cast("string")
    new = rows.withColumn(batch, name).filter(name.isNotNull() & ~F.col(batch).isin(done))
    moments = feature_moments(new, features, label, [batch], origin)
    write_moments(moments, f"{target}/moments", batch)
    added = sorted(set(recorded_batches(spark, f"{target}/moments", batch)) - set(done))
    if added:
        stored = read_moments(spark, f"{target}/moments", batch).filter(F.col(batch).isin(added))
        profiles = profile_of(stored, [batch])
        report = drift_rows(profiles, reference, label, [batch], tolerance or Tolerance())
        replace_partitions(report.repartition(batch), f"{target}/report", [batch])
    return added


def read_monitor(spark: SparkSession, target: str, batch: str, label: str) -> DataFrame:
    """All report rows, the batch as text."""
    schema = f"row_count bigint, feature string, {', '.join(f'{c} double' for c in report_numbers(label))}"
    stored = spark.read.schema(f"{schema}, drifted boolean, {batch} string")
    return stored.parquet(f"{target}/report")
