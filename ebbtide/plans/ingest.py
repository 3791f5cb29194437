"""Stage 1 and 2: CSV -> cleaned Parquet -> feature Parquet. One pass over the input each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.columns import all_of
from ebbtide.operators.clean import clean_counted, valid
from ebbtide.operators.features import build_features
from ebbtide.operators.profile import frequency, null_counts, sample_rows
from ebbtide.sources.readers import read_csv, read_parquet
from ebbtide.sources.writers import verify_rows, write_parquet
from ebbtide.spec import DatasetSpec


@dataclass(frozen=True)
class CleanReport:
    raw_rows: int
    cleaned_rows: int
    removed_rows: int
    verified_rows: int
    label_frequency: DataFrame
    category_frequency: dict[str, DataFrame]
    sample: DataFrame


def run_clean(spark: SparkSession, source: str, target: str, spec: DatasetSpec) -> CleanReport:
    """Clean a CSV into Parquet and report on it.

    Both counts are observed while writing, above the only exchange, in the stage that produces
    the files: no second parse of the CSV, and no double count when a map stage is run again.
    The report tables read the written Parquet, one or two columns each.
    """
    raw, cleaned = Observation(), Observation()
    merged = clean_counted(read_csv(spark, source, spec), spec).observe(
        raw, F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows")
    )
    present = all_of(F.col(k).isNotNull() for k in spec.keys)
    kept = valid(merged.filter(present), spec).drop("_copies")
    write_parquet(kept.observe(cleaned, F.count(F.lit(1)).alias("rows")), target)
    raw_rows, cleaned_rows = raw.get["rows"], cleaned.get["rows"]
    stored = read_parquet(spark, target)
    return CleanReport(
        raw_rows,
        cleaned_rows,
        raw_rows - cleaned_rows,
        verify_rows(stored, target, cleaned_rows),
        frequency(stored, spec.label),
        {c: frequency(stored, c) for c in spec.categorical},
        sample_rows(stored, spec.keys),
    )


@dataclass(frozen=True)
class FeatureReport:
    input_rows: int
    feature_rows: int
    feature_columns: int
    verified_rows: int
    null_rows: dict[str, int]
    sample: DataFrame


def run_features(
    spark: SparkSession,
    source: str,
    target: str,
    spec: DatasetSpec,
    files: int | None = None,
    rows_per_file: int | None = None,
    rebalance: bool = False,
) -> FeatureReport:
    """Cleaned Parquet to feature Parquet: scan, projection and write in one stage, with the row
    count and the NULL audit observed on the way. ``rebalance`` lets Spark even out the file
    sizes, at the price of an exchange; the audit then happens after it."""
    rows = read_parquet(spark, source)
    features = build_features(rows, spec)
    if rebalance:
        features = features.hint("rebalance")
    audit = Observation()
    count = F.count(F.lit(1)).alias("_rows")
    observed = features.observe(audit, count, *null_counts(features.columns))
    write_parquet(observed, target, files=files, rows_per_file=rows_per_file)
    seen = dict(audit.get)
    n = seen.pop("_rows")
    stored = read_parquet(spark, target)
    return FeatureReport(
        rows.count(),
        n,
        len(features.columns),
        verify_rows(stored, target, n),
        seen,
        sample_rows(stored, spec.keys),
    )
