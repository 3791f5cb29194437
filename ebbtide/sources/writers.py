"""Sinks: Parquet, CSV reports, the metrics document, append-only run tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    files: int | None = None,
    rows_per_file: int | None = None,
    partition_by: Sequence[str] = (),
) -> str:
    """Parquet sink.

    ``files`` limits the number of part files by merging partitions, which also limits the tasks
    of the last stage: for small outputs only. ``rows_per_file`` splits large files instead and
    keeps the parallelism.
    """
    if files is not None:
        df = df.coalesce(files)
    writer = df.write.mode(mode)
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def verify_rows(df: DataFrame, path: str, expected: int) -> int:
    """Count what was written (from the Parquet footers) and fail on a difference."""
    written = df.sparkSession.read.parquet(path).count()
    if written != expected:
        raise RuntimeError(f"{path}: {written} rows read back, {expected} written")
    return written


def write_report_csv(report: DataFrame, path: str, first: str = "feature") -> str:
    """A report of a few rows (one per feature) as one CSV file, ``first`` leading."""
    rest = [c for c in report.columns if c != first]
    report.select(first, *rest).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """Add rows to a partitioned table; partitions that ``df`` has rows for are replaced as a whole."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)
    return path


def replace_run(df: DataFrame, path: str) -> str:
    """Add the rows of a run to a run table; rows that the same run has there are replaced."""
    return replace_partitions(df, path, ["run_id"])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """A run table; run ids stay texts, also those that look like numbers."""
    stored = spark.read.option("inferSchema", False).parquet(path)
    fields = [f for f in stored.schema.fields if f.name != "run_id"]
    schema = T.StructType([T.StructField("run_id", T.StringType()), *fields])
    return spark.read.schema(schema).parquet(path).select(schema.names)
