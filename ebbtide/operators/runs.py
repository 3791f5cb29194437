"""Run records as long tables: metrics, parameters, tags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.metrics import METRICS


def metrics_long(evaluation: DataFrame, run_id: str) -> DataFrame:
    """Wide evaluation (one row per split) -> ``(run_id, split, metric, value)``."""
    values = evaluation.select(F.lit(run_id).alias("run_id"), "split", *METRICS)
    return values.unpivot(["run_id", "split"], list(METRICS), "metric", "value")


def metrics_flat(long: DataFrame) -> DataFrame:
    """``(run_id, key, value)`` with the key ``<split>_<metric>``."""
    return long.select("run_id", F.concat_ws("_", "split", "metric").alias("key"), "value")


def sizes_flat(sizes: DataFrame, run_id: str) -> DataFrame:
    """Split sizes as parameters: key ``<split>_rows``."""
    return sizes.select(
        F.lit(run_id).alias("run_id"),
        F.concat(F.col("split"), F.lit("_rows")).alias("key"),
        F.col("row_count").cast("string").alias("value"),
    )


def run_table(spark: SparkSession, run_id: str, values: Mapping[str, object]) -> DataFrame:
    """Key/value rows of one run, values as text."""
    rows = [(run_id, k, str(v).lower() if isinstance(v, bool) else str(v)) for k, v in values.items()]
    return spark.createDataFrame(rows, "run_id string, key string, value string")


def run_params(
    spark: SparkSession, sizes: DataFrame, run_id: str, parameters: Mapping[str, object]
) -> DataFrame:
    return run_table(spark, run_id, parameters).unionByName(sizes_flat(sizes, run_id))


def run_tags(drift: DataFrame, run_id: str, fixed: Mapping[str, str]) -> DataFrame:
    """Fixed tags plus the drift flag of the shift report."""
    pairs = [
        F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in fixed.items()
    ]
    flag = F.struct(
        F.lit("distribution_shift_detected").alias("key"),
        F.col("detected").cast("string").alias("value"),
    )
    return drift.select(F.lit(run_id).alias("run_id"), F.inline(F.array(*pairs, flag)))
