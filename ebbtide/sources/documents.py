"""The metrics document: one JSON record with the evaluations, parameters and sizes of a run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.metrics import METRICS
from ebbtide.operators.split import EXTERNAL_TEST, INTERNAL_TEST, TRAIN, VALIDATION

EVALUATED = (VALIDATION, INTERNAL_TEST, EXTERNAL_TEST)

# Layout of the metrics document.
_METRIC_FIELDS = ", ".join(f"{m}: double" for m in METRICS)
DOCUMENT_SCHEMA = (
    "best_epoch int, "
    + ", ".join(f"{split} struct<{_METRIC_FIELDS}>" for split in EVALUATED)
    + ", parameters struct<batch_size: int, epochs: int, learning_rate: double, "
    "prediction_threshold: double, input_features: int, random_seed: int>"
    + ", dataset_sizes struct<"
    + ", ".join(f"{split}: bigint" for split in (TRAIN, *EVALUATED))
    + ">"
)


def metrics_document(
    spark: SparkSession,
    evaluation: DataFrame,
    sizes: DataFrame,
    parameters: Mapping[str, object],
    best_epoch: int,
) -> DataFrame:
    """One nested row from the evaluation (one row per split) and the split sizes."""
    metrics = {r["split"]: {m: r[m] for m in METRICS} for r in evaluation.collect()}
    counts = {r["split"]: r["row_count"] for r in sizes.collect()}
    record = {
        "best_epoch": best_epoch,
        **{split: metrics.get(split) for split in EVALUATED},
        "parameters": dict(parameters),
        "dataset_sizes": {split: counts.get(split, 0) for split in (TRAIN, *EVALUATED)},
    }
    return spark.createDataFrame([record], DOCUMENT_SCHEMA)


def write_document(document: DataFrame, path: str) -> str:
    document.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOCUMENT_SCHEMA).json(path)


def document_metrics(document: DataFrame) -> DataFrame:
    """``(split, metrics...)`` rows back from a document."""
    rows = F.array(
        *[F.struct(F.lit(s).alias("split"), *[F.col(f"{s}.{m}") for m in METRICS]) for s in EVALUATED]
    )
    return document.select(F.inline(rows))


def document_sizes(document: DataFrame) -> DataFrame:
    rows = F.array(
        *[
            F.struct(F.lit(s).alias("split"), F.col(f"dataset_sizes.{s}").alias("row_count"))
            for s in (TRAIN, *EVALUATED)
        ]
    )
    return document.select(F.inline(rows))


def document_parameters(document: DataFrame) -> dict[str, object]:
    row = document.select("parameters", "best_epoch").first()
    return {**row["parameters"].asDict(), "best_epoch": row["best_epoch"]}
