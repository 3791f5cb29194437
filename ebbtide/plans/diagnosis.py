"""Stage 4: training and external feature tables + model -> shift report and external metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.drift import largest_changes, shift_report
from ebbtide.operators.metrics import evaluate
from ebbtide.operators.profile import positive_rate
from ebbtide.operators.score import score
from ebbtide.sources.models import load_model
from ebbtide.sources.readers import load_features
from ebbtide.sources.writers import write_report_csv
from ebbtide.spec import DatasetSpec


@dataclass(frozen=True)
class Diagnosis:
    label_rates: DataFrame
    report: DataFrame
    largest_changes: DataFrame
    external: DataFrame


def run_diagnosis(
    spark: SparkSession,
    known_path: str,
    external_path: str,
    model_path: str,
    target: str,
    spec: DatasetSpec,
) -> Diagnosis:
    """The whole training table against the external one, in the model's feature order.

    ``external`` is one row: the confusion matrix, all metrics, actual and predicted rates. The
    report is written as CSV and read back for what follows, so it is computed once.
    """
    model = load_model(spark, model_path)
    sides = {
        "train": load_features(spark, known_path, spec, model.features),
        "external": load_features(spark, external_path, spec, model.features),
    }
    both = sides["train"].withColumn("dataset", F.lit("train")).unionByName(
        sides["external"].withColumn("dataset", F.lit("external"))
    )
    report = shift_report(both, model.features, spec.label)
    write_report_csv(report, target)
    stored = spark.read.schema(report.schema).option("header", True).csv(target)

    scored = score(sides["external"], model, spec.label)
    total = F.col("row_count")
    external = evaluate(scored, spec.label, by=(), threshold=model.threshold).withColumns(
        {
            "actual_rate": F.try_divide(F.col("tp") + F.col("fn"), total),
            "predicted_rate": F.try_divide(F.col("tp") + F.col("fp"), total),
        }
    )
    return Diagnosis(
        positive_rate(both, spec.label, ["dataset"]),
        stored,
        largest_changes(stored, spec.label),
        external,
    )
