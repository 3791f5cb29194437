"""Stage 5: put one run into the long run tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.drift import drift_detected
from ebbtide.operators.runs import metrics_flat, metrics_long, run_params, run_table, run_tags
from ebbtide.sources.documents import (
    document_metrics,
    document_parameters,
    document_sizes,
    read_document,
)
from ebbtide.sources.models import load_model
from ebbtide.sources.writers import replace_run

# Largest absolute correlation change that does not yet count as a shift.
DRIFT_TOLERANCE = 0.1


def run_record(
    spark: SparkSession,
    run_id: str,
    run_folder: str,
    tables: str,
    report: DataFrame | None = None,
    tolerance: float = DRIFT_TOLERANCE,
    source: str = "csv",
    target_name: str = "customer_churn",
) -> None:
    """Read a training run folder and add to ``tables``/{metrics, params, tags}. Recording a run id
    again replaces its rows."""
    document = read_document(spark, f"{run_folder}/metrics")
    model = load_model(spark, f"{run_folder}/model")
    metrics = metrics_flat(metrics_long(document_metrics(document), run_id))
    parameters = {
        **document_parameters(document),
        "model_architecture": "-".join(str(n) for n in model.layers),
        "optimizer": "Adam",
        "loss_function": "binary_cross_entropy_with_logits",
        "dataset_source": source,
        "feature_pipeline": "spark",
    }
    params = run_params(spark, document_sizes(document), run_id, parameters)
    fixed = {
        "data_processing": "spark",
        "task": "binary_classification",
        "target": target_name,
        "evaluation_design": "validation_internal_external",
    }
    if report is None:
        tags = run_table(spark, run_id, fixed)
    else:
        tags = run_tags(drift_detected(report, tolerance), run_id, fixed)
    replace_run(metrics.withColumn("value", F.col("value").cast("double")).coalesce(1), f"{tables}/metrics")
    replace_run(params.coalesce(1), f"{tables}/params")
    replace_run(tags.coalesce(1), f"{tables}/tags")
