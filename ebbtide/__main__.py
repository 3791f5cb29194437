"""Command line: one sub-command per stage, on the session Spark is configured with.

    python -m ebbtide clean    --input raw.csv --output clean/
    python -m ebbtide features --input clean/  --output features/
    python -m ebbtide train    --known features_a/ --external features_b/ --output run/
    python -m ebbtide diagnose --known features_a/ --external features_b/ --model run/model --output report/
    python -m ebbtide record   --run run/ --report report/ --run-id r1 --tables tables/
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.profile import displayed
from ebbtide.operators.train import TrainConfig
from ebbtide.plans.diagnosis import run_diagnosis
from ebbtide.plans.ingest import run_clean, run_features
from ebbtide.plans.tracking import run_record
from ebbtide.plans.training import run_training
from ebbtide.spec import CHURN


def show(df: DataFrame, rows: int = 20) -> None:
    """Print with doubles to 4 decimals."""
    displayed(df).show(rows, truncate=False)


def clean(spark: SparkSession, a: argparse.Namespace) -> None:
    report = run_clean(spark, a.input, a.output, CHURN)
    print(f"raw rows {report.raw_rows}, cleaned {report.cleaned_rows}, removed {report.removed_rows}")
    show(report.sample)
    show(report.label_frequency)
    show(report.category_frequency["subscription_type"])
    print(f"verified rows {report.verified_rows}")


def features(spark: SparkSession, a: argparse.Namespace) -> None:
    report = run_features(spark, a.input, a.output, CHURN, files=a.files)
    print(f"input rows {report.input_rows}, feature rows {report.feature_rows}")
    print(f"NULL rows per column: {report.null_rows}")
    show(report.sample)
    print(f"verified rows {report.verified_rows}")


def train(spark: SparkSession, a: argparse.Namespace) -> None:
    config = TrainConfig(
        epochs=a.epochs,
        learning_rate=a.learning_rate,
        batch_size=a.batch_size,
        groups=a.groups,
        patience=a.patience,
        tune_threshold=a.tune_threshold,
    )
    log = a.restartable or a.patience is not None
    outcome = run_training(spark, a.known, a.external, a.output, CHURN, config, log)
    show(outcome.sizes)
    show(outcome.history.orderBy("epoch"))
    print(f"best epoch {outcome.model.best_epoch}")
    show(outcome.evaluation)


def diagnose(spark: SparkSession, a: argparse.Namespace) -> None:
    diagnosis = run_diagnosis(spark, a.known, a.external, a.model, a.output, CHURN)
    show(diagnosis.label_rates)
    show(diagnosis.largest_changes)
    show(diagnosis.external)


def record(spark: SparkSession, a: argparse.Namespace) -> None:
    report = None
    if a.report:
        report = spark.read.option("header", True).csv(a.report)
        report = report.withColumn(
            "absolute_correlation_change", F.col("absolute_correlation_change").cast("double")
        )
    run_record(spark, a.run_id, a.run, a.tables, report)


def main() -> None:
    parser = argparse.ArgumentParser(prog="ebbtide")
    stages = parser.add_subparsers(required=True)

    def stage(run, *required: str) -> argparse.ArgumentParser:
        sub = stages.add_parser(run.__name__)
        sub.set_defaults(stage=run)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        return sub

    defaults = TrainConfig()
    stage(clean, "input", "output")
    stage(features, "input", "output").add_argument("--files", type=int)
    training = stage(train, "known", "external", "output")
    training.add_argument("--epochs", type=int, default=defaults.epochs)
    training.add_argument("--learning-rate", type=float, default=defaults.learning_rate)
    training.add_argument("--batch-size", type=int, default=defaults.batch_size)
    training.add_argument("--groups", type=int, default=defaults.groups)
    training.add_argument("--patience", type=int)
    training.add_argument("--restartable", action="store_true")
    training.add_argument("--tune-threshold", action="store_true")
    stage(diagnose, "known", "external", "model", "output")
    tracking = stage(record, "run", "run-id", "tables")
    tracking.add_argument("--report")
    arguments = parser.parse_args()
    arguments.stage(SparkSession.builder.appName("ebbtide").getOrCreate(), arguments)


if __name__ == "__main__":
    main()
