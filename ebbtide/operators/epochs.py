"""Epochs that are evaluated as they end, written down, and taken up again after a lost driver.

A log is a folder with two tables, partitioned by epoch: ``states`` holds what training goes on from,
``epochs`` the metrics of the epoch on the validation rows, AUC and average precision among them. The
metrics are written last and mark an epoch as done; an epoch that broke off is run again and replaces
what it left. Started again on its folder, training reads the last state and goes on with the same
weights as if it had not stopped.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.columns import cross_entropy, decision, sigmoid
from ebbtide.operators.metrics import METRICS, evaluate
from ebbtide.operators.scale import Scaler
from ebbtide.operators.score import Model, epoch_logits_udf, score
from ebbtide.operators.train import Training, TrainConfig, run_epochs, weights_of
from ebbtide.sources.writers import replace_partitions

STATES = "state array<double>, training_loss double, epoch int"
EPOCHS = (
    "row_count bigint, tn bigint, fp bigint, fn bigint, tp bigint, "
    + ", ".join(f"{m} double" for m in METRICS)
    + ", balanced_accuracy double, training_loss double, epoch int"
)
#: What may change between two runs on one folder: it decides when to end, not where training goes.
FREE = ("epochs", "patience", "least_gain", "tune_threshold")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def epoch_table(spark: SparkSession, folder: str) -> DataFrame:
    """One row per epoch that is done: metrics on the validation rows and the training loss."""
    return _read(spark, f"{folder}/epochs", EPOCHS)


def _check_config(spark: SparkSession, folder: str, features: Sequence[str], config: TrainConfig) -> None:
    """Refuse to go on with other parameters than the folder was begun with."""
    fixed = {k: v for k, v in asdict(config).items() if k not in FREE} | {"features": list(features)}
    text = json.dumps(fixed, sort_keys=True)
    known = [r["value"] for r in _read(spark, f"{folder}/config", "value string").collect()]
    if not known:
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").parquet(
            f"{folder}/config"
        )
    elif known != [text]:
        raise ValueError(f"{folder} was begun with other parameters: {known[0]}")


def stopped(f1: Sequence[float], config: TrainConfig) -> bool:
    """Whether the F1 of the last ``patience`` epochs was not above the best before by ``least_gain``."""
    if config.patience is None:
        return False
    best, waited = -np.inf, 0
    for value in f1:
        if value > best + (config.least_gain if best > -np.inf else 0.0):
            best, waited = value, 0
        else:
            waited += 1
    return waited >= config.patience


def train_logged(
    shards: DataFrame,
    validation: DataFrame,
    scaler: Scaler,
    label: str,
    config: TrainConfig,
    folder: str,
) -> Training:
    """Train over the shards of ``shard_rows`` with a log in ``folder``: up to ``config.epochs`` epochs,
    fewer with ``patience``. All epochs of the log count, also those of earlier runs."""
    spark, features = shards.sparkSession, scaler.features
    _check_config(spark, folder, features, config)
    layers = (len(features), *config.hidden, 1)
    f1 = [r["f1"] for r in epoch_table(spark, folder).orderBy("epoch").collect()]
    states = _read(spark, f"{folder}/states", STATES).filter(F.col("epoch") <= len(f1))
    # one state per epoch, each as large as the model
    known = [(np.array(r["state"]), r["training_loss"]) for r in states.orderBy("epoch").collect()]
    if len(known) != len(f1):
        raise RuntimeError(f"{folder}: {len(known)} states of {len(f1)} epochs")
    done = [(weights_of(state), loss) for state, loss in known]

    if not stopped(f1, config):
        last = known[-1][0] if known else None
        for epoch, state, loss in run_epochs(shards, features, config, last, len(known) + 1):
            row = spark.createDataFrame([(state.tolist(), float(loss), epoch)], STATES)
            replace_partitions(row, f"{folder}/states", ["epoch"])
            model = Model(scaler, layers, weights_of(state), config.threshold, epoch)
            report = evaluate(
                score(validation, model, label), label, by=(), threshold=config.threshold
            )
            marked = report.withColumns({"training_loss": F.lit(float(loss)), "epoch": F.lit(epoch)})
            replace_partitions(marked.coalesce(1), f"{folder}/epochs", ["epoch"])
            done.append((weights_of(state), float(loss)))
            now = epoch_table(spark, folder).filter(F.col("epoch") == epoch).first()
            f1.append(now["f1"])
            if stopped(f1, config):
                break
    return Training(layers, tuple(w for w, _ in done), tuple(loss for _, loss in done))


def score_epochs(
    rows: DataFrame,
    snapshots: Sequence[Sequence[float]],
    layers: Sequence[int],
    scaler: Scaler,
    label: str,
    threshold: float = 0.5,
    digits: int | None = None,
) -> DataFrame:
    """``(epoch, label, logit, probability, prediction, loss)``: each row is read and scored once, by all
    snapshots, and then stands once per epoch. ``digits`` rounds the logits."""
    forward = epoch_logits_udf(snapshots, layers)
    scored = scaler.transform(rows).select(F.col(label), forward(*scaler.features).alias("_logits"))
    each = scored.select(
        F.posexplode("_logits").alias("_epoch", "logit"), F.col(label)
    ).withColumn("logit", F.col("logit") if digits is None else F.round("logit", digits))
    return each.select(
        (F.col("_epoch") + 1).alias("epoch"),
        label,
        "logit",
        sigmoid(F.col("logit")).alias("probability"),
        decision(sigmoid(F.col("logit")), threshold).alias("prediction"),
        cross_entropy(F.col("logit"), F.col(label)).alias("loss"),
    )


def epoch_evaluation(
    validation: DataFrame, training: Training, scaler: Scaler, label: str, config: TrainConfig
) -> DataFrame:
    """All metrics of every epoch, the ranking metrics too, from rows that are scored once: counted per
    (epoch, score) before anything is exchanged, and cumulated in score ranges of each epoch."""
    scored = score_epochs(
        validation, training.snapshots, training.layers, scaler, label, config.threshold
    )
    return evaluate(scored, label, ["epoch"], threshold=config.threshold, cut_by_group=True)
