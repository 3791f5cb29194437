"""Stage 3: feature tables -> split, scaler, model, evaluation, run record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.curves import tuned
from ebbtide.operators.epochs import epoch_table, train_logged
from ebbtide.operators.metrics import best_epoch, evaluate
from ebbtide.operators.scale import fit_scaler
from ebbtide.operators.score import Model, score
from ebbtide.operators.split import EXTERNAL_TEST, TRAIN, VALIDATION, SplitCuts, fit_split, split_sizes
from ebbtide.operators.train import (
    TrainConfig,
    epoch_history,
    pick_model,
    shard_rows,
    train,
)
from ebbtide.sources.documents import metrics_document, write_document
from ebbtide.sources.models import save_model
from ebbtide.sources.readers import load_features
from ebbtide.sources.scratch import remove_path, scratch_path
from ebbtide.sources.writers import write_parquet
from ebbtide.spec import DatasetSpec


@dataclass(frozen=True)
class Outcome:
    """``history`` has a row per epoch, ``evaluation`` and ``sizes`` a row per split."""

    model: Model
    cuts: SplitCuts
    history: DataFrame
    evaluation: DataFrame
    sizes: DataFrame


def _materialised(df: DataFrame) -> DataFrame:
    """A report of a few rows, computed once."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def train_and_evaluate(
    known: DataFrame,
    external: DataFrame,
    spec: DatasetSpec,
    config: TrainConfig,
    log: str | None = None,
) -> Outcome:
    """Split the known rows, fit scaler and network on the training part, pick the epoch with the
    best validation F1, evaluate on validation, internal test and external rows.

    With a ``log`` folder every epoch is evaluated and written down as it ends, with ranking metrics;
    training ends early with ``config.patience``, and goes on from the log when it is started again."""
    spark = known.sparkSession
    cuts = fit_split(known, spec.keys, spec.label, seed=config.seed)
    # each of the passes below reads its splits, and takes the hash of no key again
    tagged_path = scratch_path(spark, "tagged")
    assigned = cuts.assign(known)
    write_parquet(assigned, tagged_path, partition_by=["split"])
    tagged = spark.read.schema(assigned.schema).parquet(tagged_path)
    everything = tagged.unionByName(external.withColumn("split", F.lit(EXTERNAL_TEST)))
    sizes = _materialised(split_sizes(everything))
    training_rows = tagged.filter(F.col("split") == TRAIN).drop("split")
    scaler = fit_scaler(training_rows, spec.features)
    shards = shard_rows(training_rows, spec.keys, scaler, spec.label, config)
    validation = tagged.filter(F.col("split") == VALIDATION)
    if log is None:
        fitted = train(shards, spec.features, config)
        history = _materialised(epoch_history(validation, fitted, scaler, spec.label, config))
    else:
        fitted = train_logged(shards, validation, scaler, spec.label, config, log)
        history = _materialised(epoch_table(known.sparkSession, log))
    best = best_epoch(history).first()["best_epoch"]
    model = pick_model(fitted, scaler, best or 0, config)
    if config.tune_threshold:
        model = tuned(model, score(validation, model, spec.label), spec.label)

    held_out = everything.filter(F.col("split") != TRAIN)
    # the evaluation counts the scores in more than one scan
    scored_path = scratch_path(spark, "scored")
    scored = score(held_out, model, spec.label).select("split", spec.label, "probability", "loss")
    write_parquet(scored, scored_path)
    stored = spark.read.schema(scored.schema).parquet(scored_path)
    evaluation = _materialised(evaluate(stored, spec.label, ["split"], threshold=model.threshold))
    for path in (tagged_path, scored_path):
        remove_path(spark, path)
    return Outcome(model, cuts, history, evaluation, sizes)


def parameters_of(
    config: TrainConfig, spec: DatasetSpec, threshold: float | None = None
) -> dict[str, object]:
    return {
        "batch_size": config.batch_size,
        "epochs": config.epochs,
        "learning_rate": config.learning_rate,
        "prediction_threshold": threshold if threshold is not None else config.threshold,
        "input_features": len(spec.features),
        "random_seed": config.seed,
    }


def run_training(
    spark: SparkSession,
    known_path: str,
    external_path: str,
    target: str,
    spec: DatasetSpec,
    config: TrainConfig | None = None,
    restartable: bool = False,
) -> Outcome:
    """Train on stored feature tables; write ``model/``, ``metrics/`` and ``history/``, and, if
    ``restartable``, ``log/`` while training runs."""
    config = config or TrainConfig()
    outcome = train_and_evaluate(
        load_features(spark, known_path, spec),
        load_features(spark, external_path, spec),
        spec,
        config,
        f"{target}/log" if restartable else None,
    )
    save_model(spark, outcome.model, f"{target}/model")
    document = metrics_document(
        spark,
        outcome.evaluation,
        outcome.sizes,
        parameters_of(config, spec, outcome.model.threshold),
        outcome.model.best_epoch,
    )
    write_document(document, f"{target}/metrics")
    write_parquet(outcome.history.coalesce(1), f"{target}/history")
    return outcome
