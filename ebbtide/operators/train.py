"""Data-parallel training of the network: local mini-batch Adam with periodic averaging.

The standardised training rows are hash-partitioned once into shards and kept in a reliable
checkpoint. Shards form groups. A round is one job: each shard runs its slice of the epoch from the
state of its group, and weights and moments are averaged by row count within the group, in the order of
the shards, so the result does not depend on the order in which tasks finish. At the end of an epoch the
groups are averaged. The driver sees a vector of the size of the model per shard, or, of many shards,
one per group, averaged on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import network
from ebbtide.functions.columns import cross_entropy, decision, key_text, ratio, sigmoid
from ebbtide.operators.metrics import balanced_accuracy_column, threshold_columns
from ebbtide.operators.scale import Scaler
from ebbtide.operators.score import DEFAULT_THRESHOLD, Model, epoch_logits_udf
from ebbtide.sources.scratch import shared_dir


@dataclass(frozen=True)
class TrainConfig:
    # Training parameters.
    hidden: tuple[int, ...] = (32, 16)
    dropout: float = 0.2
    batch_size: int = 2048
    epochs: int = 8
    learning_rate: float = 0.002
    threshold: float = DEFAULT_THRESHOLD
    seed: int = 42
    # Parallel regime: groups of shards, each shard one task. A group averages ``rounds_per_epoch``
    shards: int = 8
    rounds_per_epoch: int = 4
    shuffle_batches: int = 32
    groups: int = 1
    # Stop after so many epochs whose validation F1 is not above the best by more than ``least_gain``.
    patience: int | None = None
    least_gain: float = 0.0
    # Choose the decision threshold on the validation split instead of taking ``threshold``.
    tune_threshold: bool = False

    @property
    def parts(self) -> int:
        return self.groups * self.shards

    def for_rows(self, rows: int, rows_per_shard: int = 1 << 20) -> TrainConfig:
        """As many groups as give each shard at most about ``rows_per_shard`` rows, so that the tasks
        grow with the data; at most ``MOST_GROUPS``, after which shards grow."""
        groups = -(-rows // (self.shards * rows_per_shard))
        return replace(self, groups=min(max(groups, 1), MOST_GROUPS))


#: The states of all groups travel with every task: 25 KB each for the network of 15 features.
MOST_GROUPS = 256
#: States the driver averages itself, which saves a stage in every round.
DRIVER_STATES = 64


def shard_rows(
    rows: DataFrame,
    keys: Sequence[str],
    scaler: Scaler,
    label: str,
    config: TrainConfig,
) -> DataFrame:
    """Standardised float features and label, one partition per shard, in hash order, reliably
    checkpointed. The hash is taken before scaling: the statistics may differ in the last digit
    from run to run, the stored values do not."""
    shared_dir(rows.sparkSession)
    features = scaler.features
    if not 1 <= config.groups <= MOST_GROUPS:
        raise ValueError(f"groups must lie between 1 and {MOST_GROUPS}")
    # the values take part, so that copies of one key do not pile up in one shard
    place = F.xxhash64(F.lit(config.seed), key_text(keys), *features, label)
    scaled = scaler.transform(rows.select(place.alias("_place"), *features, label))
    high, low = F.shiftrightunsigned("_place", 32), F.col("_place").bitwiseAND(0xFFFFFFFF)
    narrow = scaled.select(
        (high % config.parts).cast("int").alias("shard"),
        (low % config.rounds_per_epoch).cast("int").alias("slice"),
        "_place",
        *[F.col(c).cast("float").alias(c) for c in (*features, label)],
    )
    placed = narrow.repartitionById(config.parts, F.col("shard"))
    ordered = placed.sortWithinPartitions("slice", "_place", *features, label)
    return ordered.drop("_place").checkpoint()


def _local_pass(
    states: np.ndarray, layers: Sequence[int], epoch: int, part: int, config: TrainConfig
):
    """Task body: one slice of one shard, from the state of its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss_sum, rows = 0.0, 0
        shard: list[int] = []

        def blocks() -> Iterator[np.ndarray]:
            for batch in batches:
                if batch.num_rows:
                    shard[:] = [batch.column(0)[0].as_py()]
                    yield np.column_stack(
                        [c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]
                    )

        stream = blocks()
        first = next(stream, None)
        if first is None:
            return
        group = shard[0] // config.shards
        adam = network.Adam(states[group], config.learning_rate)
        rng = np.random.default_rng([config.seed, epoch, part, shard[0]])

        def rest() -> Iterator[np.ndarray]:
            yield first
            yield from stream

        size = config.batch_size
        for block in network.shuffled_batches(rest(), size, size * config.shuffle_batches, rng):
            keep = rng.random((len(block), layers[1]), dtype=np.float32) >= config.dropout
            keep = keep.astype(np.float32) / np.float32(1 - config.dropout)
            loss, gradient = network.loss_and_gradient(
                block[:, :-1], block[:, -1], adam.weights, layers, keep
            )
            adam.step(gradient)
            loss_sum += loss * len(block)
            rows += len(block)
        result = np.append(adam.state(), loss_sum / rows)
        yield _state_batch(group, shard[0], rows, result)

    return run


STATE_ROW = "group int, shard int, weight bigint, state array<double>"


def _state_batch(group: int, shard: int, weight: int, state: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([group], pa.int32()),
            pa.array([shard], pa.int32()),
            pa.array([weight], pa.int64()),
            pa.array([state.tolist()], pa.list_(pa.float64())),
        ],
        names=["group", "shard", "weight", "state"],
    )


def _mean_state(states: list[tuple[int, np.ndarray]]) -> tuple[int, np.ndarray]:
    """Row-weighted mean in the order given, added up beyond double precision."""
    rows = sum(n for n, _ in states)
    total = sum((np.asarray(s, np.longdouble) * n for n, s in states), np.longdouble(0))
    return rows, (total / rows).astype(float)


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: states sorted by group and shard -> one state per group."""
    held: list[tuple[int, np.ndarray]] = []
    group = -1
    for batch in batches:
        for here, _, weight, state in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if here != group and held:
                yield _state_batch(group, 0, *_mean_state(held))
                held = []
            group = here
            held.append((weight, np.array(state)))
    if held:
        yield _state_batch(group, 0, *_mean_state(held))


def _average(passes: DataFrame, config: TrainConfig) -> list[tuple[int, int, np.ndarray]]:
    """``(group, rows, mean state)`` of the groups that had rows. Up to ``DRIVER_STATES`` states are
    averaged as they come in; of more, each group is one small task's work and the driver receives one
    vector per group. Both add in the same order."""
    if config.parts <= DRIVER_STATES:
        groups: dict[int, list[tuple[int, np.ndarray]]] = {}
        for r in sorted(passes.collect(), key=lambda r: r["shard"]):
            groups.setdefault(r["group"], []).append((r["weight"], np.array(r["state"])))
        return [(group, *_mean_state(states)) for group, states in groups.items()]
    ordered = passes.repartition(config.groups, "group").sortWithinPartitions("group", "shard")
    rows = ordered.mapInArrow(_averaged, STATE_ROW).collect()
    return [(r["group"], r["weight"], np.array(r["state"])) for r in sorted(rows, key=lambda r: r["group"])]


@dataclass(frozen=True)
class Training:
    """Weights after every epoch and the training loss of each."""

    layers: tuple[int, ...]
    snapshots: tuple[tuple[float, ...], ...]
    losses: tuple[float, ...]


def run_epochs(
    shards: DataFrame,
    features: Sequence[str],
    config: TrainConfig,
    state: np.ndarray | None = None,
    first: int = 1,
) -> Iterator[tuple[int, np.ndarray, float]]:
    """Train over the shards of ``shard_rows`` and give, after each epoch, its number, the state (weights,
    both moments, steps) and the mean loss. From the ``state`` after epoch ``first - 1`` it goes on as if
    it had never stopped."""
    layers = (len(features), *config.hidden, 1)
    if state is None:
        state = network.Adam.start(network.initial_weights(layers, config.seed))
    columns = [c for c in shards.columns if c != "slice"]
    # What does not fit in memory lies decoded on the executors' disks; the checkpoint stands behind.
    rows = shards.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for epoch in range(first, config.epochs + 1):
            states = np.repeat(state[None, :], config.groups, axis=0)
            seen = np.zeros(config.groups, np.int64)
            loss = 0.0
            for part in range(config.rounds_per_epoch):
                step = _local_pass(states, layers, epoch, part, config)
                passes = (
                    rows.filter(F.col("slice") == part).select(*columns).mapInArrow(step, STATE_ROW)
                )
                for group, n, mean in _average(passes, config):
                    states[group] = mean[:-1]
                    loss += mean[-1] * n
                    seen[group] += n
            if not seen.any():
                raise ValueError("no training rows")
            total, state = _mean_state([(int(n), s) for n, s in zip(seen, states, strict=True) if n])
            yield epoch, state, loss / total
    finally:
        rows.unpersist()


def weights_of(state: np.ndarray) -> tuple[float, ...]:
    return tuple(state[: (len(state) - 1) // 3].tolist())


def train(
    shards: DataFrame, features: Sequence[str], config: TrainConfig
) -> Training:
    """Run all epochs over the shards of ``shard_rows``."""
    done = [(weights_of(state), loss) for _, state, loss in run_epochs(shards, features, config)]
    layers = (len(features), *config.hidden, 1)
    return Training(layers, tuple(w for w, _ in done), tuple(loss for _, loss in done))


def epoch_history(
    validation: DataFrame, training: Training, scaler: Scaler, label: str, config: TrainConfig
) -> DataFrame:
    """Threshold metrics and loss of every epoch from a single scan: each row is scored by all
    snapshots at once, and only counts and sums per epoch leave the tasks. Ranking metrics, which need
    the scores in order, are for the chosen epoch (``evaluate``)."""
    forward = epoch_logits_udf(training.snapshots, training.layers)
    scored = scaler.transform(validation).select(
        F.col(label), forward(*scaler.features).alias("_logits")
    )
    y = F.col(label)

    def counted(i: int) -> list[Column]:
        logit = F.get("_logits", F.lit(i))
        hit = decision(sigmoid(logit), config.threshold)
        wanted = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
        return [
            *[F.count_if((y == t) & (hit == p)).alias(f"{n}_{i}") for n, (t, p) in wanted.items()],
            F.sum(cross_entropy(logit, y)).alias(f"loss_{i}"),
        ]

    epochs = range(len(training.snapshots))
    wide = scored.agg(F.count(F.lit(1)).alias("row_count"), *[c for i in epochs for c in counted(i)])
    names = ("tn", "fp", "fn", "tp", "loss")
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("epoch"),
                "row_count",
                *[F.col(f"{n}_{i}").alias(n) for n in names],
                F.lit(float(training.losses[i])).alias("training_loss"),
            )
            for i in epochs
        ]
    )
    history = wide.select(F.inline(rows))
    return history.withColumns(
        {
            "loss": ratio(F.col("loss"), F.col("row_count")),
            **threshold_columns(),
            "balanced_accuracy": balanced_accuracy_column(),
        }
    )


def pick_model(
    training: Training, scaler: Scaler, best_epoch: int, config: TrainConfig
) -> Model:
    if not 1 <= best_epoch <= len(training.snapshots):
        raise RuntimeError("training did not produce a model")
    return Model(
        scaler, training.layers, training.snapshots[best_epoch - 1], config.threshold, best_epoch
    )
