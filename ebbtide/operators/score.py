"""Batch scoring of a stored network: logit, probability, prediction, loss."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import network
from ebbtide.functions.columns import cross_entropy, decision, sigmoid
from ebbtide.operators.scale import Scaler

# Fixed value: threshold of a model that stores none.
DEFAULT_THRESHOLD = 0.5


@dataclass(frozen=True)
class Model:
    """Weights with everything scoring needs: the feature order travels with the model.

    A model is a few KB whatever the size of the data, so it is shipped inside the closure.
    """

    scaler: Scaler
    layers: tuple[int, ...]
    weights: tuple[float, ...]
    threshold: float = DEFAULT_THRESHOLD
    best_epoch: int = 0

    @property
    def features(self) -> tuple[str, ...]:
        return self.scaler.features


def _matrix(columns: tuple[pa.Array, ...] | pa.Array) -> np.ndarray:
    """Rows by features; Spark hands over a bare array when there is one feature."""
    if isinstance(columns, pa.Array):
        columns = (columns,)
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])


def logit_udf(weights: Sequence[float], layers: Sequence[int]):
    """Arrow-batched forward pass over standardised feature columns."""
    flat = np.asarray(weights, dtype=float)
    widths = tuple(layers)

    def forward(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            yield pa.array(network.logits(_matrix(columns), flat, widths))

    forward.__annotations__ = {
        "batches": Iterator[tuple[pa.Array, ...]],
        "return": Iterator[pa.Array],
    }
    return F.arrow_udf(forward, "double")


def epoch_logits_udf(snapshots: Sequence[Sequence[float]], layers: Sequence[int]):
    """Forward pass of several weight snapshots at once: an array of logits per row."""
    flats = [np.asarray(s, dtype=float) for s in snapshots]
    widths = tuple(layers)

    def forward(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            x = _matrix(columns)
            values = np.column_stack([network.logits(x, flat, widths) for flat in flats])
            ends = np.arange(len(x) + 1, dtype=np.int32) * len(flats)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))

    forward.__annotations__ = {
        "batches": Iterator[tuple[pa.Array, ...]],
        "return": Iterator[pa.Array],
    }
    return F.arrow_udf(forward, "array<double>")


def _sum(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def sql_logit(df: DataFrame, model: Model, name: str = "logit") -> DataFrame:
    """The forward pass as column expressions over standardised features, one projection per
    layer so that no hidden unit is written out twice."""
    mats = network.matrices(np.asarray(model.weights, dtype=float), model.layers)
    kept = list(df.columns)
    inputs = list(model.features)
    for depth, w in enumerate(mats):
        last = depth == len(mats) - 1
        units = [
            _sum([F.col(c) * F.lit(float(v)) for c, v in zip(inputs, w[:-1, j], strict=True)])
            + F.lit(float(w[-1, j]))
            for j in range(w.shape[1])
        ]
        names = [name] if last else [f"_h{depth}_{j}" for j in range(len(units))]
        if not last:
            units = [F.greatest(u, F.lit(0.0)) for u in units]
        df = df.select(*kept, *[u.alias(n) for u, n in zip(units, names, strict=True)])
        inputs = names
    return df


def score(
    df: DataFrame, model: Model, label: str | None = None, form: str = "udf"
) -> DataFrame:
    """Keep the columns of ``df`` and add ``logit, probability, prediction`` and, with a label,
    ``loss``. ``form="sql"`` uses column expressions in place of the Arrow function."""
    originals = [c for c in df.columns if c not in model.features]
    kept = df.select(*originals, *model.features)
    scaled = model.scaler.transform(kept)
    if form == "sql":
        raw = sql_logit(scaled, model)
    else:
        forward = logit_udf(model.weights, model.layers)
        raw = scaled.withColumn("logit", forward(*model.features))
    columns = {"probability": sigmoid(F.col("logit"))}
    out = raw.drop(*model.features).withColumns(columns)
    out = out.withColumn("prediction", decision(F.col("probability"), model.threshold))
    if label is not None:
        out = out.withColumn("loss", cross_entropy(F.col("logit"), F.col(label)))
    return out
