"""The gradient of a network over all rows: one pass, exact sums."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import network
from ebbtide.operators.score import Model


def _placed(position: Column, layers: Sequence[int]) -> list[Column]:
    """Layer, row and column of a position in the flat parameter vector."""
    layer, row, col = (F.lit(None).cast("int") for _ in range(3))
    start = sum(rows * cols for rows, cols in network.shapes(layers))
    for depth, (rows, cols) in reversed(list(enumerate(network.shapes(layers)))):
        start -= rows * cols
        here = position >= start
        place = (position - start).cast("int")
        # from the last layer back: an earlier layer takes over below its end
        after = start + rows * cols
        inside = here & (position < after)
        layer = F.when(inside, F.lit(depth)).otherwise(layer)
        row = F.when(inside, F.floor(place / cols).cast("int")).otherwise(row)
        col = F.when(inside, place % cols).otherwise(col)
    return [layer.alias("layer"), row.alias("row"), col.alias("col")]


def full_gradient(rows: DataFrame, model: Model, label: str) -> DataFrame:
    """``(layer, row, col, gradient)``: the gradient of the mean cross-entropy of all rows with respect to
    each parameter of the model, without dropout; the last ``row`` of a layer is its bias.

    A task adds up the outer products of its rows; the sums of the tasks are added as decimals, so they
    do not depend on the order of the tasks. No rows give no gradient.
    """
    weights = np.asarray(model.weights, dtype=float)
    layers = tuple(model.layers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(weights), np.longdouble), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            block = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            _, gradient = network.loss_and_gradient(block[:, :-1], block[:, -1], weights, layers)
            total += gradient.astype(np.longdouble) * batch.num_rows
            n += batch.num_rows
        if n:
            sums = pa.array([total.astype(float).tolist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), sums], names=["n", "sums"])

    scaled = model.scaler.transform(rows.select(*model.features, label))
    numbers = scaled.select(*[F.col(c).cast("double") for c in (*model.features, label)])
    parts = numbers.mapInArrow(run, "n bigint, sums array<double>")
    each = parts.select("n", F.posexplode("sums").alias("position", "value"))
    sums = each.groupBy("position").agg(
        F.sum(F.col("value").cast("decimal(38,18)")).cast("double").alias("total"),
        F.sum("n").alias("n"),
    )
    return sums.select(*_placed(F.col("position"), layers), (F.col("total") / F.col("n")).alias("gradient"))


def gradient_norm(gradient: DataFrame) -> DataFrame:
    """One row: how far from a standstill training is."""
    return gradient.agg(F.sqrt(F.sum(F.col("gradient") * F.col("gradient"))).alias("norm"))
