"""A model as three small Parquet tables: weights, scaler, meta."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ebbtide.functions.network import shapes
from ebbtide.operators.scale import Scaler
from ebbtide.operators.score import DEFAULT_THRESHOLD, Model

WEIGHTS_SCHEMA = "layer int, row int, col int, value double"
META_SCHEMA = "key string, value string"


def save_model(spark: SparkSession, model: Model, path: str) -> str:
    """``row`` counts the inputs of a layer; the last row of each layer is its bias."""
    positions = [
        (depth, i, j)
        for depth, (rows, cols) in enumerate(shapes(model.layers))
        for i in range(rows)
        for j in range(cols)
    ]
    weights = [(*p, float(v)) for p, v in zip(positions, model.weights, strict=True)]
    meta = [
        ("layers", ",".join(str(n) for n in model.layers)),
        ("prediction_threshold", repr(model.threshold)),
        ("best_epoch", str(model.best_epoch)),
    ]
    for name, table in (
        ("weights", spark.createDataFrame(weights, WEIGHTS_SCHEMA)),
        ("scaler", model.scaler.to_table(spark)),
        ("meta", spark.createDataFrame(meta, META_SCHEMA)),
    ):
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")
    return path


def load_model(spark: SparkSession, path: str) -> Model:
    """The tables are as large as the model, not the data; they are read to the driver."""
    meta = {r["key"]: r["value"] for r in spark.read.parquet(f"{path}/meta").collect()}
    rows = spark.read.parquet(f"{path}/weights").orderBy("layer", "row", "col").collect()
    return Model(
        scaler=Scaler.from_table(spark.read.parquet(f"{path}/scaler")),
        layers=tuple(int(n) for n in meta["layers"].split(",")),
        weights=tuple(r["value"] for r in rows),
        threshold=float(meta.get("prediction_threshold", DEFAULT_THRESHOLD)),
        best_epoch=int(meta.get("best_epoch", 0)),
    )
