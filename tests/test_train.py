from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.catalog.tables import customer_features, order_line_features, rule_model
from ebbtide.functions import network
from ebbtide.operators.scale import Scaler, fit_scaler
from ebbtide.operators.score import Model, score
from ebbtide.operators.train import TrainConfig, epoch_history, shard_rows, train
from ebbtide.plans import training
from ebbtide.plans.training import train_and_evaluate
from ebbtide.spec import CHURN, DatasetSpec

LINES = DatasetSpec(
    name="lines",
    keys=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"),
    label="large",
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
)


@pytest.fixture(scope="module")
def lines(spark, medium):
    rows = order_line_features(spark, medium).withColumn("large", F.col("large").cast("double"))
    return rows.select(*LINES.keys, *LINES.numeric, "large", "dataset").persist()


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(0)
    layers = (3, 4, 2, 1)
    weights = network.initial_weights(layers, 1)
    x, y = rng.normal(size=(6, 3)), rng.integers(0, 2, 6).astype(float)
    keep = (rng.random((6, 4)) > 0.3) / 0.7
    _, gradient = network.loss_and_gradient(x, y, weights, layers, keep)
    for i in range(len(weights)):
        bump = np.zeros_like(weights)
        bump[i] = 1e-6
        up, _ = network.loss_and_gradient(x, y, weights + bump, layers, keep)
        down, _ = network.loss_and_gradient(x, y, weights - bump, layers, keep)
        assert gradient[i] == pytest.approx((up - down) / 2e-6, abs=1e-7)


def test_parameter_count():
    assert len(network.initial_weights((15, 32, 16, 1), 0)) == 1057


def test_adam_first_step_is_the_learning_rate():
    adam = network.Adam(network.Adam.start(np.zeros(3)), 0.002)
    adam.step(np.array([1.0, -2.0, 0.0], dtype=np.float32))
    assert adam.weights == pytest.approx([-0.002, 0.002, 0.0], abs=1e-8)


@pytest.mark.parametrize("rows", [1, 10, 64, 1000])
def test_batches_cover_every_row_once(rows):
    data = np.arange(rows)[:, None]
    chunks = (data[i : i + 7] for i in range(0, rows, 7))
    batches = list(network.shuffled_batches(chunks, 10, 40, np.random.default_rng(0)))
    assert sorted(np.concatenate(batches).ravel()) == list(range(rows))
    assert all(len(b) == 10 for b in batches[:-1])


def test_udf_and_sql_forms_agree(spark, small):
    rows = customer_features(spark, small)
    model = rule_model(fit_scaler(rows, CHURN.features))
    forms = [
        {r["customer_id"]: r["logit"] for r in score(rows, model, form=f).collect()}
        for f in ("udf", "sql")
    ]
    assert forms[0].keys() == forms[1].keys()
    assert max(abs(forms[0][k] - forms[1][k]) for k in forms[0]) < 1e-9


def test_default_threshold_is_inclusive(spark):
    model = Model(Scaler(("x",), (0.0,), (1.0,)), (1, 1), (0.0, 0.0))
    row = score(spark.createDataFrame([(1, 3.0)], "id int, x double"), model).first()
    assert (row["probability"], row["prediction"]) == (0.5, 1)


def _shards(lines, config):
    rows = lines.filter("dataset = 'train'").drop("dataset")
    return shard_rows(rows, LINES.keys, fit_scaler(rows, LINES.features), "large", config)


def test_same_seed_same_weights_whatever_the_input_partitions(lines):
    config = TrainConfig(epochs=1, batch_size=256, rounds_per_epoch=2, shards=3)
    seen = [
        train(_shards(lines.repartition(p), config), LINES.features, config).snapshots
        for p in (1, 7)
    ]
    assert seen[0] == seen[1]
    other = replace(config, seed=7)
    assert train(_shards(lines, other), LINES.features, other).snapshots != seen[0]


def test_copies_of_one_key_are_dealt_out(lines):
    one_key = lines.withColumns({"l_orderkey": F.lit(7).cast("long"), "l_linenumber": F.lit(1).cast("long")})
    spec_keys = ("l_orderkey", "l_linenumber")
    scaler = fit_scaler(lines, LINES.features)
    shards = shard_rows(one_key, spec_keys, scaler, "large", TrainConfig(shards=4))
    sizes = [r["count"] for r in shards.groupBy("shard").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1.2 * min(sizes)


def test_shards_hold_every_row_once(lines):
    shards = _shards(lines, TrainConfig(shards=5))
    assert shards.rdd.getNumPartitions() == 5
    assert shards.count() == lines.filter("dataset = 'train'").count()
    sizes = [r["count"] for r in shards.groupBy("shard").count().collect()]
    assert len(sizes) == 5 and max(sizes) < 1.2 * min(sizes)
    per_partition = shards.select("shard", F.spark_partition_id().alias("p")).distinct()
    assert all(r["shard"] == r["p"] for r in per_partition.collect())


def test_regime_does_not_follow_the_rows(lines):
    """A few rows are dealt to the same number of shards as many, and every slice is visited."""
    few = _shards(lines.limit(300), TrainConfig())
    assert few.rdd.getNumPartitions() == TrainConfig().shards
    assert few.select("slice").distinct().count() == TrainConfig().rounds_per_epoch


def test_history_scores_each_row_once(lines):
    config = TrainConfig(epochs=2, rounds_per_epoch=1, shards=2)
    scaler = fit_scaler(lines, LINES.features)
    training = train(_shards(lines, config), LINES.features, config)
    history = epoch_history(lines, training, scaler, "large", config)
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "Window" not in plan and "Generate explode" not in plan
    rows = {r["epoch"]: r for r in history.collect()}
    model = Model(scaler, training.layers, training.snapshots[1], config.threshold)
    hit = score(lines, model, "large").filter("prediction = 1 and large = 1").count()
    assert rows[2]["tp"] == hit and rows[2]["row_count"] == lines.count()


def test_learns_with_several_shards(lines):
    known = lines.filter("dataset = 'train'").drop("dataset")
    external = lines.filter("dataset = 'external'").drop("dataset")
    config = TrainConfig(epochs=4, batch_size=128, rounds_per_epoch=2, shards=4)
    outcome = train_and_evaluate(known, external, LINES, config)
    report = {r["split"]: r for r in outcome.evaluation.collect()}
    assert set(report) == {"validation", "internal_test", "external_test"}
    assert min(r["roc_auc"] for r in report.values()) > 0.95
    history = outcome.history.orderBy("epoch").collect()
    assert [r["epoch"] for r in history] == [1, 2, 3, 4]
    best = max(history, key=lambda r: (r["f1"], -r["epoch"]))
    assert outcome.model.best_epoch == best["epoch"]
    assert report["validation"]["f1"] == pytest.approx(best["f1"])
    sizes = {r["split"]: r["row_count"] for r in outcome.sizes.collect()}
    assert sum(sizes.values()) == lines.count()


def test_passes_read_what_was_stored(lines, monkeypatch):
    """The hash of a key and the score of a row are worked out once, not in every later scan."""
    plans = {}
    for name in ("shard_rows", "epoch_history", "evaluate"):

        def seen(rows, *args, _name=name, _call=getattr(training, name), **options):
            plans[_name] = rows._jdf.queryExecution().executedPlan().toString()
            return _call(rows, *args, **options)

        monkeypatch.setattr(training, name, seen)
    known = lines.filter("dataset = 'train'").drop("dataset")
    external = lines.filter("dataset = 'external'").drop("dataset")
    config = TrainConfig(epochs=1, batch_size=256, rounds_per_epoch=1, shards=2)
    outcome = train_and_evaluate(known, external, LINES, config)
    assert all("md5" not in plan and "ArrowEvalPython" not in plan for plan in plans.values()) and len(plans) == 3
    held_out = {r["split"]: r["row_count"] for r in outcome.evaluation.collect()}
    assert held_out == {r["split"]: r["row_count"] for r in outcome.sizes.collect() if r["split"] != "training"}
