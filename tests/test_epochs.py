"""Logged epochs: restart, early stop, ranking per epoch, groups of shards; the exact gradient."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.catalog.tables import customer_features, order_line_features, rule_model
from ebbtide.functions import network
from ebbtide.operators import train as T
from ebbtide.operators.epochs import epoch_evaluation, epoch_table, stopped, train_logged
from ebbtide.operators.gradient import full_gradient, gradient_norm
from ebbtide.operators.metrics import METRICS, evaluate
from ebbtide.operators.scale import fit_scaler
from ebbtide.operators.score import Model, score
from ebbtide.operators.train import TrainConfig, shard_rows, train
from ebbtide.plans.training import train_and_evaluate
from ebbtide.spec import CHURN, DatasetSpec

LINES = DatasetSpec(
    name="lines",
    keys=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"),
    label="large",
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
)
CONFIG = TrainConfig(epochs=3, batch_size=128, rounds_per_epoch=2, shards=3)


@pytest.fixture(scope="module")
def lines(spark, medium):
    rows = order_line_features(spark, medium).withColumn("large", F.col("large").cast("double"))
    return rows.select(*LINES.keys, *LINES.numeric, "large", "dataset").filter("l_orderkey % 4 = 0").persist()


@pytest.fixture(scope="module")
def known(lines):
    return lines.filter("dataset = 'train'").drop("dataset")


@pytest.fixture(scope="module")
def external(lines):
    return lines.filter("dataset = 'external'").drop("dataset")


@pytest.fixture(scope="module")
def scaler(known):
    return fit_scaler(known, LINES.features)


@pytest.fixture(scope="module")
def shards(known, scaler):
    return shard_rows(known, LINES.keys, scaler, "large", CONFIG)


def test_stopped_and_resumed_equals_unbroken(spark, shards, external, scaler, tmp_path):
    whole = train(shards, LINES.features, CONFIG)
    broken = str(tmp_path / "broken")
    first = train_logged(shards, external, scaler, "large", replace(CONFIG, epochs=1), broken)
    assert len(first.snapshots) == 1
    # a driver that was lost after the state of the second epoch, before its metrics
    for epoch, state, loss in T.run_epochs(shards, LINES.features, replace(CONFIG, epochs=2)):
        pass
    left = spark.createDataFrame([((state + 1).tolist(), 9.0, epoch)], "state array<double>, training_loss double, epoch int")
    left.write.mode("append").partitionBy("epoch").parquet(f"{broken}/states")
    resumed = train_logged(shards, external, scaler, "large", CONFIG, broken)
    assert resumed == whole
    assert train_logged(shards, external, scaler, "large", CONFIG, broken) == whole  # nothing left to do
    rows = epoch_table(spark, broken).orderBy("epoch").collect()
    assert [r["epoch"] for r in rows] == [1, 2, 3]
    assert [r["training_loss"] for r in rows] == list(whole.losses)
    for r, weights in zip(rows, whole.snapshots, strict=True):
        scored = score(external, Model(scaler, whole.layers, weights), "large")
        want = evaluate(scored, "large", by=()).first()
        assert all(r[m] == pytest.approx(want[m], rel=1e-12) for m in METRICS)


def test_other_parameters_are_refused(shards, external, scaler, tmp_path):
    folder = str(tmp_path / "log")
    train_logged(shards, external, scaler, "large", replace(CONFIG, epochs=1), folder)
    with pytest.raises(ValueError, match="other parameters"):
        train_logged(shards, external, scaler, "large", replace(CONFIG, seed=7), folder)


def test_early_stop(spark, shards, external, scaler, tmp_path):
    folder = str(tmp_path / "log")
    # no epoch can gain that much, so the second does not count as better
    config = replace(CONFIG, epochs=9, patience=1, least_gain=2.0)
    assert len(train_logged(shards, external, scaler, "large", config, folder).snapshots) == 2
    assert len(train_logged(shards, external, scaler, "large", config, folder).snapshots) == 2
    more = train_logged(shards, external, scaler, "large", replace(config, patience=2), folder)
    assert len(more.snapshots) == 3


def test_patience_counts_from_the_best():
    config = TrainConfig(patience=2)
    assert not stopped([], config) and not stopped([0.1, 0.1], config)
    assert stopped([0.5, 0.4, 0.5], config) and not stopped([0.5, 0.4, 0.6], config)
    assert not stopped([0.5] * 9, TrainConfig())
    assert stopped([0.5, 0.505, 0.509], replace(config, least_gain=0.01))


def test_all_epochs_in_one_scan(external, scaler, shards):
    training = train(shards, LINES.features, CONFIG)
    report = epoch_evaluation(external, training, scaler, "large", CONFIG)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("Window")[0]
    got = {r["epoch"]: r for r in report.collect()}
    for epoch, weights in enumerate(training.snapshots, 1):
        want = evaluate(score(external, Model(scaler, training.layers, weights), "large"), "large", by=()).first()
        assert all(got[epoch][m] == pytest.approx(want[m], rel=1e-12) for m in METRICS)
        assert all(got[epoch][c] == want[c] for c in ("tn", "fp", "fn", "tp", "row_count"))


def test_groups_average_within_and_between(known, scaler, monkeypatch):
    config = replace(CONFIG, groups=3, shards=2, epochs=2)
    shards = shard_rows(known, LINES.keys, scaler, "large", config)
    assert shards.rdd.getNumPartitions() == 6
    here = train(shards, LINES.features, config)
    monkeypatch.setattr(T, "DRIVER_STATES", 0)  # on the executors
    assert train(shards, LINES.features, config) == here
    # by hand: groups do not see one another within an epoch
    layers, state = here.layers, network.Adam.start(network.initial_weights(here.layers, config.seed))
    columns = [c for c in shards.columns if c != "slice"]
    states = [state] * 3
    sizes = [0, 0, 0]
    for part in range(config.rounds_per_epoch):
        for group in range(3):
            step = T._local_pass(np.array(states), layers, 1, part, config)
            own = shards.filter((F.col("slice") == part) & (F.floor(F.col("shard") / 2) == group))
            rows = sorted(own.select(*columns).mapInArrow(step, T.STATE_ROW).collect(), key=lambda r: r["shard"])
            n, mean = T._mean_state([(r["weight"], np.array(r["state"])) for r in rows])
            states[group], sizes[group] = mean[:-1], sizes[group] + n
    mean = T._mean_state(list(zip(sizes, states, strict=True)))[1]
    assert T.weights_of(mean) == here.snapshots[0]


def test_groups_grow_with_the_rows():
    config = TrainConfig()
    assert config.for_rows(0).groups == config.for_rows(8 << 20).groups == 1
    assert config.for_rows((8 << 20) + 1).groups == 2 and config.for_rows(1 << 60).groups == T.MOST_GROUPS


def test_restartable_plan_with_tuned_threshold(spark, known, external, tmp_path):
    config = replace(CONFIG, epochs=2, tune_threshold=True)
    outcome = train_and_evaluate(known, external, LINES, config, str(tmp_path / "log"))
    assert outcome.history.count() == 2 and "roc_auc" in outcome.history.columns
    plain = train_and_evaluate(known, external, LINES, replace(config, tune_threshold=False))
    assert outcome.model.weights == plain.model.weights
    assert outcome.model.threshold != plain.model.threshold == 0.5
    f1 = {o: {r["split"]: r["f1"] for r in x.evaluation.collect()} for o, x in (("tuned", outcome), ("plain", plain))}
    assert f1["tuned"]["validation"] >= f1["plain"]["validation"]


def test_gradient_of_all_rows(spark, small):
    rows = customer_features(spark, small).persist()
    model = rule_model(fit_scaler(rows, CHURN.features))
    scaled = model.scaler.transform(rows).select(*CHURN.features, CHURN.label).toPandas().to_numpy(float)
    weights = np.array(model.weights)
    _, want = network.loss_and_gradient(scaled[:, :-1], scaled[:, -1], weights, model.layers)
    results = []
    for n in (1, 9):
        got = full_gradient(rows.repartition(n), model, CHURN.label)
        values = [r["gradient"] for r in got.orderBy("layer", "row", "col").collect()]
        assert len(values) == 1057 and values == pytest.approx(want.tolist(), abs=1e-12)
        results.append(values)
        assert gradient_norm(got).first()["norm"] == pytest.approx(np.linalg.norm(want))
    assert results[0] == pytest.approx(results[1], abs=1e-14)
    places = [(r["layer"], r["row"], r["col"]) for r in got.orderBy("layer", "row", "col").collect()]
    assert places == [(d, i, j) for d, (a, b) in enumerate(network.shapes(model.layers)) for i in range(a) for j in range(b)]
    assert full_gradient(rows.limit(0), model, CHURN.label).collect() == []
