import math
import random

import pytest
from pyspark.sql import functions as F

from ebbtide.functions.columns import cross_entropy, decision, sigmoid
from ebbtide.operators.metrics import (
    METRICS,
    balanced_accuracy,
    best_epoch,
    cumulative_counts,
    evaluate,
    ranking_metrics,
    threshold_metrics,
)


def frame(spark, scores, labels):
    return spark.createDataFrame(
        [(float(s), int(y)) for s, y in zip(scores, labels, strict=True)], "score double, y int"
    )


def ranked(spark, scores, labels):
    r = ranking_metrics(frame(spark, scores, labels), "y", "score").first()
    return r["roc_auc"], r["average_precision"]


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels, strict=True) if y]
    neg = [s for s, y in zip(scores, labels, strict=True) if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(scores, labels):
    total, previous, area = sum(labels), 0.0, 0.0
    for t in sorted(set(scores), reverse=True):
        chosen = [y for s, y in zip(scores, labels, strict=True) if s >= t]
        recall = sum(chosen) / total
        area += (recall - previous) * sum(chosen) / len(chosen)
        previous = recall
    return area


def test_micro_cases(spark):
    assert ranked(spark, [0.5] * 4, [0, 1, 0, 1]) == (0.5, 0.5)
    assert ranked(spark, [0.1, 0.2, 0.8, 0.9], [0, 0, 1, 1]) == (1.0, 1.0)
    assert ranked(spark, [0.1, 0.2, 0.3], [1, 1, 1]) == (None, 1.0)
    assert ranked(spark, [0.1, 0.2, 0.3], [0, 0, 0]) == (None, 0.0)


@pytest.mark.parametrize("kind", ["ties", "distinct", "hot"])
def test_ranking_equals_brute_force(spark, kind):
    rng = random.Random(kind)
    labels = [int(rng.random() < 0.3) for _ in range(1500)]
    draw = {
        "ties": lambda: rng.randrange(9) / 9,
        "distinct": rng.random,
        # two thirds of the rows share one score, the rest crowd just below it
        "hot": lambda: 1.0 if rng.random() < 0.66 else 1.0 - rng.random() * 1e-6,
    }[kind]
    scores = [draw() for _ in labels]
    auc, ap = ranked(spark, scores, labels)
    assert auc == pytest.approx(brute_auc(scores, labels), abs=1e-12)
    assert ap == pytest.approx(brute_ap(scores, labels), abs=1e-12)


def test_ranking_identities(spark):
    rng = random.Random(1)
    scores = [rng.randrange(50) / 50 for _ in range(400)]
    labels = [int(rng.random() < s) for s in scores]
    auc, ap = ranked(spark, scores, labels)
    assert ranked(spark, [-s for s in scores], labels)[0] == pytest.approx(1 - auc)
    assert ranked(spark, [math.exp(3 * s) for s in scores], labels) == pytest.approx((auc, ap))


def test_results_do_not_depend_on_partitions_or_ranges(spark):
    rng = random.Random(2)
    df = frame(spark, [rng.random() for _ in range(900)], [rng.randrange(2) for _ in range(900)])
    width = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for partitions, shuffle in ((1, "8"), (4, "3"), (16, "300")):
            spark.conf.set("spark.sql.shuffle.partitions", shuffle)
            r = ranking_metrics(df.repartition(partitions), "y", "score").first()
            seen.append((round(r["roc_auc"], 12), round(r["average_precision"], 12)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    assert len(set(seen)) == 1


def test_no_single_task_window_over_rows(spark):
    df = frame(spark, [0.1, 0.2], [0, 1])
    counts = cumulative_counts(df, "y", "score")
    plan = counts._jdf.queryExecution().executedPlan().toString().splitlines()
    # what feeds a window over rows: the exchange below it names the group and the range
    # (the windows over ranges, ordered by range, have a row per range)
    windows = [i for i, line in enumerate(plan) if "windowspecdefinition" in line and "score#" in line]
    assert windows
    for i in windows:
        below = next(line for line in plan[i + 1 :] if "Exchange" in line and "Broadcast" not in line)
        assert "SinglePartition" not in below
    assert {(r["score"], r["tp"], r["fp"]) for r in counts.collect()} == {(0.1, 1, 1), (0.2, 1, 0)}


@pytest.mark.parametrize("ranges", [2, 1024])
def test_result_does_not_depend_on_the_ranges(spark, ranges):
    rng = random.Random(8)
    df = frame(spark, [rng.random() for _ in range(400)], [int(rng.random() < 0.4) for _ in range(400)])
    want = {tuple(r) for r in cumulative_counts(df, "y", "score").select("score", "tp", "fp").collect()}
    got = cumulative_counts(df, "y", "score", ranges=ranges).select("score", "tp", "fp")
    assert {tuple(r) for r in got.collect()} == want


def test_null_group_is_kept(spark):
    df = frame(spark, [0.1, 0.9, 0.2, 0.8], [0, 1, 1, 0]).withColumn(
        "g", F.when(F.col("score") < 0.5, "a").otherwise(None)
    )
    assert {r["g"]: r["roc_auc"] for r in ranking_metrics(df, "y", "score", ["g"]).collect()} == {
        "a": 1.0,
        None: 1.0,
    }


@pytest.mark.parametrize("row", [(None, 1), (float("nan"), 1), (0.3, None)])
def test_rows_that_cannot_be_ranked_are_refused(spark, row):
    df = spark.createDataFrame([(0.1, 0), (0.9, 1), row], "score double, y int")
    with pytest.raises(Exception, match="NULL or NaN"):
        ranking_metrics(df, "y", "score").collect()


def test_threshold_edges(spark):
    df = frame(spark, [0.1, 0.2], [0, 1]).withColumn("p", decision(F.col("score")))
    r = threshold_metrics(df, "y", "p").first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (1, 0, 1, 0)
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (0.5, 0.0, 0.0, 0.0)
    assert frame(spark, [0.5], [1]).select(decision(F.col("score"))).first()[0] == 1
    assert balanced_accuracy(df, "y", "p").first()[0] == 0.5
    assert balanced_accuracy(df.filter("y = 1"), "y", "p").first()[0] == 0.0


def test_evaluate_agrees_with_its_parts(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.uniform(-4, 4), float(rng.random() < 0.4)) for _ in range(600)]
    df = spark.createDataFrame(rows, "split string, logit double, y double").withColumns(
        {"probability": sigmoid(F.col("logit")), "loss": cross_entropy(F.col("logit"), F.col("y"))}
    )
    report = {r["split"]: r for r in evaluate(df, "y").collect()}
    hard = df.withColumn("p", decision(F.col("probability")))
    for r in threshold_metrics(hard, "y", "p", ["split"]).collect():
        for m in ("tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "f1"):
            assert report[r["split"]][m] == pytest.approx(r[m])
    for g in "ab":
        part = [(z, y) for s, z, y in rows if s == g]
        loss = [max(z, 0) - z * y + math.log1p(math.exp(-abs(z))) for z, y in part]
        assert report[g]["loss"] == pytest.approx(sum(loss) / len(loss))
        assert report[g]["roc_auc"] == pytest.approx(brute_auc(*zip(*part, strict=True)))
        assert report[g]["average_precision"] == pytest.approx(brute_ap(*zip(*part, strict=True)))
        assert report[g]["row_count"] == len(part)
    assert set(METRICS) <= set(report["a"].asDict())


def test_extreme_logits(spark):
    df = spark.createDataFrame([(800.0, 0.0), (-800.0, 1.0)], "z double, y double")
    rows = df.select(sigmoid(F.col("z")), cross_entropy(F.col("z"), F.col("y"))).collect()
    assert [tuple(r) for r in rows] == [(1.0, 800.0), (0.0, 800.0)]


def test_best_epoch_takes_the_earliest(spark):
    history = spark.createDataFrame(
        [("r", 1, 0.5), ("r", 2, 0.9), ("r", 3, 0.9), ("s", 1, 0.0), ("s", 2, 0.0)],
        "run string, epoch int, f1 double",
    )
    assert {r["run"]: r["best_epoch"] for r in best_epoch(history, ["run"]).collect()} == {"r": 2, "s": 1}
