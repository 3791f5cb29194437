"""Thresholds and curve points against all distinct scores in plain Python."""

import random
from collections import defaultdict

import pytest

from ebbtide.operators.curves import area_below, best_threshold, curve_points, tuned
from ebbtide.operators.metrics import ranking_metrics
from ebbtide.operators.scale import Scaler
from ebbtide.operators.score import Model
from ebbtide.sources.models import load_model, save_model


def scored(seed, n, levels, groups=("a", "b", None)):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        y = int(rng.random() < 0.3)
        score = rng.gauss(y, 1.2)
        if levels:
            score = round(score * levels) / levels
        rows.append((rng.choice(groups), score, y))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, s double, y int").repartition(5)


def steps_of(rows):
    """Per group (score, tp, fp) by falling score."""
    groups = defaultdict(lambda: defaultdict(lambda: [0, 0]))
    for g, s, y in rows:
        groups[g][s][y] += 1
    out = {}
    for g, scores in groups.items():
        tp = fp = 0
        out[g] = []
        for s in sorted(scores, reverse=True):
            fp, tp = fp + scores[s][0], tp + scores[s][1]
            out[g].append((s, tp, fp))
    return out


@pytest.mark.parametrize("levels", [0, 3, 1])
def test_best_threshold(spark, levels):
    rows = scored(levels, 900, levels)
    got = {r["g"]: r for r in best_threshold(frame(spark, rows), "y", "s", ["g"]).collect()}
    for g, steps in steps_of(rows).items():
        p, n = steps[-1][1:]
        f1, s, tp, fp = max((2 * tp / (tp + fp + p), s, tp, fp) for s, tp, fp in steps)
        r = got[g]
        assert (r["threshold"], r["tp"], r["fp"], r["fn"], r["tn"]) == (s, tp, fp, p - tp, n - fp)
        assert r["f1"] == pytest.approx(f1) and (r["positives"], r["negatives"]) == (p, n)


def test_of_equal_f1_the_highest_score(spark):
    # predicting 1, or 3 of 4: F1 is 2/3 both times
    rows = [(None, s, y) for s, y in ((0.9, 1), (0.8, 0), (0.7, 0), (0.6, 1))]
    assert best_threshold(frame(spark, rows), "y", "s").first()["threshold"] == 0.9


def test_one_class_has_no_threshold(spark):
    rows = [("p", 0.1, 1), ("p", 0.2, 1), ("n", 0.1, 0), ("b", 0.1, 0), ("b", 0.3, 1)]
    got = {r["g"]: r for r in best_threshold(frame(spark, rows), "y", "s", ["g"]).collect()}
    assert got["p"]["threshold"] is None and got["p"]["f1"] is None and got["p"]["positives"] == 2
    assert got["n"]["threshold"] is None and got["n"]["negatives"] == 1
    assert got["b"]["threshold"] == 0.3 and got["b"]["f1"] == 1.0
    assert best_threshold(frame(spark, []), "y", "s").collect() == []


def test_threshold_goes_with_the_model(spark, tmp_path):
    rows = scored(4, 300, 0)
    model = Model(Scaler(("x",), (0.0,), (1.0,)), (1, 1), (1.0, 0.0))
    best = best_threshold(frame(spark, rows), "y", "s").first()["threshold"]
    loaded = load_model(spark, save_model(spark, tuned(model, frame(spark, rows), "y", "s"), str(tmp_path)))
    assert loaded.threshold == best != model.threshold
    assert tuned(model, frame(spark, [("a", 0.3, 1)]), "y", "s") == model
    assert tuned(model, frame(spark, []), "y", "s") == model


@pytest.mark.parametrize("levels,steps", [(0, 20), (0, 7), (4, 20), (1, 2000)])
def test_points_are_few_and_close(spark, levels, steps):
    rows = scored(levels + steps, 3000, levels)
    df = frame(spark, rows)
    points = curve_points(df, "y", "s", ["g"], steps).cache()
    auc = {r["g"]: r["roc_auc"] for r in ranking_metrics(df, "y", "s", ["g"]).collect()}
    area = {r["g"]: r["area"] for r in area_below(points, ["g"]).collect()}
    found = defaultdict(list)
    for r in sorted(points.collect(), key=lambda r: r["point"]):
        found[r["g"]].append(r)
    for g, all_steps in steps_of(rows).items():
        p, n = all_steps[-1][1:]
        mine = found[g]
        assert len(mine) <= 2 * (2 * steps + 1) + 1
        assert [r["point"] for r in mine] == list(range(len(mine)))
        assert (mine[0]["tp"], mine[0]["fp"], mine[0]["threshold"], mine[0]["precision"]) == (0, 0, None, 1.0)
        assert (mine[-1]["tp"], mine[-1]["fp"]) == (p, n)
        assert {(r["threshold"], r["tp"], r["fp"]) for r in mine[1:]} <= set(all_steps)
        assert all((r["tn"], r["fn"]) == (n - r["fp"], p - r["tp"]) for r in mine)
        assert all(r["recall"] == r["true_positive_rate"] == r["tp"] / p for r in mine)
        assert all(r["precision"] == r["tp"] / (r["tp"] + r["fp"]) for r in mine[1:])
        assert abs(area[g] - auc[g]) <= 1 / steps + 1 / (2 * steps**2)
        if levels == 1:  # few scores, small cells: all of them are points
            assert area[g] == pytest.approx(auc[g])
        cells = defaultdict(list)
        for s, tp, fp in all_steps:
            cells[tp * steps // p, fp * steps // n].append((s, tp, fp))
        kept = {x for c in cells.values() for x in (c[0], c[-1])}
        assert {(r["threshold"], r["tp"], r["fp"]) for r in mine[1:]} == kept


def test_points_of_one_class_and_of_nothing(spark):
    points = curve_points(frame(spark, [("a", 0.1, 1), ("a", 0.5, 1)]), "y", "s", steps=4).collect()
    assert len(points) == 3 and all(r["false_positive_rate"] is None for r in points)
    assert curve_points(frame(spark, []), "y", "s").collect() == []
