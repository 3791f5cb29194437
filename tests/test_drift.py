import statistics

import pytest
from pyspark.sql import functions as F

from ebbtide.operators.drift import (
    align_profiles,
    drift_detected,
    feature_profile,
    largest_changes,
    shift_report,
)
from ebbtide.operators.scale import fit_scaler, scaler_table

ROWS = [
    ("train", 1.0, 5.0, 0.0),
    ("train", 2.0, 5.0, 1.0),
    ("train", 4.0, 5.0, 1.0),
    ("external", 3.0, 5.0, 1.0),
    ("external", 1.0, 6.0, 0.0),
    ("external", 9.0, 7.0, 0.0),
]


@pytest.fixture
def pair(spark):
    return spark.createDataFrame(ROWS, "dataset string, x double, constant double, y double")


def test_report_by_definition(pair):
    report = {r["feature"]: r for r in shift_report(pair, ["x", "constant"], "y").collect()}
    train, test = ([r for r in ROWS if r[0] == d] for d in ("train", "external"))
    x = report["x"]
    assert x["train_mean"] == pytest.approx(statistics.mean(r[1] for r in train))
    shift = statistics.mean(r[1] for r in test) - statistics.mean(r[1] for r in train)
    assert x["standardized_mean_shift"] == pytest.approx(shift / statistics.stdev(r[1] for r in train))
    for side, rows in (("train", train), ("test", test)):
        want = statistics.correlation([r[1] for r in rows], [r[3] for r in rows])
        assert x[f"{side}_correlation_with_y"] == pytest.approx(want)
    change = x["test_correlation_with_y"] - x["train_correlation_with_y"]
    assert x["correlation_change"] == pytest.approx(change)
    assert x["absolute_correlation_change"] == pytest.approx(abs(change))


def test_constant_feature_is_null_not_an_error(pair):
    c = {r["feature"]: r for r in shift_report(pair, ["x", "constant"], "y").collect()}["constant"]
    assert c["standardized_mean_shift"] is None
    assert c["train_correlation_with_y"] is None
    assert c["correlation_change"] is None


def test_stored_profiles_give_the_same_report(pair):
    sides = [
        feature_profile(pair.filter(F.col("dataset") == d), ["x", "constant"], "y")
        for d in ("train", "external")
    ]
    joined = align_profiles(*sides, "y").orderBy("feature").collect()
    single = shift_report(pair, ["x", "constant"], "y").orderBy("feature").collect()
    assert joined == single
    only_train = align_profiles(sides[0], sides[1].filter("feature = 'x'"), "y")
    lone = only_train.filter("feature = 'constant'").first()
    assert lone["train_mean"] == 5.0 and lone["test_mean"] is None


def test_correlation_uses_complete_pairs(spark):
    df = spark.createDataFrame(
        [(1.0, 0.0), (2.0, 1.0), (None, 1.0), (4.0, 1.0)], "x double, y double"
    )
    r = feature_profile(df, ["x"], "y").first()
    assert r["row_count"] == 3
    assert r["correlation"] == pytest.approx(statistics.correlation([1, 2, 4], [0, 1, 1]))


def test_mirror_columns_mirror(spark):
    df = spark.range(60).select(
        F.when(F.col("id") < 40, "train").otherwise("external").alias("dataset"),
        (F.col("id") % 3 == 0).cast("double").alias("a"),
        (F.col("id") % 3 != 0).cast("double").alias("b"),
        (F.col("id") % 7 < 3).cast("double").alias("y"),
    )
    report = {r["feature"]: r for r in shift_report(df, ["a", "b"], "y").collect()}
    for c in ("standardized_mean_shift", "correlation_change", "train_correlation_with_y"):
        assert report["a"][c] == pytest.approx(-report["b"][c])
    assert report["a"]["train_mean"] + report["b"]["train_mean"] == pytest.approx(1.0)
    assert [r["feature"] for r in largest_changes(shift_report(df, ["b", "a"], "y"), "y").collect()] == ["a", "b"]


def test_drift_flag(pair):
    report = shift_report(pair, ["x", "constant"], "y")
    largest = drift_detected(report, 0.1).first()
    assert largest["detected"] and not drift_detected(report, 10.0).first()["detected"]
    assert drift_detected(report.filter("feature = 'constant'"), 0.1).first()["detected"] is False


def test_scaler_is_population_and_guards_constants(pair):
    train = pair.filter("dataset = 'train'")
    scaler = fit_scaler(train, ["x", "constant"])
    assert scaler.scale == pytest.approx((statistics.pstdev([1, 2, 4]), 1.0))
    scaled = scaler.transform(train).select("x", "constant").collect()
    assert statistics.mean(r["x"] for r in scaled) == pytest.approx(0.0)
    assert statistics.pstdev(r["x"] for r in scaled) == pytest.approx(1.0)
    assert {r["constant"] for r in scaled} == {0.0}
    assert [r["position"] for r in scaler_table(train, ["x", "constant"]).collect()] == [0, 1]
