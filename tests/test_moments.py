"""Merged profiles against profiles of all rows at once, and the monitor on them."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from ebbtide.operators.drift import feature_profile
from ebbtide.operators.moments import (
    feature_moments,
    merge_moments,
    origins,
    profile_of,
    read_moments,
    write_moments,
)
from ebbtide.operators.monitor import (
    Tolerance,
    monitor_batches,
    read_monitor,
    recorded_batches,
)

FEATURES = ("x", "far", "constant", "gappy", "none")


def rows(n=3000, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        y = float(rng.random() < 0.4)
        x = rng.gauss(2 * y, 1)
        gappy = None if rng.random() < 0.3 or i % 7 == 3 else rng.gauss(-y, 3)
        out.append((f"d{i % 7}", i % 2, x, 1e9 + x, 0.1, gappy, None, y))
    return out


@pytest.fixture
def table(spark):
    schema = "day string, side int, x double, far double, constant double, gappy double, none double, y double"
    return spark.createDataFrame(rows(), schema).repartition(6)


def by_feature(profile, by=()):
    return {(*[r[c] for c in by], r["feature"]): r for r in profile.collect()}


def same(got, want, rel=1e-11):
    """Far from 0 the built-in deviation itself is good to some 8 digits only."""
    assert got.keys() == want.keys()
    for key, a in got.items():
        b, rel = want[key], 1e-7 if key[-1] == "far" else rel
        assert a["row_count"] == b["row_count"]
        for c in ("mean", "std", "correlation"):
            if b[c] is None:
                assert a[c] is None, (key, c)
            else:
                assert a[c] == pytest.approx(b[c], rel=rel, abs=1e-12), (key, c)


def test_merged_equals_at_once(table):
    near = origins(table, FEATURES)
    assert near["far"] == 1e9 and near["none"] == 0.0
    daily = feature_moments(table, FEATURES, "y", ["day", "side"], near)
    same(by_feature(profile_of(merge_moments(daily))), by_feature(feature_profile(table, FEATURES, "y")), 1e-9)
    sides = profile_of(merge_moments(daily, ["side"]), ["side"])
    same(by_feature(sides, ["side"]), by_feature(feature_profile(table, FEATURES, "y", ["side"]), ["side"]), 1e-9)


def test_a_mean_of_1e9_keeps_its_spread(table):
    """Held against fractions: the moments of far are those of x but for the rounding of its values."""
    from fractions import Fraction

    near = origins(table, FEATURES)
    merged = profile_of(merge_moments(feature_moments(table, ["far"], "y", ["day"], near))).first()
    far, y = zip(*[(Fraction(r[3]), Fraction(r[7])) for r in rows()])
    n = len(far)
    mean, mean_y = sum(far) / n, sum(y) / n
    m2, m2y = sum((v - mean) ** 2 for v in far), sum((v - mean_y) ** 2 for v in y)
    cross = sum((a - mean) * (b - mean_y) for a, b in zip(far, y))
    assert merged["std"] == pytest.approx(math.sqrt(m2 / (n - 1)), rel=1e-12)
    assert merged["correlation"] == pytest.approx(float(cross) / math.sqrt(m2) / math.sqrt(m2y), rel=1e-12)


def test_parts_with_different_origins_merge(table):
    first, second = table.filter("side = 0"), table.filter("side = 1")
    store = feature_moments(first, FEATURES, "y", ["day"], {"far": 1e9}).unionByName(
        feature_moments(second, FEATURES, "y", ["day"], {"far": 1e9 + 2, "x": -3.0})
    )
    same(by_feature(profile_of(merge_moments(store))), by_feature(feature_profile(table, FEATURES, "y")), 1e-9)


def test_merging_is_associative(table):
    daily = feature_moments(table, FEATURES, "y", ["day", "side"], origins(table, FEATURES))
    twice = merge_moments(merge_moments(daily, ["day"]))
    same(by_feature(profile_of(twice)), by_feature(profile_of(merge_moments(daily))))


def test_single_rows_and_no_rows(spark, table):
    each = feature_moments(table.limit(1), FEATURES, "y", ["day"])
    one = by_feature(profile_of(merge_moments(each)))[("x",)]
    assert one["row_count"] == 1 and one["std"] is None and one["correlation"] is None
    assert merge_moments(feature_moments(table.limit(0), FEATURES, "y", ["day"])).collect() == []
    ones = feature_moments(table.withColumn("k", F.monotonically_increasing_id()), ["x"], "y", ["k"])
    same(by_feature(profile_of(merge_moments(ones))), by_feature(feature_profile(table, ["x"], "y")), 1e-9)


def test_store_replaces_days_and_reads_ranges(spark, table, tmp_path):
    path = str(tmp_path / "store")
    near = origins(table, FEATURES)
    write_moments(feature_moments(table.filter("day < 'd4'"), FEATURES, "y", ["day"], near), path, "day")
    for _ in range(2):  # the second time replaces the first
        write_moments(feature_moments(table.filter("day >= 'd3'"), FEATURES, "y", ["day"], near), path, "day")
    store = read_moments(spark, path, "day")
    assert store.count() == 7 * len(FEATURES)
    same(by_feature(profile_of(merge_moments(store))), by_feature(feature_profile(table, FEATURES, "y")), 1e-9)
    part = F.col("day").isin("d1", "d2", "d5")
    merged = profile_of(merge_moments(store.filter(part)))
    same(by_feature(merged), by_feature(feature_profile(table.filter(part), FEATURES, "y")), 1e-9)
    plan = store.filter(part)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day" in plan


# --- monitor ----------------------------------------------------------------------------------


def batches(spark):
    data = [(f"2020-0{1 + i % 4}", float(i % 10) + (5.0 if i % 4 == 2 else 0.0), float(i % 3 == 0)) for i in range(400)]
    data += [(None, 1.0, 1.0)]
    return spark.createDataFrame(data, "month string, x double, y double")


def test_each_batch_once(spark, tmp_path):
    rows, target = batches(spark), str(tmp_path / "m")
    reference = feature_profile(rows.filter("month = '2020-01'"), ["x"], "y")
    run = lambda part: monitor_batches(part, "month", ["x"], "y", reference, target)
    assert run(rows.limit(0)) == []
    assert run(rows.filter("month < '2020-03'")) == ["2020-01", "2020-02"]
    before = sorted(p for p in (tmp_path / "m").rglob("*.parquet"))
    # rows of a recorded batch that come later are not read
    assert run(rows.withColumn("x", F.when(F.col("month") > "2020-02", F.col("x")).otherwise(99.0))) == ["2020-03", "2020-04"]
    assert run(rows) == []
    assert set(before) <= set((tmp_path / "m").rglob("*.parquet"))
    got = {r["month"]: r for r in read_monitor(spark, target, "month", "y").collect()}
    assert sorted(got) == ["2020-01", "2020-02", "2020-03", "2020-04"]
    for month, r in got.items():
        own = [x.x for x in rows.collect() if x.month == month]
        base = [x.x for x in rows.collect() if x.month == "2020-01"]
        shift = (statistics.mean(own) - statistics.mean(base)) / statistics.stdev(base)
        assert r["row_count"] == 100 and r["standardized_mean_shift"] == pytest.approx(shift)
        change = r["absolute_correlation_change"]
        assert r["drifted"] == (abs(shift) > 0.1 or change > 0.1)
    assert got["2020-03"]["drifted"] and not got["2020-01"]["drifted"]


def test_broken_run_is_taken_up(spark, tmp_path):
    rows, target = batches(spark), str(tmp_path / "m")
    reference = feature_profile(rows, ["x"], "y")
    # a run that got as far as the moments of one month, with other rows
    left = feature_moments(rows.filter("month = '2020-02'").limit(3), ["x"], "y", ["month"])
    write_moments(left, f"{target}/moments", "month")
    assert recorded_batches(spark, f"{target}/report", "month") == []
    assert len(monitor_batches(rows, "month", ["x"], "y", reference, target)) == 4
    assert {r["row_count"] for r in read_monitor(spark, target, "month", "y").collect()} == {100}


def test_tolerance_and_unknown_feature(spark, tmp_path):
    rows = batches(spark).withColumn("z", F.col("x") * 2)
    reference = feature_profile(rows.filter("month = '2020-01'"), ["x"], "y")
    target = str(tmp_path / "m")
    monitor_batches(rows, "month", ["x", "z"], "y", reference, target, Tolerance(100.0, 2.0))
    got = read_monitor(spark, target, "month", "y").collect()
    assert len(got) == 8 and not any(r["drifted"] for r in got)
    assert all((r["train_mean"] is None) == (r["feature"] == "z") for r in got)


def test_new_batches_only_are_read(spark, tmp_path):
    rows, target, path = batches(spark), str(tmp_path / "m"), str(tmp_path / "rows")
    rows.filter("month IS NOT NULL").write.partitionBy("month").parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    reference = feature_profile(stored, ["x"], "y")
    monitor_batches(stored.filter("month < '2020-04'"), "month", ["x"], "y", reference, target)
    done = recorded_batches(spark, f"{target}/report", "month")
    new = stored.filter(~F.col("month").isin(done))
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "2020-03" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert monitor_batches(stored, "month", ["x"], "y", reference, target) == ["2020-04"]
