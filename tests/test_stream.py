"""Drift on a stream: closed windows, late rows, a restart, a batch run again."""

import datetime as dt
import os
import statistics

import pytest
from pyspark.sql import functions as F

from ebbtide.operators.drift import feature_profile
from ebbtide.streaming.drift import read_drift, stream_drift, utc_day, utc_time, windowed_moments

SCHEMA = "ts timestamp_ntz, x double, y double"


def at(day, hour=12):
    return dt.datetime(2024, 3, day, hour)


class Feed:
    """A folder of event files and the stream over it."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files, self.rows = spark, folder, 0, []
        (folder / "in").mkdir()
        base = spark.createDataFrame([(float(i % 5), float(i % 2)) for i in range(40)], "x double, y double")
        profile = feature_profile(base, ["x"], "y")
        self.reference = spark.createDataFrame(profile.collect(), profile.schema)

    def add(self, rows):
        self.files += 1
        frame = self.spark.createDataFrame(rows, SCHEMA).coalesce(1)
        frame.write.mode("append").parquet(str(self.folder / "in"))

    def run(self, **trigger):
        events = self.spark.readStream.schema(SCHEMA).parquet(str(self.folder / "in"))
        query = stream_drift(
            events.select(utc_time("ts").alias("time"), "x", "y"),
            "time",
            ["x"],
            "y",
            self.reference,
            str(self.folder / "out"),
            str(self.folder / "checkpoint"),
            **trigger,
        )
        query.awaitTermination()

    def report(self):
        rows = read_drift(self.spark, str(self.folder / "out"), "y")
        return {r["day"].day: r for r in rows.withColumn("day", utc_day(F.col("start"))).collect()}

    def count(self):
        return read_drift(self.spark, str(self.folder / "out"), "y").count()


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def day(d, values, hour=12):
    return [(at(d, hour), float(v), float(i % 2)) for i, v in enumerate(values)]


def test_closed_windows_and_restart(feed):
    feed.add(day(1, [1, 2, 3]) + day(2, [4, 5]) + day(3, [6, 7, 8], 6))
    feed.run()
    # the newest event is of the third, six o'clock; a day later than a window's end it is closed
    assert sorted(feed.report()) == [1]
    feed.run()  # nothing came
    assert feed.count() == 1
    feed.add(day(2, [6]) + day(4, [1, 1], 1))  # the second is still open
    feed.run()
    assert sorted(feed.report()) == [1, 2] and feed.count() == 2
    got = feed.report()
    assert got[2]["row_count"] == 3 and got[2]["test_mean"] == pytest.approx(5.0)
    assert got[1]["test_mean"] == pytest.approx(2.0)
    base = [float(i % 5) for i in range(40)]
    shift = (5.0 - statistics.mean(base)) / statistics.stdev(base)
    assert got[2]["standardized_mean_shift"] == pytest.approx(shift)
    assert got[2]["drifted"]


def test_late_rows_are_left_out_of_closed_windows_only(feed):
    feed.add(day(1, [1, 2]) + day(5, [1]))
    feed.run()
    assert sorted(feed.report()) == [1]
    feed.add(day(1, [100]) + day(4, [3]) + day(9, [1]))  # the first is closed, the fourth is not
    feed.run()
    got = feed.report()
    assert got[1]["row_count"] == 2 and got[1]["test_mean"] == pytest.approx(1.5)
    assert got[4]["row_count"] == 1 and sorted(got) == [1, 4, 5] and feed.count() == 3


def test_a_batch_run_again_adds_nothing(feed):
    feed.add(day(1, [1, 2]) + day(4, [1]))
    feed.run()
    before = feed.count()
    commits = feed.folder / "checkpoint" / "commits"
    last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    # the driver is lost after the files were written and before the batch was marked as done
    os.remove(last)
    crc = commits / f".{last.name}.crc"
    if crc.exists():
        os.remove(crc)
    feed.run()
    assert feed.count() == before == 1
    feed.add(day(6, [2]))
    feed.run()
    assert sorted(feed.report()) == [1, 4]


def test_several_small_batches_equal_one(spark, tmp_path):
    results = []
    for name in ("one", "many"):
        (tmp_path / name).mkdir()
        feed = Feed(spark, tmp_path / name)
        parts = [day(d, [d, d + 1, 2 * d]) for d in range(1, 8)]
        if name == "one":
            feed.add([r for p in parts for r in p])
            feed.run()
        else:
            for p in parts:
                feed.add(p)
                feed.run()
        rows = read_drift(spark, str(tmp_path / name / "out"), "y").orderBy("start").collect()
        results.append([tuple(r) for r in rows])
    assert len(results[0]) == 5 and results[0] == results[1]


def test_the_same_moments_from_stored_rows(spark):
    rows = spark.createDataFrame(day(1, [1, 2, 3]) + day(2, [5], 0) + [(None, 1.0, 1.0)], SCHEMA)
    got = windowed_moments(rows.select(utc_time("ts").alias("time"), "x", "y"), "time", ["x"], "y")
    assert sorted((r["row_count"], r["x_mean"]) for r in got.collect()) == [(1, 5.0), (3, 2.0)]


def test_days_do_not_depend_on_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "Asia/Seoul", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            rows = spark.createDataFrame([(at(3, h), 1.0, 0.0) for h in (0, 5, 23)], SCHEMA)
            timed = rows.select(utc_time("ts").alias("time"), "x", "y")
            assert [r[0].day for r in timed.select(utc_day(F.col("time"))).distinct().collect()] == [3]
            windows = windowed_moments(timed, "time", ["x"], "y").collect()
            assert len(windows) == 1 and windows[0]["row_count"] == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
