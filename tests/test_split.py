import pytest
from pyspark.sql import functions as F

from ebbtide.functions.columns import key_text
from ebbtide.operators import split
from ebbtide.operators.split import fit_split, quotas, split_exact, split_hash, split_sizes


def labelled(spark, n, positives=3):
    return spark.range(n).select("id", (F.col("id") % 10 < positives).cast("int").alias("y"))


def sizes(df, *by):
    return {tuple(r)[:-1]: r["row_count"] for r in split_sizes(df, by).collect()}


def test_published_sizes():
    """440,832 rows with the published class counts give the published split sizes."""
    for positives in (250_000, 249_999, 1):
        q = quotas({0: 440_832 - positives, 1: positives})
        train = sum(a for a, _ in q.values())
        validation = sum(b for _, b in q.values())
        assert (train, validation, 440_832 - train - validation) == (308_582, 66_125, 66_125)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 101, 5000])
def test_exact_quotas(spark, n):
    rows = labelled(spark, n)
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    out = split_exact(rows, ["id"], "y")
    got = sizes(out, "y")
    for y, (train, validation) in quotas(counts).items():
        rest = counts[y] - train - validation
        want = {"training": train, "validation": validation, "internal_test": rest}
        assert {s: got.get((s, y), 0) for s in want} == want
    assert out.select("id").distinct().count() == n == out.count()


def test_does_not_depend_on_partitions(spark):
    rows = labelled(spark, 4000)
    seen = [
        sorted(map(tuple, split_exact(rows.repartition(p), ["id"], "y").collect()))
        for p in (1, 4, 16)
    ]
    assert seen[0] == seen[1] == seen[2]


def test_deeper_bins_give_the_same_cuts(spark, monkeypatch):
    rows = labelled(spark, 6000)
    flat = fit_split(rows, ["id"], "y")
    for most in (3, 0):
        monkeypatch.setattr(split, "RANKABLE", most)
        assert sorted(map(str, fit_split(rows, ["id"], "y").cuts)) == sorted(map(str, flat.cuts))


def test_seed_changes_membership(spark):
    rows = labelled(spark, 1000)
    a, b = (split_exact(rows, ["id"], "y", seed=s) for s in (1, 2))
    assert sizes(a) == sizes(b)
    assert sorted(map(tuple, a.collect())) != sorted(map(tuple, b.collect()))


def test_hot_duplicate_key_stays_on_one_side(spark):
    rows = labelled(spark, 2000).unionByName(
        spark.range(1000).select(F.lit(7).cast("long").alias("id"), F.lit(1).alias("y"))
    )
    out = split_exact(rows, ["id"], "y")
    assert out.filter("id = 7 and y = 1").select("split").distinct().count() == 1
    assert out.count() == 3000


def test_cuts_apply_to_new_rows(spark):
    rows = labelled(spark, 3000)
    cuts = fit_split(rows, ["id"], "y")
    again = cuts.assign(labelled(spark, 4000)).filter("id < 3000")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, cuts.assign(rows).collect()))


def test_assignment_is_a_projection(spark):
    rows = labelled(spark, 100)
    plan = fit_split(rows, ["id"], "y").assign(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_a_null_label_is_refused(spark):
    rows = labelled(spark, 20).withColumn("y", F.when(F.col("id") > 3, F.col("y")))
    with pytest.raises(ValueError, match="NULL"):
        fit_split(rows, ["id"], "y")


def test_hash_mode(spark):
    out = split_hash(labelled(spark, 20_000), ["id"])
    got = sizes(out)
    assert abs(got[("training",)] / 20_000 - 0.7) < 0.02
    assert abs(got[("validation",)] / 20_000 - 0.15) < 0.02
    more = split_hash(labelled(spark, 30_000), ["id"]).filter("id < 20000")
    assert sorted(map(tuple, more.collect())) == sorted(map(tuple, out.collect()))


def test_more_than_64_labels(spark):
    rows = spark.range(9000).select("id", (F.col("id") % 90).alias("y"))
    got = sizes(split_exact(rows, ["id"], "y"), "y")
    for y, (train, validation) in quotas({k: 100 for k in range(90)}).items():
        assert (got["training", y], got["validation", y]) == (train, validation)


def test_keys_that_join_to_one_text_stay_apart(spark):
    parts = [("a:b", "c"), ("a", "b:c"), (None, "a:b:c"), ("", "a:b:c"), ("a\\", "b"), ("a", "\\b"), ("\\N", "x"), (None, "x")]
    rows = spark.createDataFrame(parts, "a string, b string")
    assert rows.select(key_text(["a", "b"])).distinct().count() == len(parts)
    many = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, F.lit("x:")).when(F.col("id") % 3 == 1, F.lit("x")).alias("a"),
        F.concat_ws(":", F.lit(""), "id").alias("b"),
        (F.col("id") % 2).alias("y"),
    )
    got = sizes(split_exact(many, ["a", "b"], "y"))
    assert (got[("training",)], got[("validation",)], got[("internal_test",)]) == (700, 150, 150)
    one = spark.createDataFrame([(-7,)], "k long").select(key_text(["k"])).first()[0]
    assert one == "-7"
