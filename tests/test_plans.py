"""All stages from CSV to run tables, through files only."""

import pytest
from pyspark.sql import functions as F

from ebbtide.catalog.tables import customer_features, customer_raw
from ebbtide.operators.score import score
from ebbtide.operators.train import TrainConfig
from ebbtide.plans.diagnosis import run_diagnosis
from ebbtide.plans.ingest import run_clean, run_features
from ebbtide.plans.tracking import run_record
from ebbtide.plans.training import run_training
from ebbtide.sources.documents import read_document
from ebbtide.sources.models import load_model
from ebbtide.sources.readers import load_features
from ebbtide.sources.writers import read_runs, replace_run, verify_rows, write_parquet
from ebbtide.spec import CHURN


@pytest.fixture(scope="module")
def folder(spark, medium, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    raw = customer_raw(spark, medium)
    for name in ("train", "external"):
        part = raw.filter(raw["dataset"] == name).drop("dataset")
        part.write.option("header", True).csv(f"{root}/raw_{name}")
    return root


@pytest.fixture(scope="module")
def cleaned(spark, folder):
    return {
        n: run_clean(spark, f"{folder}/raw_{n}", f"{folder}/clean_{n}", CHURN)
        for n in ("train", "external")
    }


@pytest.fixture(scope="module")
def featured(spark, folder, cleaned):
    return {
        n: run_features(spark, f"{folder}/clean_{n}", f"{folder}/features_{n}", CHURN, files=8)
        for n in cleaned
    }


@pytest.fixture(scope="module")
def trained(spark, folder, featured):
    config = TrainConfig(epochs=3, batch_size=64)
    paths = [f"{folder}/features_{n}" for n in ("train", "external")]
    return run_training(spark, *paths, f"{folder}/run", CHURN, config)


@pytest.fixture(scope="module")
def diagnosed(spark, folder, trained):
    paths = [f"{folder}/features_{n}" for n in ("train", "external")]
    return run_diagnosis(spark, *paths, f"{folder}/run/model", f"{folder}/report", CHURN)


def test_clean_stage(spark, folder, cleaned):
    for name, report in cleaned.items():
        assert report.raw_rows == spark.read.option("header", True).csv(f"{folder}/raw_{name}").count()
        assert report.cleaned_rows == report.verified_rows
        assert report.removed_rows == report.raw_rows - report.cleaned_rows > 0
        assert report.label_frequency.count() == 2
        assert set(report.category_frequency) == set(CHURN.categorical)
        assert report.sample.count() == 5


def test_feature_stage(spark, folder, medium, featured):
    assert all(r.input_rows == r.feature_rows == r.verified_rows for r in featured.values())
    assert all(set(r.null_rows.values()) == {0} for r in featured.values())
    assert featured["train"].feature_columns == 17
    direct = customer_features(spark, medium)
    for name in featured:
        stored = spark.read.parquet(f"{folder}/features_{name}")
        want = direct.filter(direct["dataset"] == name).drop("dataset")
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, want.collect()))


def test_training_stage(spark, folder, trained):
    model = load_model(spark, f"{folder}/run/model")
    assert model == trained.model
    document = read_document(spark, f"{folder}/run/metrics").first()
    sizes = {r["split"]: r["row_count"] for r in trained.sizes.collect()}
    assert document["dataset_sizes"].asDict() == sizes
    assert document["best_epoch"] == model.best_epoch
    assert document["parameters"]["epochs"] == 3
    for r in trained.evaluation.collect():
        assert document[r["split"]]["f1"] == r["f1"]


def test_diagnosis_stage(spark, folder, trained, diagnosed):
    assert diagnosed.report.count() == 15
    assert diagnosed.report.columns[0] == "feature"
    assert diagnosed.largest_changes.count() == 10
    external = diagnosed.external.first()
    same = {r["split"]: r for r in trained.evaluation.collect()}["external_test"]
    for m in ("tn", "fp", "fn", "tp", "f1", "roc_auc"):
        assert external[m] == pytest.approx(same[m])
    rates = {r["dataset"]: r["rate"] for r in diagnosed.label_rates.collect()}
    assert external["actual_rate"] == pytest.approx(rates["external"])
    rows = load_features(spark, f"{folder}/features_external", CHURN)
    predicted = score(rows, trained.model).groupBy().avg("prediction").first()[0]
    assert external["predicted_rate"] == pytest.approx(predicted)


def test_record_stage(spark, folder, trained, diagnosed):
    tables = f"{folder}/tables"
    for run_id in ("r1", "r2", "r1"):  # recording a run again changes nothing
        run_record(spark, run_id, f"{folder}/run", tables, diagnosed.report)
    metrics = spark.read.parquet(f"{tables}/metrics")
    assert metrics.filter("run_id = 'r1'").count() == 21 == metrics.count() // 2
    row = metrics.filter("run_id = 'r2' and key = 'validation_f1'").first()
    want = {r["split"]: r["f1"] for r in trained.evaluation.collect()}["validation"]
    assert row["value"] == want
    params = {r["key"]: r["value"] for r in spark.read.parquet(f"{tables}/params").filter("run_id = 'r1'").collect()}
    assert params["model_architecture"] == "15-32-16-1"
    assert int(params["training_rows"]) > 0 and params["learning_rate"] == "0.002"
    tags = {r["key"]: r["value"] for r in spark.read.parquet(f"{tables}/tags").filter("run_id = 'r1'").collect()}
    assert tags["distribution_shift_detected"] in ("true", "false")


def test_feature_contract(spark, tmp_path, featured, folder):
    features = spark.read.parquet(f"{folder}/features_external")
    write_parquet(features.drop("age"), str(tmp_path / "short"))
    with pytest.raises(ValueError, match="age"):
        load_features(spark, str(tmp_path / "short"), CHURN)
    holes = features.selectExpr("*").withColumn("tenure", features["tenure"] * None)
    write_parquet(holes.withColumn("tenure", holes["tenure"].cast("double")), str(tmp_path / "holes"))
    with pytest.raises(ValueError, match="tenure"):
        load_features(spark, str(tmp_path / "holes"), CHURN)


def test_contract_refuses_nan_and_absent_keys(spark, tmp_path, featured, folder):
    features = spark.read.parquet(f"{folder}/features_external")
    odd = features.withColumn("tenure", F.when(F.col("age") > F.lit(30.0), F.lit(float("nan"))).otherwise(1.0))
    write_parquet(odd, str(tmp_path / "nan"))
    with pytest.raises(ValueError, match="tenure"):
        load_features(spark, str(tmp_path / "nan"), CHURN)
    write_parquet(features.drop("customer_id"), str(tmp_path / "keyless"))
    with pytest.raises(ValueError, match="customer_id"):
        load_features(spark, str(tmp_path / "keyless"), CHURN)


def test_run_ids_stay_texts(spark, tmp_path):
    rows = spark.createDataFrame([("007", "a", 1.0)], "run_id string, key string, value double")
    replace_run(rows, str(tmp_path / "t"))
    replace_run(rows.withColumn("value", F.lit(2.0)), str(tmp_path / "t"))
    assert [tuple(r) for r in read_runs(spark, str(tmp_path / "t")).collect()] == [("007", "a", 2.0)]


def test_read_back_differences_are_refused(spark, tmp_path):
    rows = spark.range(10)
    write_parquet(rows, str(tmp_path / "out"), rows_per_file=4)
    assert verify_rows(rows, str(tmp_path / "out"), 10) == 10
    with pytest.raises(RuntimeError, match="10 rows read back"):
        verify_rows(rows, str(tmp_path / "out"), 11)
