import pytest
from pyspark.sql import functions as F

from ebbtide.operators.clean import clean, clean_counted, dedupe, valid
from ebbtide.operators.features import build_features
from ebbtide.operators.profile import null_audit, row_balance
from ebbtide.sources.readers import read_csv
from ebbtide.spec import CHURN

HEADER = ",".join(CHURN.rename)
EDGE = f"""{HEADER}
1,30.0, Male ,1,1,1,1,Basic,Annual,NaN,1,1
2,30,,1,1,1,1,"  ",Annual,Inf,1,0
,,,,,,,,,,,
4,-5,\tMale,1,1,1,1,Basic,Annual,5,1,2
5,30,Male,1,1,1,1,Basic
6,99999999999,"",1,1,1,1,Basic,Annual,5,1,1,EXTRA
"""


@pytest.fixture
def edge(spark, tmp_path):
    path = tmp_path / "edge.csv"
    path.write_text(EDGE)
    return read_csv(spark, str(path), CHURN)


def churn_rows(spark, rows):
    names = list(CHURN.columns)
    types = {f.name: f.dataType for f in CHURN.raw_schema}
    schema = ", ".join(f"`{raw}` {types[raw].simpleString()}" for raw in CHURN.rename)
    base = dict.fromkeys(names, 1) | {
        "gender": "Male",
        "subscription_type": "Basic",
        "contract_length": "Annual",
        "total_spend": 1.0,
    }
    return spark.createDataFrame([tuple((base | r)[c] for c in names) for r in rows], schema)


def test_malformed_fields_and_short_rows(edge):
    assert edge.count() == 6
    rows = {r["CustomerID"]: r for r in edge.collect()}
    assert rows[1]["Age"] is None and rows[6]["Age"] is None
    assert rows[5]["Churn"] is None
    assert rows[6]["Gender"] is None


def test_edge_rows_after_cleaning(edge):
    rows = {r["customer_id"]: r for r in clean(edge, CHURN).collect()}
    assert set(rows) == {1, 2, 6}
    assert (rows[1]["age"], rows[1]["total_spend"], rows[1]["gender"]) == (0, 0.0, "Male")
    assert rows[2]["gender"] == "Unknown"
    assert rows[2]["subscription_type"] == ""
    assert rows[2]["total_spend"] == float("inf")
    assert (rows[6]["age"], rows[6]["gender"]) == (0, "Unknown")


def test_trim_leaves_tabs(edge):
    spec_rows = edge.filter(F.col("CustomerID") == 4)
    assert build_features(clean(spec_rows.withColumn("Churn", F.lit(1)).withColumn("Age", F.lit(5)), CHURN), CHURN).first()["gender_male"] == 0.0


def test_swapped_header_is_refused(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text(HEADER.replace("Age,Gender", "Gender,Age") + "\n1,Male,30,1,1,1,1,Basic,Annual,5,1,1\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_csv(spark, str(path), CHURN).collect()


def test_survivor_decides_before_validity(spark):
    rows = churn_rows(
        spark,
        [
            {"customer_id": 1, "age": 40, "payment_delay": -1},
            {"customer_id": 1, "age": 30},
            {"customer_id": 2, "age": 5},
        ],
    )
    assert [r["customer_id"] for r in clean(rows, CHURN).collect()] == [2]
    first = clean(rows, CHURN, validate_first=True)
    assert sorted((r["customer_id"], r["age"]) for r in first.collect()) == [(1, 30), (2, 5)]


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_dedupe_does_not_depend_on_partitions(spark, partitions):
    rows = spark.range(3000).select(
        (F.col("id") % 700).alias("k"),
        (F.col("id") * 7 % 13).alias("a"),
        F.col("id").alias("b"),
        F.when(F.col("id") % 3 == 0, F.lit("x")).alias("c"),
    )
    expected = {}
    for r in rows.collect():
        order = (r["a"], r["b"], r["c"] is not None, r["c"] or "")
        expected[r["k"]] = max(expected.get(r["k"], order), order)
    spread = rows.repartition(partitions)
    plain = dedupe(spread, ["k"])
    assert {r["k"]: (r["a"], r["b"]) for r in plain.collect()} == {k: v[:2] for k, v in expected.items()}
    counted = dedupe(spread, ["k"], copies="n")
    assert sorted(map(tuple, counted.drop("n").collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert counted.agg(F.sum("n")).first()[0] == 3000


def test_hot_key_is_limited_before_the_exchange(spark):
    plan = dedupe(spark.range(10).select((F.col("id") % 2).alias("k"), "id"), ["k"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_counted_cleaning_keeps_all_raw_rows(edge):
    merged = clean_counted(edge, CHURN)
    assert merged.agg(F.sum("_copies")).first()[0] == 6
    kept = valid(merged.filter(F.col("customer_id").isNotNull()), CHURN).drop("_copies")
    assert sorted(map(str, kept.collect())) == sorted(map(str, clean(edge, CHURN).collect()))


def test_features_and_audit(edge):
    features = build_features(clean(edge, CHURN), CHURN)
    assert features.columns == ["customer_id", *CHURN.features, "churn"]
    assert {f.dataType.simpleString() for f in features.schema.fields[1:]} == {"double"}
    row = features.filter("customer_id = 2").first()
    assert [row[c] for c in CHURN.one_hot] == [0, 0, 0, 0, 0, 0, 0, 1]
    assert all(r["null_rows"] == 0 for r in null_audit(features).collect())
    empty = null_audit(features.filter("customer_id < 0"))
    assert {r["null_rows"] for r in empty.collect()} == {0}


def test_row_balance(edge):
    r = row_balance(edge, clean(edge, CHURN)).first()
    assert (r["raw_rows"], r["cleaned_rows"], r["removed_rows"]) == (6, 3, 3)
