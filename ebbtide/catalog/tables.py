"""The given tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.network import shapes
from ebbtide.operators.clean import clean
from ebbtide.operators.features import build_features
from ebbtide.operators.scale import Scaler
from ebbtide.operators.score import Model
from ebbtide.spec import CHURN, DatasetSpec
from ebbtide.streaming.drift import utc_time

DATASET = "dataset"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw churn records derived from customers, their orders and their events.

    Defects are built in on purpose: NULL keys, labels and values, a third label, negative
    values, padded and unknown categories, and second copies of some customers. Orders and events
    are aggregated per customer before the joins. The ``dataset`` column tells training from
    external customers by nation.
    """
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.max(month) - F.min(month)).alias("span"),
            (F.lit(2001 * 12 + 8) - F.max(month)).alias("idle"),
            F.count_if(F.col("o_orderstatus") == "P").alias("pending"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("spend"),
        )
    )
    errors = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("c_custkey"))
        .agg(F.count_if(F.col("event_type") == "error").alias("errors"))
    )
    key = F.col("c_custkey")
    copies = F.when(key % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    segment, region = F.col("c_mktsegment"), F.col("c_nationkey") % 4
    joined = (
        table(spark, sf_dir, "customer")
        .join(per_customer, "c_custkey", "left")
        .join(errors, "c_custkey", "left")
        .withColumn("copy", F.explode(copies))
    )
    return joined.select(
        F.when(key % 97 != 0, key).cast("int").alias("CustomerID"),
        F.when(key % 31 != 0, 18 + key % 60).cast("int").alias("Age"),
        F.when(key % 4 == 0, " Male ")
        .when(key % 4 == 1, "FEMALE")
        .when(key % 4 == 2, "Female")
        .alias("Gender"),
        (F.coalesce("span", F.lit(0)) - F.col("copy")).cast("int").alias("Tenure"),
        F.col("n").cast("int").alias("Usage Frequency"),
        F.col("errors").cast("int").alias("Support Calls"),
        F.when(key % 53 == 0, -1).otherwise(F.col("pending")).cast("int").alias("Payment Delay"),
        F.when(segment == "AUTOMOBILE", "Basic ")
        .when(segment == "BUILDING", "Standard")
        .when(segment == "FURNITURE", " premium")
        .when(segment == "MACHINERY", "Trial")
        .alias("Subscription Type"),
        F.when(region == 0, "Monthly")
        .when(region == 1, "Quarterly")
        .when(region == 2, "annual")
        .alias("Contract Length"),
        F.col("spend").alias("Total Spend"),
        F.col("idle").cast("int").alias("Last Interaction"),
        F.when(key % 89 == 0, None)
        .when(key % 101 == 0, 2)
        .otherwise((F.coalesce("idle", F.lit(0)) > 6).cast("int"))
        .cast("int")
        .alias("Churn"),
        F.when(F.col("c_nationkey") < 20, "train").otherwise("external").alias(DATASET),
    )


def customer_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(customer_raw(spark, sf_dir), CHURN, keep=[DATASET])


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(customer_clean(spark, sf_dir), CHURN, keep=[DATASET])


# Order lines as a labelled table. ``returned`` is the given label; ``large`` is a label that
# follows from the features, for learning.
ORDER_LINES = DatasetSpec(
    name="order_lines",
    keys=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"),
    label="returned",
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical={"l_linestatus": {"o": "status_open", "f": "status_filled"}},
)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = (F.col("l_returnflag") == "R").cast("int")
    large = (F.col("l_quantity") * (1 - F.col("l_discount")) > 25).cast("int")
    years = F.when(F.year("l_shipdate") < 1997, "train").otherwise("external")
    return table(spark, sf_dir, "lineitem").select(
        *ORDER_LINES.keys,
        *ORDER_LINES.numeric,
        "l_linestatus",
        returned.alias("returned"),
        large.alias("large"),
        years.alias(DATASET),
    )


def order_line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_lines(spark, sf_dir)
    return build_features(rows, ORDER_LINES, keep=["large", DATASET])


# Orders by month and events by day, for drift over time.
ORDER_FEATURES = ("o_totalprice", "urgent", "day")
EVENT_FEATURES = ("value", "hour")


def monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        "o_totalprice",
        (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("urgent"),
        F.dayofmonth("o_orderdate").cast("double").alias("day"),
        (F.col("o_orderstatus") == "F").cast("double").alias("filled"),
    )


def event_rows(events: DataFrame) -> DataFrame:
    """Events, stored or streamed, with ``time`` as UTC."""
    return events.select(
        utc_time("ts").alias("time"),
        "value",
        F.hour("ts").cast("double").alias("hour"),
        (F.col("event_type") == "error").cast("double").alias("error"),
    )


def rule_model(scaler: Scaler, hidden: tuple[int, ...] = (32, 16)) -> Model:
    """A model with weights from a rule and statistics to 3 decimals, so that scores of single
    rows can be compared across engines."""
    scaler = Scaler(
        scaler.features,
        tuple(round(m, 3) for m in scaler.mean),
        tuple(round(s, 3) for s in scaler.scale),
    )
    layers = (len(scaler.features), *hidden, 1)
    weights = [
        ((i * 7 + j * 3 + depth) % 11 - 5) / 10
        for depth, (rows, cols) in enumerate(shapes(layers))
        for i in range(rows)
        for j in range(cols)
    ]
    return Model(scaler, layers, tuple(weights))
