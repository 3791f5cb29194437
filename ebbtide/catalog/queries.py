"""``(spark, sf_dir) -> DataFrame`` per operator. Statistics are rounded only here, for comparison
across engines; the operators return them unrounded."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.catalog.tables import (
    DATASET,
    EVENT_FEATURES,
    ORDER_FEATURES,
    ORDER_LINES,
    customer_clean,
    customer_features,
    customer_raw,
    event_rows,
    monthly_orders,
    order_line_features,
    order_lines,
    rule_model,
    table,
)
from ebbtide.functions.columns import cross_entropy, sigmoid
from ebbtide.operators.clean import clean, conform, dedupe
from ebbtide.operators.curves import best_threshold, curve_points, tuned
from ebbtide.operators.drift import (
    align_profiles,
    drift_detected,
    feature_profile,
    largest_changes,
    report_numbers,
    shift_report,
)
from ebbtide.operators.epochs import epoch_table as read_epochs
from ebbtide.operators.epochs import score_epochs, train_logged
from ebbtide.operators.features import narrow
from ebbtide.operators.gradient import full_gradient
from ebbtide.operators.metrics import (
    METRICS,
    balanced_accuracy,
    best_epoch,
    confusion_matrix,
    evaluate,
    mean_loss,
    ranking_metrics,
    threshold_metrics,
)
from ebbtide.operators.moments import (
    feature_moments,
    merge_moments,
    origins,
    profile_of,
    read_moments,
    write_moments,
)
from ebbtide.operators.monitor import monitor_batches, read_monitor
from ebbtide.operators.profile import (
    displayed,
    frequency,
    null_audit,
    positive_rate,
    row_balance,
    sample_rows,
)
from ebbtide.operators.runs import metrics_flat, metrics_long, run_params, run_tags
from ebbtide.operators.scale import fit_scaler, scaler_table
from ebbtide.operators.score import score
from ebbtide.operators.split import TRAIN, split_exact, split_hash, split_sizes
from ebbtide.operators.train import TrainConfig, shard_rows
from ebbtide.plans.ingest import run_clean, run_features
from ebbtide.plans.training import parameters_of, train_and_evaluate
from ebbtide.sources.documents import (
    document_metrics,
    metrics_document,
    read_document,
    write_document,
)
from ebbtide.sources.models import load_model, save_model
from ebbtide.sources.readers import load_features, read_csv, read_parquet
from ebbtide.sources.scratch import scratch_path
from ebbtide.sources.versions import read_current, replace_verified
from ebbtide.sources.writers import verify_rows, write_parquet, write_report_csv
from ebbtide.spec import CHURN, DatasetSpec
from ebbtide.streaming.drift import read_drift, stream_drift, utc_day

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DIGITS = 9
# Values of single rows: many of them, so further away from the last digits.
ROW_DIGITS = 6
RUN_ID = "run-1"
# Tolerance on the absolute correlation change for the drift flag.
DRIFT_TOLERANCE = 0.1


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, columns: Sequence[str], digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def significant(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fewer decimals for larger magnitudes, to stay clear of the last digits of a sum."""
    size = {c: F.abs(F.col(c)) for c in columns}
    tiers = {
        c: F.when(size[c] < 1, F.round(c, 9))
        .when(size[c] < 1000, F.round(c, 7))
        .otherwise(F.round(c, 4))
        for c in columns
    }
    return df.withColumns(tiers)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written and read back, as between two stages: for what takes several passes."""
    return read_parquet(df.sparkSession, write_parquet(df, scratch_path(df.sparkSession, name)))


# --- cleaning and features -------------------------------------------------------------------


@query
def clean_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_clean(spark, sf_dir)


@query
def clean_customers_validate_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(customer_raw(spark, sf_dir), CHURN, keep=[DATASET], validate_first=True)


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records written as CSV, read back with the fixed schema, cleaned."""
    path = scratch_path(spark, "csv")
    raw = customer_raw(spark, sf_dir).drop(DATASET)
    raw.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return clean(read_csv(spark, path, CHURN), CHURN)


@query
def dedupe_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def label_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency(customer_clean(spark, sf_dir), DATASET, "churn")


@query
def category_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency(customer_clean(spark, sf_dir), DATASET, "subscription_type")


@query
def null_audit_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_audit(conform(customer_raw(spark, sf_dir), CHURN))


@query
def null_audit_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_audit(customer_features(spark, sf_dir).drop(DATASET))


@query
def removed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = customer_raw(spark, sf_dir)
    return row_balance(raw, customer_clean(spark, sf_dir), [DATASET])


@query
def sample_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_rows(customer_clean(spark, sf_dir), CHURN.keys)


@query
def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_features(spark, sf_dir)


@query
def float_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features after 4-byte narrowing, shown as doubles."""
    narrowed = narrow(order_line_features(spark, sf_dir), ORDER_LINES)
    shown = {c: F.col(c).cast("double") for c in (*ORDER_LINES.features, "returned")}
    return narrowed.withColumns(shown).drop("large", DATASET)


@query
def lineitem_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_line_features(spark, sf_dir)


# --- splitting and scaling -------------------------------------------------------------------


def _labelled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = (F.col("o_orderstatus") == "F").cast("int").alias("filled")
    return table(spark, sf_dir, "orders").select("o_orderkey", filled)


def _split_customers(rows: DataFrame) -> DataFrame:
    known = rows.filter(F.col(DATASET) == "train")
    return split_exact(known, CHURN.keys, CHURN.label)


@query
def split_orders_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_exact(_labelled_orders(spark, sf_dir), ["o_orderkey"], "filled")


@query
def split_orders_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_hash(_labelled_orders(spark, sf_dir), ["o_orderkey"])


@query
def split_orders_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_sizes(split_orders_exact(spark, sf_dir), ["filled"])


@query
def split_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(customer_features(spark, sf_dir), "features")
    return _split_customers(rows).select("customer_id", "churn", "split")


@query
def scaler_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(customer_features(spark, sf_dir), "features")
    training = _split_customers(rows).filter(F.col("split") == TRAIN)
    return significant(scaler_table(training, CHURN.features), ["mean", "scale"])


@query
def scaler_fit_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = scaler_table(order_line_features(spark, sf_dir), ORDER_LINES.features)
    return significant(stats, ["mean", "scale"])


@query
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customer features, scaled with the statistics of the training split."""
    rows = stored(customer_features(spark, sf_dir), "features")
    training = _split_customers(rows).filter(F.col("split") == TRAIN)
    scaled = fit_scaler(training, CHURN.features).transform(rows)
    return rounded(scaled, CHURN.features, ROW_DIGITS)


# --- drift -----------------------------------------------------------------------------------


@query
def label_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = positive_rate(customer_features(spark, sf_dir), CHURN.label, [DATASET])
    return rounded(rates, ["rate"])


def _rounded_profile(profile: DataFrame) -> DataFrame:
    return rounded(significant(profile, ["mean", "std"]), ["correlation"])


@query
def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customer_features(spark, sf_dir)
    return _rounded_profile(feature_profile(rows, CHURN.features, CHURN.label, [DATASET]))


@query
def label_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_profile(spark, sf_dir).select(DATASET, "feature", "correlation")


def _rounded_report(report: DataFrame) -> DataFrame:
    means = ["train_mean", "test_mean"]
    rest = [c for c in report.columns if c not in ("feature", *means)]
    return rounded(significant(report, means), rest)


def customer_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shift_report(customer_features(spark, sf_dir), CHURN.features, CHURN.label)


@query
def shift_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_report(customer_shift(spark, sf_dir))


@query
def shift_customers_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = largest_changes(customer_shift(spark, sf_dir), CHURN.label)
    return rounded(top, [c for c in top.columns if c != "feature"])


@query
def shift_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_line_features(spark, sf_dir)
    return _rounded_report(shift_report(rows, ORDER_LINES.features, ORDER_LINES.label))


@query
def shift_stored_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from two separate profiles, aligned by feature name."""
    rows = order_line_features(spark, sf_dir)
    sides = [
        feature_profile(
            rows.filter(F.col(DATASET) == name), ORDER_LINES.features, ORDER_LINES.label
        )
        for name in ("train", "external")
    ]
    return _rounded_report(align_profiles(*sides, ORDER_LINES.label))


# --- drift over time -------------------------------------------------------------------------


@query
def drift_profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer profile put together from the moments of 31 days, customers dealt to days by key,
    one half of the days added to the store after the other."""
    rows = stored(customer_features(spark, sf_dir), "features")
    daily = rows.withColumn("day", F.lpad((F.col("customer_id") % 31).cast("string"), 2, "0"))
    path, near = scratch_path(spark, "profiles"), origins(rows, CHURN.features)
    for half in (F.col("day") < "16", F.col("day") >= "16"):
        moments = feature_moments(
            daily.filter(half), CHURN.features, CHURN.label, ["day", DATASET], near
        )
        write_moments(moments.withColumn("day", F.concat_ws("-", DATASET, "day")), path, "day")
    store = read_moments(spark, path, "day")
    tagged = store.withColumn(DATASET, F.substring_index("day", "-", 1))
    return _rounded_profile(profile_of(merge_moments(tagged, [DATASET]), [DATASET]))


def _rounded_drift(report: DataFrame, label: str) -> DataFrame:
    means = ["train_mean", "test_mean"]
    rest = [c for c in report_numbers(label) if c not in means]
    return rounded(significant(report, means), rest)


@query
def drift_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders month by month against the profile of the first year. The job runs over the months before
    1999, then over all of them, of which it reads the later ones only, then again for nothing."""
    rows, target = monthly_orders(spark, sf_dir), scratch_path(spark, "monitor")
    first_year = rows.filter(F.col("month") < "1996")
    reference = stored(feature_profile(first_year, ORDER_FEATURES, "filled"), "reference")
    near = origins(first_year, ORDER_FEATURES)
    for part in (rows.filter(F.col("month") < "1999"), rows, rows):
        monitor_batches(part, "month", ORDER_FEATURES, "filled", reference, target, origin=near)
    return _rounded_drift(read_monitor(spark, target, "month", "filled"), "filled")


@query
def stream_drift_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream, day by day against the profile of the first week: days that the watermark
    has passed."""
    known = table(spark, sf_dir, "events")
    rows = event_rows(known)
    start = rows.agg(F.min(utc_day(F.col("time")))).scalar()
    week = rows.filter(utc_day(F.col("time")) < F.date_add(start, 7))
    reference = stored(feature_profile(week, EVENT_FEATURES, "error"), "reference")
    events = spark.readStream.schema(known.schema).parquet(f"{sf_dir}/event[s].parquet")
    target = scratch_path(spark, "drift")
    stream_drift(
        event_rows(events),
        "time",
        EVENT_FEATURES,
        "error",
        reference,
        target,
        scratch_path(spark, "drift-checkpoint"),
    ).awaitTermination()
    report = _rounded_drift(read_drift(spark, target, "error"), "error")
    day = utc_day(F.col("start")).cast("string")
    return report.select(
        day.alias("day"), "feature", "row_count", *report_numbers("error"), "drifted"
    )


# --- scoring and metrics ---------------------------------------------------------------------


def _customer_scores(spark: SparkSession, sf_dir: str, form: str) -> DataFrame:
    rows = stored(customer_features(spark, sf_dir), "features")
    scaler = fit_scaler(rows.filter(F.col(DATASET) == "train"), CHURN.features)
    return score(rows, rule_model(scaler), CHURN.label, form)


def _lineitem_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines scored by a fixed logistic rule, ``returned`` as label."""
    logit = (F.col("l_quantity") - 25) / 10 - F.col("l_discount") * 5
    return order_lines(spark, sf_dir).select(
        "l_linestatus",
        "l_linenumber",
        F.col("returned"),
        F.col("large"),
        logit.alias("logit"),
        (F.col("l_discount") >= 0.05).cast("int").alias("prediction"),
    )


SCORES = ["logit", "probability", "loss"]


@query
def mlp_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_customer_scores(spark, sf_dir, "udf"), SCORES, ROW_DIGITS)


@query
def mlp_score_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_customer_scores(spark, sf_dir, "sql"), SCORES, ROW_DIGITS)


@query
def mlp_score_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_line_features(spark, sf_dir).drop("large", DATASET)
    scaler = fit_scaler(rows, ORDER_LINES.features)
    return rounded(score(rows, rule_model(scaler), ORDER_LINES.label), SCORES, ROW_DIGITS)


@query
def prediction_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual and predicted positive rate per dataset."""
    scored = _customer_scores(spark, sf_dir, "udf")
    rates = scored.groupBy(DATASET).agg(
        F.avg("churn").alias("actual_rate"), F.avg("prediction").alias("predicted_rate")
    )
    return rounded(rates, ["actual_rate", "predicted_rate"])


@query
def confusion_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_matrix(
        _lineitem_scores(spark, sf_dir), "returned", "prediction", ["l_linestatus"]
    )


@query
def threshold_metrics_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = threshold_metrics(
        _lineitem_scores(spark, sf_dir), "returned", "prediction", ["l_linestatus"]
    )
    return rounded(metrics, ["accuracy", "precision", "recall", "f1"])


@query
def balanced_accuracy_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = balanced_accuracy(
        _lineitem_scores(spark, sf_dir), "returned", "prediction", ["l_linestatus"]
    )
    return rounded(metrics, ["balanced_accuracy"])


def _event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a coarse score: many ties."""
    return table(spark, sf_dir, "events").select(
        (F.floor("value") / F.lit(400.0)).alias("score"),
        (F.col("event_type") == "error").cast("int").alias("error"),
        F.dayofmonth("ts").alias("day"),
    )


@query
def roc_auc_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        ranking_metrics(_event_scores(spark, sf_dir), "error", "score").select("roc_auc"),
        ["roc_auc"],
    )


@query
def average_precision_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranking_metrics(_event_scores(spark, sf_dir), "error", "score")
    return rounded(ranked.select("average_precision"), ["average_precision"])


@query
def ranking_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly distinct scores, per group."""
    ranked = ranking_metrics(
        order_lines(spark, sf_dir), "large", "l_extendedprice", ["l_linestatus"]
    )
    return rounded(ranked, ["roc_auc", "average_precision"])


@query
def bce_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _lineitem_scores(spark, sf_dir)
    loss = cross_entropy(F.col("logit"), F.col("returned"))
    return rounded(mean_loss(scored.withColumn("loss", loss), by=["l_linestatus"]), ["loss"])


def _lineitem_evaluation(spark: SparkSession, sf_dir: str, by: Sequence[str]) -> DataFrame:
    scored = _lineitem_scores(spark, sf_dir).withColumns(
        {
            "probability": sigmoid(F.col("logit")),
            "loss": cross_entropy(F.col("logit"), F.col("large")),
        }
    )
    return evaluate(scored, "large", by)


@query
def evaluation_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _lineitem_evaluation(spark, sf_dir, ["l_linestatus"])
    return rounded(report, [*METRICS, "balanced_accuracy"])


@query
def evaluation_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _customer_scores(spark, sf_dir, "udf")
    return rounded(evaluate(scored, CHURN.label, [DATASET]), [*METRICS, "balanced_accuracy"])


@query
def best_threshold_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logit from which on ``large`` is predicted with the highest F1."""
    best = best_threshold(_lineitem_scores(spark, sf_dir), "large", "logit", ["l_linestatus"])
    return rounded(best, ["threshold", "accuracy", "precision", "recall", "f1"])


@query
def mlp_score_tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions at the threshold that is best for the training customers, stored with the model and
    loaded again. Probabilities are compared to six digits."""
    rows = stored(customer_features(spark, sf_dir), "features")
    training = rows.filter(F.col(DATASET) == "train")
    model = rule_model(fit_scaler(training, CHURN.features))
    scored = rounded(score(training, model, CHURN.label), ["probability"], ROW_DIGITS)
    path = save_model(spark, tuned(model, scored, CHURN.label), scratch_path(spark, "model"))
    predicted = score(rows, load_model(spark, path), CHURN.label)
    return predicted.select("customer_id", DATASET, "churn", "prediction")


CURVE_STEPS = 50


def _event_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_points(_event_scores(spark, sf_dir), "error", "score", steps=CURVE_STEPS)


@query
def roc_points_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = ["false_positive_rate", "true_positive_rate"]
    points = _event_curve(spark, sf_dir).select("point", "threshold", "tn", "fp", "fn", "tp", *rates)
    return rounded(points, ["threshold", *rates])


@query
def pr_points_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _event_curve(spark, sf_dir).select("point", "threshold", "precision", "recall")
    return rounded(points, ["threshold", "precision", "recall"])


# --- runs ------------------------------------------------------------------------------------


@query
def best_epoch_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line status stands for the run, line number for the epoch."""
    history = threshold_metrics(
        _lineitem_scores(spark, sf_dir), "large", "prediction", ["l_linestatus", "l_linenumber"]
    ).withColumnRenamed("l_linenumber", "epoch")
    return rounded(best_epoch(history, ["l_linestatus"]), ["best_f1"])


@query
def metrics_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _lineitem_evaluation(spark, sf_dir, ["l_linestatus"])
    long = metrics_long(report.withColumnRenamed("l_linestatus", "split"), RUN_ID)
    return rounded(metrics_flat(long), ["value"])


@query
def run_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = split_sizes(split_orders_exact(spark, sf_dir))
    return run_params(spark, sizes, RUN_ID, parameters_of(TrainConfig(), CHURN))


@query
def run_tags_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift = drift_detected(customer_shift(spark, sf_dir), DRIFT_TOLERANCE)
    return run_tags(drift, RUN_ID, {"task": "binary_classification", "target": "customer_churn"})


# --- training --------------------------------------------------------------------------------


def _trained(rows: DataFrame, spec: DatasetSpec, least_auc: float) -> DataFrame:
    """Rows tagged train/external -> per evaluated split its rows, positives, and whether the model
    ranks it better than ``least_auc``."""
    table_rows = stored(rows, "features")
    known = table_rows.filter(F.col(DATASET) == "train").drop(DATASET)
    external = table_rows.filter(F.col(DATASET) == "external").drop(DATASET)
    evaluation = train_and_evaluate(known, external, spec, TrainConfig()).evaluation
    return evaluation.select(
        "split",
        "row_count",
        (F.col("tp") + F.col("fn")).alias("positives"),
        (F.col("roc_auc") > least_auc).alias("learned"),
    )


@query
def train_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the training split of the known customers, evaluate on the other three sets. A few
    thousand rows are a few steps of the optimiser, so the bar is what the first steps learn."""
    return _trained(customer_features(spark, sf_dir), CHURN, 0.6)


def _large_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DatasetSpec]:
    """Order lines with a label that follows from the features."""
    rows = order_line_features(spark, sf_dir).drop("returned")
    labelled = rows.withColumn("large", F.col("large").cast("double"))
    return labelled, replace(ORDER_LINES, label="large")


@query
def train_mlp_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, spec = _large_lines(spark, sf_dir)
    return _trained(rows, spec, 0.9)


@query
def training_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the shards and slices of the training rows hold together, and how many there are."""
    rows, spec = _large_lines(spark, sf_dir)
    known = stored(rows.filter(F.col(DATASET) == "train").drop(DATASET), "known")
    config = TrainConfig()
    shards = shard_rows(known, spec.keys, fit_scaler(known, spec.features), spec.label, config)
    sums = shards.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("shard", "slice").alias("parts"),
        F.sum("large").cast("bigint").alias("positives"),
        *[
            # standardised, so their sum is 0 and the sum of squares is the number of rows
            F.round(F.sum(F.col(c).cast("double")) / F.count(F.lit(1)), 3).alias(f"mean_{c}")
            for c in spec.features
        ],
    )
    return sums.withColumns({f"mean_{c}": F.abs(f"mean_{c}") for c in spec.features})


@query
def mlp_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gradient of the rule model over all customers: one number per parameter."""
    rows = stored(customer_features(spark, sf_dir), "features")
    model = rule_model(fit_scaler(rows.filter(F.col(DATASET) == "train"), CHURN.features))
    return rounded(full_gradient(rows, model, CHURN.label), ["gradient"])


@query
def epoch_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking metrics of three sets of weights from rows that are scored once by all of them."""
    rows = order_line_features(spark, sf_dir)
    scaler = rule_model(fit_scaler(rows, ORDER_LINES.features)).scaler
    inputs = len(scaler.features) + 1
    snapshots = [[((i * 7 + epoch * 3) % 11 - 5) / 10 for i in range(inputs)] for epoch in (1, 2, 3)]
    scored = score_epochs(rows, snapshots, (inputs - 1, 1), scaler, "large", digits=ROW_DIGITS)
    ranked = ranking_metrics(scored, "large", "logit", ["epoch"], cut_by_group=True)
    return rounded(ranked, ["roc_auc", "average_precision"])


@query
def epoch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training that stops after its first epoch and is started again for two more: the rows of its
    epochs, and whether the model ranks the external lines better than by chance after each."""
    rows, spec = _large_lines(spark, sf_dir)
    table_rows = stored(rows, "features")
    known = table_rows.filter(F.col(DATASET) == "train").drop(DATASET)
    external = table_rows.filter(F.col(DATASET) == "external").drop(DATASET)
    scaler, config = fit_scaler(known, spec.features), TrainConfig(epochs=3, batch_size=256)
    shards, log = shard_rows(known, spec.keys, scaler, spec.label, config), scratch_path(spark, "log")
    for epochs in (1, 3):
        train_logged(shards, external, scaler, spec.label, replace(config, epochs=epochs), log)
    done, positives = read_epochs(spark, log), F.col("tp") + F.col("fn")
    return done.select(
        "epoch",
        "row_count",
        positives.alias("positives"),
        (F.col("roc_auc") > 0.6).alias("learned"),
        (F.col("average_precision") > positives / F.col("row_count")).alias("precise"),
    )


# --- sources and sinks -----------------------------------------------------------------------


@query
def features_limited_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written to at most four files and loaded through the contract."""
    rows = customer_features(spark, sf_dir)
    path = write_parquet(rows, scratch_path(spark, "features"), files=4)
    return load_features(spark, path, CHURN, keep=[DATASET])


@query
def shift_report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shift report through its CSV file."""
    report = customer_shift(spark, sf_dir)
    path = write_report_csv(report, scratch_path(spark, "report"))
    return _rounded_report(spark.read.schema(report.schema).option("header", True).csv(path))


@query
def metrics_document_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation through the metrics document; line status stands for the split."""
    report = _lineitem_evaluation(spark, sf_dir, ["l_linestatus"])
    split = F.when(F.col("l_linestatus") == "F", "validation").otherwise("internal_test")
    evaluated = report.withColumn("split", split)
    sizes = evaluated.select("split", "row_count")
    parameters = parameters_of(TrainConfig(), CHURN)
    document = metrics_document(spark, evaluated, sizes, parameters, best_epoch=1)
    path = write_document(document, scratch_path(spark, "metrics"))
    return rounded(document_metrics(read_document(spark, path)), METRICS)


@query
def mlp_score_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a model that was saved and loaded again."""
    rows = stored(customer_features(spark, sf_dir), "features")
    model = rule_model(fit_scaler(rows.filter(F.col(DATASET) == "train"), CHURN.features))
    loaded = load_model(spark, save_model(spark, model, scratch_path(spark, "model")))
    return rounded(score(rows, loaded, CHURN.label), SCORES, ROW_DIGITS)


@query
def verified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read back after each stage was written."""
    stages = {"clean": customer_clean(spark, sf_dir), "features": customer_features(spark, sf_dir)}
    counts = []
    for name, rows in stages.items():
        path = write_parquet(rows, scratch_path(spark, name))
        counts.append((name, verify_rows(rows, path, rows.count())))
    return spark.createDataFrame(counts, "stage string, row_count bigint")


@query
def split_composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact split on a key of two texts, whose parts hold the separator and NULL."""
    orders = table(spark, sf_dir, "orders")
    priority = F.when(F.col("o_orderkey") % 5 > 0, F.concat(F.lit("a:"), "o_orderpriority"))
    rows = orders.select(
        "o_orderkey",
        priority.alias("first"),
        F.concat_ws(":", F.lit("b"), "o_orderkey").alias("second"),
        (F.col("o_orderstatus") == "F").cast("int").alias("filled"),
    )
    return split_exact(rows, ["first", "second"], "filled").select("o_orderkey", "filled", "split")


@query
def verified_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the training customers are replaced by those of all; a third replacement, which
    promises more rows than it has, fails and leaves the second in use."""
    rows, path = stored(customer_features(spark, sf_dir), "features"), scratch_path(spark, "table")
    training = rows.filter(F.col(DATASET) == "train")
    replace_verified(training, path)
    replace_verified(rows, path, rows.count())
    try:
        replace_verified(training, path, rows.count() + 1)
    except RuntimeError:
        pass
    else:
        raise AssertionError("a replacement that is not complete went through")
    return read_current(spark, path)


@query
def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stages of ingestion from CSV to features for each dataset, with the rows they counted on the
    way and in the files."""
    raw, root, reports = customer_raw(spark, sf_dir), scratch_path(spark, "ingest"), []
    for name in ("train", "external"):
        part = raw.filter(F.col(DATASET) == name).drop(DATASET)
        part.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).csv(f"{root}/raw-{name}")
        cleaned = run_clean(spark, f"{root}/raw-{name}", f"{root}/clean-{name}", CHURN)
        made = run_features(spark, f"{root}/clean-{name}", f"{root}/features-{name}", CHURN, files=8)
        reports.append(
            (
                name,
                cleaned.raw_rows,
                cleaned.cleaned_rows,
                cleaned.removed_rows,
                cleaned.verified_rows,
                made.feature_rows,
                made.verified_rows,
                sum(made.null_rows.values()),
            )
        )
    columns = "raw_rows cleaned_rows removed_rows verified_rows feature_rows verified_features null_rows"
    schema = f"{DATASET} string, {', '.join(f'{c} bigint' for c in columns.split())}"
    return spark.createDataFrame(reports, schema)


@query
def shift_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest changes as the command line prints them."""
    return displayed(largest_changes(customer_shift(spark, sf_dir), CHURN.label))
