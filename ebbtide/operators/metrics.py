"""Threshold metrics, ranking metrics, loss; per group, from one aggregate by score.

Rows are first counted per ``(group, score)``, with partial aggregation before the exchange, so a
score shared by a third of the rows is one row afterwards. The cumulative counts that ranking
metrics need run inside score ranges cut at approximate quantiles, offset by the totals of the
ranges above: no single-task sort, and exact whatever the quantiles are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.columns import decision, ratio, ratio_or_zero, upper_bound_index

# The metrics of one evaluation, in report order.
METRICS = ("loss", "accuracy", "precision", "recall", "f1", "roc_auc", "average_precision")


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """tn, fp, fn, tp for labels 0 and 1; an absent class counts 0."""
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def threshold_columns() -> dict[str, Column]:
    """Metrics of a confusion matrix; 0 on a zero denominator."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return {
        "accuracy": ratio_or_zero(tp + tn, tn + fp + fn + tp),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    }


def balanced_accuracy_column() -> Column:
    """Mean recall over the classes that occur."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    positive, negative = ratio(tp, tp + fn), ratio(tn, tn + fp)
    return (F.coalesce(positive, negative) + F.coalesce(negative, positive)) / 2


def threshold_metrics(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    counts = confusion_matrix(df, label, prediction, by)
    return counts.withColumns(threshold_columns())


def balanced_accuracy(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    counts = confusion_matrix(df, label, prediction, by)
    return counts.select(*by, balanced_accuracy_column().alias("balanced_accuracy"))


def mean_loss(df: DataFrame, loss: str = "loss", by: Sequence[str] = ()) -> DataFrame:
    """Row-weighted mean of the per-row loss."""
    return df.groupBy(*by).agg(F.avg(loss).alias("loss"))


def _ranges(df: DataFrame) -> int:
    """Number of score ranges: the next power of two from the session's shuffle width, so that
    ranges get smaller with the cluster that sorts them."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, 1 << (width - 1).bit_length())


def cumulative_counts(
    df: DataFrame,
    label: str,
    score: str,
    by: Sequence[str] = (),
    sums: Sequence[Column] = (),
    ranges: int | None = None,
    cut_by_group: bool = False,
) -> DataFrame:
    """One row per distinct score: its positives and negatives, and ``tp``/``fp`` counted over
    all scores at least as high. ``sums`` are further aggregates per score. ``ranges``, a power of
    two, sets how many parts are sorted side by side; the result does not depend on it. Ranges are cut
    at quantiles of all scores, or, for few groups whose scores differ, at those of each group.

    The group columns come back as one struct ``group``; structs compare equal on NULL fields,
    so rows of a NULL group are not lost in the join.
    """
    y, ranked_by = F.col(label).cast("bigint"), F.col(score).cast("double")
    # a row that cannot be ranked is an error, not a row less
    unranked = y.isNull() | ranked_by.isNull() | F.isnan(ranked_by)
    problem = F.raise_error(F.lit(f"NULL or NaN in {label} or {score}")).cast("double")
    group = F.struct(*by) if by else F.lit(0)
    rows = df.withColumn("_score", F.when(unranked, problem).otherwise(ranked_by))
    scores = rows.groupBy(group.alias("group"), F.col("_score").alias("score")).agg(
        F.sum(y).alias("positives"), F.sum(1 - y).alias("negatives"), *sums
    )
    n = ranges or _ranges(df)
    # The bounds ask for every column of ``scores``: then the aggregate below them is the same one
    # as in the rest of the plan, and its exchange runs once.
    quantiles = F.percentile_approx("score", [i / n for i in range(1, n)], 4 * n)
    others = [F.max(c).alias(c) for c in scores.columns if c not in ("group", "score")]
    if cut_by_group:
        bounds = scores.groupBy("group").agg(quantiles.alias("_bounds"))
        bounded = scores.join(bounds, "group")
    else:
        bounds = scores.agg(F.struct(quantiles.alias("bounds"), *others)).scalar()["bounds"]
        bounded = scores.select("*", bounds.alias("_bounds"))
    # each search step refers to the alias of the one before
    steps = upper_bound_index(F.col("score"), F.col("_bounds"), n)
    searched = bounded.select("*", *[c.alias(name) for name, c in steps])
    placed = searched.select(*scores.columns, F.col(steps[-1][0]).alias("range"))

    totals = placed.groupBy("group", "range").agg(
        F.sum("positives").alias("_p"), F.sum("negatives").alias("_n")
    )
    # at most n rows per group
    above = (
        Window.partitionBy("group")
        .orderBy(F.col("range").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        "group",
        "range",
        F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_tp0"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_fp0"),
    )
    down = Window.partitionBy("group", "range").orderBy(F.col("score").desc())
    within = placed.withColumns(
        {"_tp": F.sum("positives").over(down), "_fp": F.sum("negatives").over(down)}
    )
    return (
        within.join(offsets, ["group", "range"])
        .withColumns({"tp": F.col("_tp") + F.col("_tp0"), "fp": F.col("_fp") + F.col("_fp0")})
        .drop("_tp", "_fp", "_tp0", "_fp0", "range")
    )


def _ranking_sums() -> list[Column]:
    p, n = F.col("positives").cast("double"), F.col("negatives").cast("double")
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    return [
        F.sum("positives").alias("_p"),
        F.sum("negatives").alias("_n"),
        # pairs ranked right: higher positives count 1, tied ones 1/2
        F.sum(n * (tp - p / 2)).alias("_pairs"),
        # recall gained at this score, times the precision there
        F.sum(p * F.try_divide(tp, tp + fp)).alias("_steps"),
    ]


def _ranking_columns() -> dict[str, Column]:
    """AUC is NULL unless both classes occur; average precision is 0 without positives."""
    p, n = F.col("_p").cast("double"), F.col("_n").cast("double")
    return {
        "roc_auc": F.try_divide(F.col("_pairs"), p * n),
        "average_precision": ratio_or_zero(F.col("_steps"), p),
    }


def ranking_metrics(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), cut_by_group: bool = False
) -> DataFrame:
    """ROC AUC (ties count one half) and average precision (step form)."""
    counts = cumulative_counts(df, label, score, by, cut_by_group=cut_by_group)
    metrics = [c.alias(k) for k, c in _ranking_columns().items()]
    grouped = counts.groupBy("group") if by else counts.groupBy()
    return grouped.agg(*_ranking_sums()).select(*[f"group.{c}" for c in by], *metrics)


def evaluate(
    scored: DataFrame,
    label: str,
    by: Sequence[str] = ("split",),
    probability: str = "probability",
    loss: str = "loss",
    threshold: float = 0.5,
    cut_by_group: bool = False,
) -> DataFrame:
    """All metrics of a scored table per group: row count, the confusion matrix, the metrics of
    ``METRICS`` and balanced accuracy, from one pass over the rows."""
    losses = [F.sum(loss).alias("_loss")]
    counts = cumulative_counts(scored, label, probability, by, losses, cut_by_group=cut_by_group)
    p, n, hit = F.col("positives"), F.col("negatives"), decision(F.col("score"), threshold)
    grouped = counts.groupBy("group") if by else counts.groupBy()
    total = grouped.agg(
        F.sum(p + n).alias("row_count"),
        F.sum(n * (1 - hit)).alias("tn"),
        F.sum(n * hit).alias("fp"),
        F.sum(p * (1 - hit)).alias("fn"),
        F.sum(p * hit).alias("tp"),
        F.sum("_loss").alias("_loss"),
        *_ranking_sums(),
    )
    columns = {
        "loss": ratio(F.col("_loss"), F.col("row_count")),
        **threshold_columns(),
        **_ranking_columns(),
    }
    return total.select(
        *[f"group.{c}" for c in by],
        "row_count",
        "tn",
        "fp",
        "fn",
        "tp",
        *[columns[m].alias(m) for m in METRICS],
        balanced_accuracy_column().alias("balanced_accuracy"),
    )


def best_epoch(history: DataFrame, by: Sequence[str] = (), metric: str = "f1") -> DataFrame:
    """Epoch with the highest metric, the earliest one on ties, per run."""
    rank = F.struct(F.col(metric), -F.col("epoch"))
    return history.groupBy(*by).agg(
        F.max_by("epoch", rank).alias("best_epoch"), F.max(metric).alias(f"best_{metric}")
    )
