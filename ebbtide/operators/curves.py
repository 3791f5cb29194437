"""Decision thresholds and curve points, from the cumulative counts of the ranking metrics.

Both look at every distinct score. What is kept of a group is one row (the best threshold) or a bounded
number of them (the points of a curve), picked by aggregates that combine on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.columns import ratio
from ebbtide.operators.metrics import cumulative_counts, threshold_columns
from ebbtide.operators.score import Model


def _with_totals(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Cumulative counts with the positives ``_p`` and negatives ``_n`` of the whole group. The counts of
    both sides of the join share one exchange."""
    counts = cumulative_counts(df, label, score, by)
    totals = counts.groupBy("group").agg(F.max("tp").alias("_p"), F.max("fp").alias("_n"))
    return counts.join(totals, "group")


def _matrix() -> dict[str, Column]:
    """The confusion matrix of predicting positive from a score on."""
    return {
        "tn": F.col("_n") - F.col("fp"),
        "fp": F.col("fp"),
        "fn": F.col("_p") - F.col("tp"),
        "tp": F.col("tp"),
    }


def _named(by: Sequence[str]) -> list[Column]:
    return [F.col(f"group.{c}").alias(c) for c in by]


def best_threshold(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per group the score from which on predicting positive gives the highest F1, with the confusion
    matrix and metrics there. Of equal F1 the highest score is taken: it predicts fewest positives. A
    group with one class only has no best threshold: NULL, with its counts."""
    both = (F.col("_p") > 0) & (F.col("_n") > 0)
    f1 = ratio(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("_p"))
    rows = _with_totals(df, label, score, by).withColumn("_f1", f1)
    best = rows.groupBy("group").agg(
        F.max_by(F.struct("score", "tp", "fp", "_p", "_n"), F.struct("_f1", "score")).alias("_best")
    )
    matrix = {k: F.when(both, c) for k, c in _matrix().items()}
    flat = best.select("group", "_best.*")
    chosen = flat.select(
        *_named(by),
        F.when(both, F.col("score")).alias("threshold"),
        F.col("_p").alias("positives"),
        F.col("_n").alias("negatives"),
        *[c.alias(k) for k, c in matrix.items()],
    )
    known = F.col("threshold").isNotNull()
    return chosen.withColumns({k: F.when(known, c) for k, c in threshold_columns().items()})


def tuned(model: Model, scored: DataFrame, label: str, score: str = "probability") -> Model:
    """The model with the decision threshold that is best on ``scored`` rows (of the validation split,
    not of a test split). It is stored with the model and used in scoring. Unchanged where the rows hold
    one class only."""
    threshold = best_threshold(scored, label, score).first()
    if threshold is None or threshold["threshold"] is None:
        return model
    return replace(model, threshold=threshold["threshold"])


def curve_points(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), steps: int = 100
) -> DataFrame:
    """Points of the ROC and the precision-recall curve with the confusion matrix at each.

    The unit square is cut into ``steps`` x ``steps`` cells of equal steps of true and false positives. A
    curve only rises, so it meets at most 2 steps + 1 of them; of each the first and the last point are
    kept, and the corner before the highest score (threshold NULL, precision 1). Between the two it stays
    in the cell, so the area below straight lines through the points is off by at most half a cell each:
    less than 1/steps + 1/(2 steps^2) in all. Long straight pieces, as ties give them, start and end at
    kept points. ``point`` counts from 0 by falling threshold; with one class only, rates are NULL.
    """
    rows = _with_totals(df, label, score, by)
    cells = {
        f"_{c}": F.when(F.col(total) > 0, F.floor(ratio(F.col(c) * steps, F.col(total)))).otherwise(0)
        for c, total in (("tp", "_p"), ("fp", "_n"))
    }
    seen = F.col("tp") + F.col("fp")
    point = F.struct(F.col("score").alias("threshold"), "tp", "fp", "_p", "_n")
    ends = (
        rows.withColumns({**cells, "_at": point})
        .groupBy("group", "_tp", "_fp")
        .agg(F.min_by("_at", seen).alias("_low"), F.max_by("_at", seen).alias("_high"))
    )
    kept = ends.select("group", F.inline(F.array_distinct(F.array("_low", "_high"))))
    # every group has a last point, where all rows are predicted positive
    zero = F.lit(0).cast("bigint")
    corner = kept.filter((F.col("tp") == F.col("_p")) & (F.col("fp") == F.col("_n"))).withColumns(
        {"threshold": F.lit(None).cast("double"), "tp": zero, "fp": zero}
    )
    order = Window.partitionBy("group").orderBy(seen)  # a bounded number of points
    numbered = kept.unionByName(corner).withColumn("point", F.row_number().over(order) - 1)
    return numbered.select(
        *_named(by),
        "point",
        "threshold",
        *[c.alias(k) for k, c in _matrix().items()],
        ratio(F.col("fp"), F.col("_n")).alias("false_positive_rate"),
        ratio(F.col("tp"), F.col("_p")).alias("true_positive_rate"),
        F.coalesce(ratio(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(1.0)).alias("precision"),
        ratio(F.col("tp"), F.col("_p")).alias("recall"),
    )


def area_below(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area below straight lines through ROC points."""
    before = Window.partitionBy(*by).orderBy("point") if by else Window.orderBy("point")
    x, y = F.col("false_positive_rate"), F.col("true_positive_rate")
    strip = (x - F.lag(x).over(before)) * (y + F.lag(y).over(before)) / 2
    return points.select(*by, strip.alias("strip")).groupBy(*by).agg(F.sum("strip").alias("area"))
