"""Exact ranking metrics and threshold choice over distinct scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowvigil.operators.ordering import running_totals
from flowvigil.staging import Staging

# Denominator guard of the threshold search.
GUARD = 1e-9


def score_counts(scored: DataFrame, score: str = "p_cal", label: str = "y_bin") -> DataFrame:
    """Attack and normal rows per distinct score; a missing score counts as 0."""
    value = F.nanvl(F.coalesce(F.col(score).cast("double"), F.lit(0.0)), F.lit(0.0))
    attack = (F.col(label) == 1).cast("bigint")
    return scored.groupBy(value.alias("score")).agg(
        F.sum(attack).alias("pos"), F.sum(1 - attack).cast("bigint").alias("neg")
    )


def curve(
    scored: DataFrame, staging: Staging, score: str = "p_cal", label: str = "y_bin"
) -> DataFrame:
    """One row per distinct score: the confusion counts of "at least this score is an attack"."""
    counts = staging.table(score_counts(scored, score, label), "score-counts")
    sums = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    ranked = running_totals(
        counts, [F.col("score").desc()], {"tp": "pos", "fp": "neg"}, staging, "score-curve"
    )
    positives, negatives = sums.select("p").scalar(), sums.select("n").scalar()
    rows = ranked.withColumns(
        {"fn": positives - F.col("tp"), "tn": negatives - F.col("fp")}
    ).withColumnRenamed("score", "threshold")
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return rows.withColumns(
        {
            "precision": tp / (tp + fp),
            "recall": _share(tp, fn),
            "fpr": _share(fp, tn),
        }
    )


def _share(part: Column, rest: Column) -> Column:
    return F.try_divide(part.cast("double"), (part + rest).cast("double"))


def roc_auc(points: DataFrame) -> DataFrame:
    """Area under the ROC curve; tied scores count half. NULL when one class is absent."""
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return points.agg(F.try_divide(area, pairs).alias("roc_auc"))


def average_precision(points: DataFrame) -> DataFrame:
    """Area under the precision-recall curve as a step function."""
    steps = F.sum(F.col("pos") * F.col("precision"))
    return points.agg(F.try_divide(steps, F.sum("pos").cast("double")).alias("average_precision"))


def confusion(
    scored: DataFrame, threshold: float, score: str = "p_cal", label: str = "y_bin",
    inclusive: bool = True,
) -> DataFrame:
    """One row: the confusion counts at a threshold."""
    value = F.col(score)
    hit = value >= threshold if inclusive else value > threshold
    truth = F.col(label) == 1

    def rows(test: Column) -> Column:
        return F.count_if(test)

    return scored.agg(
        rows(truth & hit).alias("tp"),
        rows(~truth & hit).alias("fp"),
        rows(truth & ~hit).alias("fn"),
        rows(~truth & ~hit).alias("tn"),
    )


def pick_threshold(
    points: DataFrame, precision_target: float | None = None, fpr_target: float | None = None
) -> DataFrame:
    """The threshold with the most recall among those that meet both targets.

    Ties go to the higher precision, then to the lower threshold. When no threshold
    qualifies, the one with the highest F1 is taken, ties to the lower threshold. One row.
    A threshold of 1 that no score reaches finds nothing, so it never wins.
    """
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall, fpr = tp / (tp + fp + GUARD), tp / (tp + fn + GUARD), fp / (fp + tn + GUARD)
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + GUARD)
    meets = tp > 0
    if precision_target is not None:
        meets &= precision >= precision_target
    if fpr_target is not None:
        meets &= fpr <= fpr_target
    found = F.struct(
        F.col("threshold"), precision.alias("precision"), recall.alias("recall"), fpr.alias("fpr")
    )
    lower_first = -F.col("threshold")
    best = points.agg(
        F.max_by(found, F.when(meets, F.struct(recall, precision, lower_first))).alias("targeted"),
        F.max_by(found, F.struct(F.coalesce(f1, F.lit(-1.0)), lower_first)).alias("fallback"),
    )
    return best.select(F.coalesce("targeted", "fallback").alias("best")).select("best.*")
