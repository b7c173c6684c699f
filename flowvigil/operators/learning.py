"""Boosted-tree training per fold, calibration and ensemble scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, functions as F

from flowvigil.operators import evaluation
from flowvigil.operators.alerts import with_prediction
from flowvigil.operators.folds import fold_split, type_weights, with_type_weight
from flowvigil.staging import Staging


#: Training rows for each task of a round.
ROWS_A_TASK = 100_000
#: Folds train side by side while their rounds have no more than so many tasks for each core.
TASKS_A_CORE = 4


@dataclass(frozen=True)
class TrainConfig:
    """Tree ensemble settings; depth 6 gives up to 64 leaves."""

    # Rounds, depth, rate, shares, leaf size and seed.
    rounds: int = 1200
    depth: int = 6
    learning_rate: float = 0.05
    row_share: float = 0.7
    column_share: float = 0.8
    min_leaf_rows: int = 40
    seed: int = 42
    # Rounds without a lower validation loss after which training ends.
    patience: int = 100


def assemble(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(rows)


def with_sample_weight(rows: DataFrame, label: str = "y_bin") -> DataFrame:
    """``weight``: class balance times the type weight when there is one."""
    positive = F.col(label) == 1
    sums = rows.agg(F.count("*").alias("n"), F.count_if(positive).alias("p"))
    total, attacks = sums.select("n").scalar(), sums.select("p").scalar()
    balance = F.when(positive, F.try_divide(total, 2.0 * attacks)).otherwise(
        F.try_divide(total, 2.0 * (total - attacks))
    )
    extra = F.col("type_weight") if "type_weight" in rows.columns else F.lit(1.0)
    return rows.withColumn("weight", balance * extra)


def weighted_split(rows: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Rows that train the model of a fold, with their weight, and the rows of the fold.

    ``rows`` carry ``features``, ``y_bin``, ``fold`` and optionally ``type_weight``, or ``attack_type``:
    then type weights are counted on the training rows alone, so validation rows don't shape them.
    """
    train, held_out = fold_split(rows, fold)
    if "attack_type" in rows.columns and "type_weight" not in rows.columns:
        labelled = train.withColumn("label", F.when(F.col("y_bin") == 1, "attack").otherwise("normal"))
        train = with_type_weight(labelled, type_weights(labelled)).drop("label")
    return with_sample_weight(train), held_out.withColumn("weight", F.lit(1.0))


@dataclass(frozen=True)
class TrainedFold:
    """The model up to its best round, and the validation loss after every round until training ended."""

    model: GBTClassificationModel
    losses: tuple[float, ...]


def stopped(losses: Sequence[float], patience: int) -> tuple[int, int]:
    """Best round and last round (both counted from 1) of training that ends ``patience`` rounds after the best one."""
    best = 0
    for at, loss in enumerate(losses):
        if loss < losses[best]:
            best = at
        elif at - best >= patience:
            return best + 1, at + 1
    return best + 1, len(losses)


def train_fold(rows: DataFrame, fold: int, cfg: TrainConfig = TrainConfig()) -> TrainedFold:
    """Model trained on all other folds (see ``weighted_split``), stopped early by this one.

    A round draws its rows by the seed and its number, so a longer run repeats a shorter one: runs are
    lengthened until one reaches past the end of patience, and the first rounds of it make the model.
    """
    tasks = 1 + rows.count() // ROWS_A_TASK
    if rows.rdd.getNumPartitions() < tasks:
        # By values, as dealing in turn sorts each split first.
        rows = rows.repartition(tasks, *rows.columns)
    train, held_out = weighted_split(rows, fold)
    # A round has several jobs, so few rows are faster in few tasks.
    train, held_out = train.coalesce(tasks).persist(), held_out.coalesce(tasks).persist()
    if held_out.isEmpty():
        raise ValueError(f"fold {fold} has no rows")
    learner = GBTClassifier(
        featuresCol="features",
        labelCol="y_bin",
        weightCol="weight",
        maxDepth=cfg.depth,
        stepSize=cfg.learning_rate,
        subsamplingRate=cfg.row_share,
        featureSubsetStrategy=str(cfg.column_share),
        minInstancesPerNode=cfg.min_leaf_rows,
        seed=cfg.seed,
    )
    upto = min(cfg.rounds, cfg.patience + 1)
    while True:
        model = learner.setMaxIter(upto).fit(train)
        losses = model.evaluateEachIteration(held_out)
        best, last = stopped(losses, cfg.patience)
        if last < upto or last - best >= cfg.patience or upto >= cfg.rounds:
            break
        upto = min(cfg.rounds, 2 * upto)
    train.unpersist()
    held_out.unpersist()
    return TrainedFold(first_rounds(model, best), tuple(losses[:last]))


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model after its first ``rounds``."""
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    trees, weights = java.trees(), java.treeWeights()
    kept = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weight = gateway.new_array(gateway.jvm.double, rounds)
    for at in range(rounds):
        kept[at], weight[at] = trees[at], weights[at]
    short = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), kept, weight, java.numFeatures(), java.numClasses()
    )
    java.copyValues(short, java.extractParamMap())
    return GBTClassificationModel(short)


def train_folds(rows: DataFrame, k: int, cfg: TrainConfig = TrainConfig()) -> list[TrainedFold]:
    """The folds' models, trained side by side: a small round leaves most of a cluster idle.

    Rounds that fill the cluster train one fold after the other, so only one fold's rows are held at a time.
    """
    tasks = 1 + rows.count() // ROWS_A_TASK
    cores = rows.sparkSession.sparkContext.defaultParallelism
    with ThreadPoolExecutor(max(1, min(k, TASKS_A_CORE * cores // tasks))) as pool:
        work = [pool.submit(inheritable_thread_target(rows.sparkSession)(train_fold), rows, fold, cfg) for fold in range(k)]
        return [x.result() for x in work]


def _probability(model: GBTClassificationModel, rows: DataFrame, name: str) -> DataFrame:
    scored = model.transform(rows)
    return scored.withColumn(name, vector_to_array("probability")[1]).drop(
        "rawPrediction", "probability", "prediction"
    )


def out_of_fold(rows: DataFrame, models: Sequence[GBTClassificationModel]) -> DataFrame:
    """Every row scored by the model that did not see its host."""
    parts = [
        _probability(model, rows.where(F.col("fold") == fold), "p_raw")
        for fold, model in enumerate(models)
    ]
    return reduce(DataFrame.unionByName, parts)


def fold_metrics(scored: DataFrame, best_iterations: Sequence[int], staging: Staging) -> DataFrame:
    """Validation metrics per fold. ``scored`` is the staged out-of-fold table."""
    rows = scored.count()
    parts = []
    for fold, best in enumerate(best_iterations):
        points = evaluation.curve(scored.where(F.col("fold") == fold), staging, "p_raw")
        sizes = points.agg(F.sum(F.col("pos") + F.col("neg")).alias("n_val"))
        parts.append(
            sizes.select(
                F.lit(fold).alias("fold"),
                evaluation.roc_auc(points).scalar().alias("val_roc_auc"),
                evaluation.average_precision(points).scalar().alias("val_pr_auc"),
                (F.lit(rows) - F.col("n_val")).alias("n_train"),
                "n_val",
                F.lit(best).cast("bigint").alias("best_iteration"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """Mean and sample deviation of the fold metrics."""
    return metrics.agg(
        *[
            function(name).alias(f"{prefix}_{name}")
            for name in ("val_roc_auc", "val_pr_auc")
            for prefix, function in (("mean", F.avg), ("std", F.stddev_samp))
        ]
    )


def fit_isotonic(scored: DataFrame, score: str = "p_raw", label: str = "y_bin") -> IsotonicRegressionModel:
    """Monotone calibration from score to attack probability.

    Equal scores are merged into one weighted point before the fit.
    """
    counts = evaluation.score_counts(scored, score, label)
    size = F.col("pos") + F.col("neg")
    points = counts.select(
        F.col("score"), (F.col("pos") / size).alias("label"), size.cast("double").alias("weight")
    )
    learner = IsotonicRegression(
        featuresCol="score", labelCol="label", weightCol="weight", predictionCol="p_cal"
    )
    return learner.fit(points)


def calibrate(scored: DataFrame, model: IsotonicRegressionModel, score: str = "p_raw") -> DataFrame:
    """Add ``p_cal``; scores outside the fitted range get the value at its end."""
    usable = F.nanvl(F.coalesce(F.col(score).cast("double"), F.lit(0.0)), F.lit(0.0))
    keyed = scored.withColumn("score", usable)
    return model.transform(keyed).drop("score")


def ensemble_score(
    rows: DataFrame,
    models: Sequence[GBTClassificationModel],
    calibrator: IsotonicRegressionModel,
    threshold: float | None = None,
) -> DataFrame:
    """Mean probability of all fold models, calibrated and compared with the threshold."""
    if not models:
        raise FileNotFoundError("no fold models to score with")
    names = [f"_p{i}" for i in range(len(models))]
    scored = reduce(
        lambda acc, pair: _probability(pair[1], acc, pair[0]), zip(names, models), rows
    )
    mean = reduce(lambda a, b: a + b, [F.col(n) for n in names]) / len(names)
    scored = scored.withColumn("p_raw", mean).drop(*names)
    return with_prediction(calibrate(scored, calibrator), threshold)


def calibration_report(
    calibrated: DataFrame,
    staging: Staging,
    precision_target: float = 0.98,
    fpr_target: float = 0.005,
) -> DataFrame:
    """One row: size, areas before and after calibration, and the chosen threshold."""
    raw = evaluation.curve(calibrated, staging, "p_raw")
    cal = evaluation.curve(calibrated, staging, "p_cal")
    best = evaluation.pick_threshold(cal, precision_target, fpr_target)
    return best.select(
        raw.agg(F.sum(F.col("pos") + F.col("neg"))).scalar().alias("n"),
        evaluation.average_precision(raw).scalar().alias("raw_pr_auc"),
        evaluation.roc_auc(raw).scalar().alias("raw_roc_auc"),
        evaluation.average_precision(cal).scalar().alias("cal_pr_auc"),
        evaluation.roc_auc(cal).scalar().alias("cal_roc_auc"),
        "threshold", "precision", "recall", "fpr",
        F.lit(float(precision_target)).alias("precision_target"),
        F.lit(float(fpr_target)).alias("fpr_target"),
    )
