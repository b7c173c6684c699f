"""Registered queries of folds, weights, evaluation and learning, with their SQL counterparts."""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowvigil import config
from flowvigil.operators import evaluation as e, features, folds, learning, prepare
from flowvigil.operators.deployment import Deployment
from flowvigil.operators.features import FeatureModel
from flowvigil.plans.sample_flows import DUCKDB_FLOWS, load_flows
from flowvigil.staging import Staging

FOLDS = 5
#: Labelled flows that models are trained on, about, at most; None, as the queries run: all of them.
TRAINING_ROWS: int | None = None
#: The default configuration with larger steps and fewer rounds. The flows' classes can be told apart exactly, so
#: the validation loss falls in every round and only their number ends training; a round has about ten jobs.
TRAINING = learning.TrainConfig(rounds=24, learning_rate=0.3)
PRECISION, FPR = 0.98, 0.005


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    """Flows with a score in thousandths that ranks attacks higher, but not perfectly."""
    rows = features.with_targets(load_flows(spark, folder))
    mille = "CAST(round(p_raw * 1000) AS BIGINT)"
    return rows.withColumn(
        "p_cal",
        F.expr(f"CASE WHEN y_bin = 1 THEN 500 + {mille} div 2 ELSE {mille} * 3 div 4 END / 1000D"),
    )


_SCORED = f"""WITH {DUCKDB_FLOWS}, scored AS (SELECT *, CAST(label = 'attack' AS INT) AS y_bin,
  (CASE WHEN label = 'attack' THEN 500 + CAST(round(p_raw * 1000) AS BIGINT) // 2
        ELSE CAST(round(p_raw * 1000) AS BIGINT) * 3 // 4 END) / 1000.0::DOUBLE AS p_cal FROM flows),
counts AS (SELECT p_cal AS threshold, CAST(sum(y_bin) AS BIGINT) AS pos, CAST(sum(1 - y_bin) AS BIGINT) AS neg FROM scored GROUP BY ALL),
points AS (SELECT threshold, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
  CAST((SELECT sum(pos) FROM counts) - sum(pos) OVER w AS BIGINT) AS fn,
  CAST((SELECT sum(neg) FROM counts) - sum(neg) OVER w AS BIGINT) AS tn
  FROM counts WINDOW w AS (ORDER BY threshold DESC))"""


def _curve(spark, folder) -> DataFrame:
    return e.curve(_scored(spark, folder), Staging(spark))


def _pr_curve(spark, folder) -> DataFrame:
    return _curve(spark, folder).select(
        "threshold", "tp", "fp", "fn", "tn",
        F.round("precision", 6).alias("precision"),
        F.round("recall", 6).alias("recall"),
        F.round("fpr", 6).alias("fpr"),
    )


def _pick(precision: float | None, fpr: float | None):
    def run(spark, folder) -> DataFrame:
        best = e.pick_threshold(_curve(spark, folder), precision, fpr)
        return best.select(*[F.round(c, 6).alias(c) for c in best.columns])

    return run


def _host_folds(spark, folder) -> DataFrame:
    dealt = folds.serpentine_folds(folds.host_rates(load_flows(spark, folder)), FOLDS, Staging(spark))
    return dealt.select("orig_h", "pos", "n", F.round("rate", 6).alias("rate"), "fold")


def _fold_balance(spark, folder) -> DataFrame:
    flows = load_flows(spark, folder)
    staging = Staging(spark)
    dealt = folds.serpentine_folds(folds.host_rates(flows), FOLDS, staging)
    rows = folds.with_fold(features.with_targets(flows), staging.table(dealt, "folds"))
    return rows.groupBy("fold").agg(
        F.count("*").alias("n_val"), F.round(F.avg("y_bin"), 6).alias("attack_rate")
    )


def _type_weights(spark, folder) -> DataFrame:
    weights = folds.type_weights(load_flows(spark, folder))
    return weights.select("attack_type", "n", F.round("type_weight", 6).alias("type_weight"))


def _row_weights(spark, folder) -> DataFrame:
    flows = load_flows(spark, folder)
    weights = Staging(spark).table(folds.type_weights(flows), "type-weights")
    return folds.with_type_weight(flows, weights).select(
        "uid", F.round("type_weight", 6).alias("type_weight")
    )


def _class_weights(spark, folder) -> DataFrame:
    weights = folds.class_weights(features.with_targets(load_flows(spark, folder)))
    return weights.select("y_bin", "n", F.round("class_weight", 6).alias("class_weight"))


def _isotonic(spark, folder) -> DataFrame:
    scored = _scored(spark, folder)
    model = learning.fit_isotonic(scored)
    calibrated = learning.calibrate(scored.drop("p_cal"), model)
    return calibrated.select("uid", "p_raw", F.round("p_cal", 6).alias("p_cal"))


@dataclass(frozen=True)
class Trained:
    """Models of all folds in the default configuration, and every flow's out-of-fold score."""

    features: FeatureModel
    rows: DataFrame
    folds: list[learning.TrainedFold]
    scored: DataFrame

    @property
    def models(self) -> list:
        return [x.model for x in self.folds]


def training_rows(flows: DataFrame, model: FeatureModel, k: int, staging: Staging) -> DataFrame:
    """Rows with features, target, attack type and fold, staged as they come: files by fold would sort all rows of a task."""
    flows = prepare.with_direction(prepare.with_service_norm(flows))
    dealt = folds.serpentine_folds(folds.host_rates(flows), k, staging)
    flows = folds.with_fold(flows, staging.table(dealt, "folds"))
    matrix = model.matrix(flows, ("uid", "fold", "attack_type"))
    rows = learning.assemble(matrix, model.columns)
    return staging.table(rows.select("uid", "attack_type", "y_bin", "features", "fold"), "training")


def sampled(rows: DataFrame, most: int, key: str = "uid") -> DataFrame:
    """About ``most`` rows, chosen by a hash of their key; all if there are no more."""
    share = F.least(F.lit(1.0), F.lit(float(most)) / rows.agg(F.count("*")).scalar())
    return rows.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < share * 1_000_000)


@functools.lru_cache(4)
def _trained(spark: SparkSession, folder: str, application: str) -> Trained:
    """Training takes minutes, so the queries of one application share it."""
    staging = Staging(spark)
    flows = load_flows(spark, folder)
    model = FeatureModel.fit(prepare.with_direction(prepare.with_service_norm(flows)), staging)
    rows = training_rows(flows, model, FOLDS, staging)
    used, n, name = rows, rows.count(), "training-by-fold"
    if TRAINING_ROWS is not None:
        used, n, name = sampled(rows, TRAINING_ROWS), TRAINING_ROWS, "training-sample"
    if n <= learning.ROWS_A_TASK:
        # Few rows, so a task can sort them by fold, and a round's one task reads few rows too.
        used = staging.table(used, name, ("fold",))
    done = learning.train_folds(used, FOLDS, TRAINING)
    scored = learning.out_of_fold(rows, [x.model for x in done]).drop("features")
    return Trained(model, rows, done, staging.table(scored, "oof"))


def trained(spark: SparkSession, folder: str) -> Trained:
    return _trained(spark, folder, spark.sparkContext.applicationId)


def _gbt_oof(spark, folder) -> DataFrame:
    return trained(spark, folder).scored.select("uid", "fold", "y_bin", "p_raw")


def _gbt_metrics(spark, folder) -> DataFrame:
    """Per fold: areas, sizes, best round, its validation loss and that of the last round trained."""
    found = trained(spark, folder)
    metrics = learning.fold_metrics(found.scored, [x.model.getNumTrees for x in found.folds], Staging(spark))
    losses = spark.createDataFrame(
        [(fold, min(x.losses), x.losses[-1], len(x.losses)) for fold, x in enumerate(found.folds)],
        "fold int, best_loss double, last_loss double, rounds int",
    )
    return metrics.join(losses, "fold")


def _fold_scores(spark, folder, staging: Staging) -> DataFrame:
    flows = load_flows(spark, folder)
    dealt = staging.table(folds.serpentine_folds(folds.host_rates(flows), FOLDS, staging), "folds")
    scored = folds.with_fold(_scored(spark, folder), dealt)
    return staging.table(scored.select("uid", "fold", "y_bin", F.col("p_cal").alias("p_raw")), "fold-scores")


def _fold_metrics(spark, folder) -> DataFrame:
    staging = Staging(spark)
    metrics = learning.fold_metrics(_fold_scores(spark, folder, staging), range(1, FOLDS + 1), staging)
    return metrics.select("fold", "n_train", "n_val", *[F.round(c, 6).alias(c) for c in ("val_roc_auc", "val_pr_auc")], "best_iteration")


def _cv_summary(spark, folder) -> DataFrame:
    staging = Staging(spark)
    metrics = learning.fold_metrics(_fold_scores(spark, folder, staging), [1] * FOLDS, staging)
    summary = learning.metrics_summary(metrics)
    return summary.select(*[F.round(c, 6).alias(c) for c in summary.columns])


def _ensemble(spark, folder) -> DataFrame:
    found = trained(spark, folder)
    scores = learning.ensemble_score(found.rows, found.models, learning.fit_isotonic(found.scored), 0.8)
    return scores.select("uid", "p_raw", "p_cal", "pred", "margin")


def _stored_score(spark, folder) -> DataFrame:
    """Scores of a deployment that was stored and loaded, beside those of the one in memory."""
    staging, found = Staging(spark), trained(spark, folder)
    flows = load_flows(spark, folder)
    made = Deployment(found.features, found.models, learning.fit_isotonic(found.scored), config.Thresholds(0.7, 0.9, 0.01))
    made.save(spark, path := staging.path("deployment"))
    stored = Deployment.load(spark, path)
    pairs = made.score(flows).select("uid", F.col("p_cal").alias("a")).join(
        stored.score(flows).select("uid", F.col("p_cal").alias("b")), "uid"
    )
    return pairs.select(
        "uid", (F.col("a") == F.col("b")).alias("same"), F.lit(stored.thresholds.threshold).alias("threshold"),
        F.lit(stored.thresholds.fpr_target).alias("fpr_target"),
    )


def _report(spark, folder) -> DataFrame:
    scored = _scored(spark, folder)
    model = learning.fit_isotonic(scored)
    calibrated = learning.calibrate(scored.drop("p_cal"), model)
    report = learning.calibration_report(calibrated, Staging(spark), PRECISION, FPR)
    return report.select("n", *[F.round(c, 6).alias(c) for c in report.columns if c != "n"])


QUERIES = {
    "host_folds": _host_folds,
    "fold_balance": _fold_balance,
    "type_weights": _type_weights,
    "row_weights": _row_weights,
    "class_weights": _class_weights,
    "pr_curve": _pr_curve,
    "roc_auc": lambda s, f: e.roc_auc(_curve(s, f)).select(F.round("roc_auc", 6).alias("roc_auc")),
    "average_precision": lambda s, f: e.average_precision(_curve(s, f)).select(
        F.round("average_precision", 6).alias("average_precision")
    ),
    "confusion": lambda s, f: e.confusion(_scored(s, f), 0.7),
    "confusion_strict": lambda s, f: e.confusion(_scored(s, f), 0.7, inclusive=False),
    "pick_threshold": _pick(PRECISION, FPR),
    "pick_threshold_precision": _pick(0.9, None),
    "pick_threshold_fallback": _pick(1.1, 0.0),
    "isotonic": _isotonic,
    "calibration_report": _report,
    "fold_metrics": _fold_metrics,
    "cv_summary": _cv_summary,
    "gbt_oof": _gbt_oof,
    "gbt_metrics": _gbt_metrics,
    "ensemble_score": _ensemble,
    "stored_score": _stored_score,
}

def _hosts_sql(k: int) -> str:
    return f"""WITH {DUCKDB_FLOWS}, hosts AS (SELECT orig_h, CAST(sum(CASE WHEN label = 'attack' THEN 1 ELSE 0 END) AS BIGINT) AS pos,
  count(*) AS n FROM flows GROUP BY ALL),
placed AS (SELECT *, pos / n AS rate, (row_number() OVER (ORDER BY pos / n DESC, n DESC, orig_h) - 1) % {2 * k} AS place FROM hosts),
dealt AS (SELECT *, CAST(CASE WHEN place < {k} THEN place ELSE {2 * k - 1} - place END AS INT) AS fold FROM placed)"""


_HOSTS = _hosts_sql(FOLDS)
# Every run of scores gets its attack share; a score's value is the largest, over run starts at or
# below it, of the smallest share of the runs from there that reach it.
_ISOTONIC = f"""{_SCORED},
  c AS (SELECT p_raw AS x, CAST(sum(y_bin) AS DOUBLE) AS s, CAST(count(*) AS DOUBLE) AS w FROM scored GROUP BY 1),
  r AS (SELECT x, s, w, row_number() OVER (ORDER BY x) AS i, sum(s) OVER (ORDER BY x) AS cs, sum(w) OVER (ORDER BY x) AS cw FROM c),
  runs AS (SELECT a.i AS a, b.i AS i, (b.cs - a.cs + a.s) / (b.cw - a.cw + a.w) AS share FROM r a JOIN r b ON b.i >= a.i),
  low AS (SELECT a, i, min(share) OVER (PARTITION BY a ORDER BY i DESC ROWS UNBOUNDED PRECEDING) AS low FROM runs),
  iso AS (SELECT i, max(low) AS p FROM low GROUP BY i)"""
_TYPES = f"""WITH {DUCKDB_FLOWS}, types AS (SELECT attack_type, count(*) AS n FROM flows WHERE label = 'attack' GROUP BY ALL),
weights AS (SELECT attack_type, n, round(least(3.0::DOUBLE, (SELECT median(n) FROM types) / n), 6) AS type_weight FROM types)"""

_FOLD_METRICS = f"""{_SCORED}, {_hosts_sql(FOLDS).removeprefix(f'WITH {DUCKDB_FLOWS}, ')},
  per_fold AS (SELECT fold, p_cal AS threshold, sum(y_bin) AS pos, sum(1 - y_bin) AS neg FROM scored JOIN dealt USING (orig_h) GROUP BY ALL),
  run AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM per_fold WINDOW w AS (PARTITION BY fold ORDER BY threshold DESC)),
  metrics AS (SELECT fold, CAST((SELECT count(*) FROM scored) - sum(pos + neg) AS BIGINT) AS n_train, CAST(sum(pos + neg) AS BIGINT) AS n_val,
    CAST(sum(neg * (tp - pos / 2.0::DOUBLE)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS roc,
    sum(pos * (tp / (tp + fp))) / CAST(sum(pos) AS DOUBLE) AS pr FROM run GROUP BY fold)"""


def _confusion_sql(test: str) -> str:
    return f"""{_SCORED} SELECT count(*) FILTER (y_bin = 1 AND p_cal {test} 0.7) AS tp,
      count(*) FILTER (y_bin = 0 AND p_cal {test} 0.7) AS fp, count(*) FILTER (y_bin = 1 AND NOT p_cal {test} 0.7) AS fn,
      count(*) FILTER (y_bin = 0 AND NOT p_cal {test} 0.7) AS tn FROM scored"""


def _areas_sql(points: str) -> str:
    return f"""(SELECT round(sum(pos * (tp / (tp + fp))) / CAST(sum(pos) AS DOUBLE), 6) FROM {points}) AS {{0}}_pr_auc,
      (SELECT round(CAST(sum(neg * (tp - pos / 2.0::DOUBLE)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6)
       FROM {points}) AS {{0}}_roc_auc"""


def _report_sql() -> str:
    points = """{0} AS (SELECT threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM (
      SELECT {1} AS threshold, sum(y_bin) AS pos, sum(1 - y_bin) AS neg FROM calibrated GROUP BY 1) t
      WINDOW w AS (ORDER BY threshold DESC))"""
    picked = _pick_sql(PRECISION, FPR).removeprefix(_SCORED).lstrip(" ,")
    return f"""{_ISOTONIC}, calibrated AS (SELECT y_bin, p_raw, round(p, 12) AS p_iso FROM scored JOIN r ON p_raw = x JOIN iso USING (i)),
      {points.format("raw_points", "p_raw")}, {points.format("cal_points", "p_iso")},
      {picked.replace("FROM points", """FROM (SELECT *, (SELECT sum(pos) FROM cal_points) - tp AS fn,
        (SELECT sum(neg) FROM cal_points) - fp AS tn FROM cal_points) t""").replace(
          "SELECT threshold, round(precision", f"""SELECT (SELECT count(*) FROM scored) AS n,
        {_areas_sql("raw_points").format("raw")}, {_areas_sql("cal_points").format("cal")},
        {PRECISION}::DOUBLE AS precision_target, {FPR}::DOUBLE AS fpr_target, round(threshold, 6) AS threshold, round(precision""", 1)}"""


def _pick_sql(precision: float | None, fpr: float | None) -> str:
    tests = ["tp > 0"]
    if precision is not None:
        tests.append(f"precision >= {precision}")
    if fpr is not None:
        tests.append(f"fpr <= {fpr}")
    return f"""{_SCORED}, guarded AS (SELECT threshold, tp / (tp + fp + 1e-9::DOUBLE) AS precision, tp / (tp + fn + 1e-9::DOUBLE) AS recall,
        fp / (fp + tn + 1e-9::DOUBLE) AS fpr, tp,
        2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn) + 1e-9::DOUBLE) AS f1 FROM points)
      SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(fpr, 6) AS fpr FROM guarded
      ORDER BY CASE WHEN {' AND '.join(tests)} THEN 0 ELSE 1 END,
        CASE WHEN {' AND '.join(tests)} THEN guarded.recall ELSE f1 END DESC,
        CASE WHEN {' AND '.join(tests)} THEN guarded.precision ELSE 0 END DESC, threshold LIMIT 1"""


ORACLE = {
    "isotonic": f"""{_ISOTONIC} SELECT uid, p_raw, round(p, 6) AS p_cal FROM scored JOIN r ON p_raw = x JOIN iso USING (i)""",
    "calibration_report": _report_sql(),
    "fold_metrics": f"""{_FOLD_METRICS} SELECT fold, n_train, n_val, round(roc, 6) AS val_roc_auc, round(pr, 6) AS val_pr_auc,
      fold + 1::BIGINT AS best_iteration FROM metrics""",
    "cv_summary": f"""{_FOLD_METRICS} SELECT round(avg(roc), 6) AS mean_val_roc_auc, round(stddev_samp(roc), 6) AS std_val_roc_auc,
      round(avg(pr), 6) AS mean_val_pr_auc, round(stddev_samp(pr), 6) AS std_val_pr_auc FROM metrics""",
    "stored_score": f"""WITH {DUCKDB_FLOWS} SELECT uid, TRUE AS same, 0.7::DOUBLE AS threshold, 0.01::DOUBLE AS fpr_target FROM flows""",
    "host_folds": f"{_HOSTS} SELECT orig_h, pos, n, round(rate, 6) AS rate, fold FROM dealt",
    "fold_balance": f"""{_HOSTS} SELECT fold, CAST(sum(n) AS BIGINT) AS n_val, round(sum(pos) / sum(n), 6) AS attack_rate
      FROM dealt GROUP BY fold""",
    "type_weights": f"{_TYPES} SELECT * FROM weights",
    "row_weights": f"""{_TYPES} SELECT uid, CASE WHEN label = 'attack' THEN type_weight ELSE 1.0::DOUBLE END AS type_weight
      FROM flows LEFT JOIN weights USING (attack_type)""",
    "class_weights": f"""{_SCORED} SELECT y_bin, count(*) AS n,
      round((SELECT count(*) FROM scored) / (2.0::DOUBLE * count(*)), 6) AS class_weight FROM scored GROUP BY y_bin""",
    "pr_curve": f"""{_SCORED} SELECT threshold, tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision,
      round(tp / (tp + fn), 6) AS recall, round(fp / (fp + tn), 6) AS fpr FROM points""",
    "roc_auc": f"""{_SCORED} SELECT round(CAST(sum(neg * (tp - pos / 2.0::DOUBLE)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6)
      AS roc_auc FROM points""",
    "average_precision": f"""{_SCORED} SELECT round(sum(pos * (tp / (tp + fp))) / CAST(sum(pos) AS DOUBLE), 6) AS average_precision FROM points""",
    "confusion": _confusion_sql(">="),
    "confusion_strict": _confusion_sql(">"),
    "pick_threshold": _pick_sql(PRECISION, FPR),
    "pick_threshold_precision": _pick_sql(0.9, None),
    "pick_threshold_fallback": _pick_sql(1.1, 0.0),
}
