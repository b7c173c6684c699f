"""Training in the default configuration: early stopping, scores and metrics against plain computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowvigil.operators import learning
from flowvigil.plans import model_queries
from compare import duckdb_over

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def found(spark):
    return model_queries.trained(spark, FOLDER)


def test_configuration(found):
    cfg, used = learning.TrainConfig(), model_queries.TRAINING
    assert (cfg.rounds, cfg.depth, cfg.patience, model_queries.FOLDS) == (1200, 6, 100, 5)
    assert used == learning.TrainConfig(rounds=used.rounds, learning_rate=used.learning_rate)
    assert len(found.folds) == 5
    for fold in found.folds:
        assert fold.model.getNumTrees == int(np.argmin(fold.losses)) + 1
        assert len(fold.losses) == min(used.rounds, fold.model.getNumTrees + used.patience)


def test_training_ends_after_the_best_round(spark):
    """Labels that features tell little about: validation gets worse soon."""
    rng = np.random.default_rng(5)
    rows = [(i % 2, int(rng.random() < 0.4 + 0.2 * (i % 7 == 0)), [float(i % 7), *rng.random(4).tolist()]) for i in range(300)]
    frame = spark.createDataFrame(rows, "fold int, y_bin int, x array<double>").select(
        "fold", "y_bin", *[F.col("x")[i].alias(f"x{i}") for i in range(5)]
    )
    data = learning.assemble(frame, [f"x{i}" for i in range(5)])
    cfg = learning.TrainConfig(rounds=200, depth=3, learning_rate=0.3, min_leaf_rows=1, patience=4)
    fold = learning.train_fold(data, 0, cfg)
    best = int(np.argmin(fold.losses)) + 1
    assert fold.model.getNumTrees == best and len(fold.losses) == best + 4 < 200
    assert fold.model.evaluateEachIteration(data.where("fold = 0").withColumn("weight", F.lit(1.0)))[-1] == pytest.approx(min(fold.losses))


def test_first_rounds_score_as_the_losses_say(spark, found):
    """The cut model's loss on its fold is the lowest of the stored losses."""
    for at, fold in enumerate(found.folds):
        rows = found.rows.where(F.col("fold") == at).withColumn("weight", F.lit(1.0))
        assert fold.model.evaluateEachIteration(rows)[-1] == pytest.approx(min(fold.losses), rel=1e-9)


def test_out_of_fold_scores_come_from_the_folds_model(spark, found):
    """Scores by walking the trees one by one."""

    def walk(node, x):
        while node.numDescendants() if callable(getattr(node, "numDescendants", None)) else False:
            split = node.split()
            value = x[split.featureIndex()]
            left = value <= split.threshold() if hasattr(split, "threshold") else value in list(split.leftCategories())
            node = node.leftChild() if left else node.rightChild()
        return node.prediction()

    rows = {r.uid: r for r in found.rows.limit(40).collect()}
    scores = {r.uid: r.p_raw for r in found.scored.where(F.col("uid").isin(list(rows))).collect()}
    for uid, row in rows.items():
        model = found.folds[row.fold].model
        x = row.features.toArray()
        total = sum(w * walk(t._java_obj.rootNode(), x) for t, w in zip(model.trees, model.treeWeights))
        assert scores[uid] == pytest.approx(1 / (1 + np.exp(-2 * total)), abs=1e-9)


def test_metrics_from_the_returned_scores(spark, found):
    scores = model_queries.QUERIES["gbt_oof"](spark, FOLDER).toPandas()
    metrics = model_queries.QUERIES["gbt_metrics"](spark, FOLDER).toPandas().set_index("fold")
    con = duckdb_over(FOLDER)
    con.register("scores", scores)
    areas = con.execute("""SELECT fold, avg(CASE WHEN a.p_raw > b.p_raw THEN 1.0 WHEN a.p_raw = b.p_raw THEN 0.5 ELSE 0 END) AS roc
      FROM scores a JOIN scores b USING (fold) WHERE a.y_bin = 1 AND b.y_bin = 0 GROUP BY fold""").df().set_index("fold")
    for fold, row in metrics.iterrows():
        assert row.val_roc_auc == pytest.approx(areas.roc[fold], abs=1e-9)
        assert row.n_val == (scores.fold == fold).sum() and row.n_train == (scores.fold != fold).sum()
        assert row.best_loss <= row.last_loss and row.best_iteration <= row.rounds


def test_ensemble(spark, found):
    got = model_queries.QUERIES["ensemble_score"](spark, FOLDER).toPandas().sort_values("p_raw", kind="stable")
    assert len(got) == found.rows.count() and got.p_raw.between(0, 1).all()
    assert (np.diff(got.p_cal) >= -1e-12).all()
    assert (got.pred == (got.p_cal > 0.8)).all() and np.allclose(got.margin, got.p_cal - 0.8)
    single = [learning._probability(m, found.rows, "p").select("uid", "p").toPandas().set_index("uid").p for m in found.models]
    assert np.allclose(got.set_index("uid").p_raw.sort_index(), (sum(single) / 5).sort_index())
