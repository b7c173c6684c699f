"""Steps whose tasks must not grow with the table: plans and splits, on rows of the tests' own."""

import json

from pyspark.sql import functions as F

from flowvigil.plans import model_queries, rule_queries, sample_flows, stream_queries
from flowvigil.staging import Staging

KINDS = ("click", "view", "purchase", "signup", "error")


def events(spark, path, n):
    rows = [(i, 1_700_000_000 + 977 * i, i % 40, KINDS[i % 5], (i * 37 % 1000) / 4, json.dumps({"k": i * 7 % 50})) for i in range(n)]
    frame = spark.createDataFrame(rows, "event_id bigint, ts bigint, user_id bigint, event_type string, value double, props string")
    frame.withColumn("ts", F.timestamp_seconds("ts")).coalesce(1).write.parquet(f"{path}/events.parquet")
    return str(path)


def test_approx_distinct_carries_no_sketch_per_value(spark, tmp_path, capsys):
    found = rule_queries.QUERIES["approx_distinct"](spark, events(spark, tmp_path, 400))
    found.explain()
    assert "Expand" not in capsys.readouterr().out
    rows = found.collect()
    assert rows and all(r.sources_close and r.pairs_close for r in rows)


def test_tightly_packed_events_are_read_by_several_tasks(spark, tmp_path, monkeypatch):
    folder = events(spark, tmp_path, 400)
    whole = sorted(r.uid for r in sample_flows.load_flows(spark, folder).collect())
    monkeypatch.setattr(sample_flows, "ROWS_A_TASK", 50)
    flows = sample_flows.load_flows(spark, folder)
    sizes = [r["count"] for r in flows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 200
    assert sorted(r.uid for r in flows.collect()) == whole


def test_models_are_trained_on_the_staged_sample(spark, tmp_path, monkeypatch):
    """Rounds read the sample's own files, and the table of all rows is written as it comes, without a sort by fold."""
    staged = {}
    table = Staging.table

    def noted(self, df, name, partition_by=()):
        made = table(self, df, name, partition_by)
        staged[name] = (partition_by, made)
        return made

    monkeypatch.setattr(Staging, "table", noted)
    monkeypatch.setattr(model_queries, "TRAINING_ROWS", 300)
    monkeypatch.setattr(model_queries, "TRAINING", model_queries.learning.TrainConfig(rounds=2, depth=2, min_leaf_rows=1))
    found = model_queries.trained(spark, events(spark, tmp_path, 1200))
    assert staged["training"][0] == () and 0 < staged["training-sample"][1].count() < 600
    assert found.scored.count() == found.rows.count() == 1200


def test_a_part_of_the_backlog_lands_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    """However many files a part needs, it is one batch, and every flagged flow is merged once."""
    folder = events(spark, tmp_path, 400)
    monkeypatch.setattr(stream_queries, "ROWS_A_FILE", 30)
    run = stream_queries.backlog_run(spark, folder)
    batches = run.table(spark, "scored").groupBy("batch").count().collect()
    assert len(batches) == stream_queries.BACKLOG_FILES
    wanted = sorted(r.uid for r in sample_flows.load_flows(spark, folder).where("p_raw > 0.8 + 1e-12").collect())
    assert sorted(r.uid for r in run.table(spark, "merged_alerts").where("source = 'ml'").collect()) == wanted
    landing = run.folder.rsplit("/", 1)[0]
    files = spark.read.text(f"{landing}/*-landing/*").groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count")).first()[0] <= 60


def test_models_are_trained_on_all_rows(spark, tmp_path, monkeypatch):
    """Every row trains the models of the other folds, however many there are and in however many tasks."""
    given = []
    train = model_queries.learning.train_fold

    def noted(rows, fold, cfg):
        given.append(rows.where(F.col("fold") != fold).count())
        return train(rows, fold, cfg)

    monkeypatch.setattr(model_queries.learning, "train_fold", noted)
    monkeypatch.setattr(model_queries.learning, "ROWS_A_TASK", 9_000)
    monkeypatch.setattr(model_queries, "TRAINING", model_queries.learning.TrainConfig(rounds=1, depth=2, min_leaf_rows=1))
    folder = events(spark, tmp_path, 24_000)
    scores = model_queries.QUERIES["gbt_oof"](spark, folder)
    assert scores.count() == 24_000 and sum(given) == 4 * 24_000
    metrics = model_queries.QUERIES["gbt_metrics"](spark, folder).collect()
    assert sorted(given) == sorted(r.n_train for r in metrics)
