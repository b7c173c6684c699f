import zlib

import numpy as np
import pandas as pd

from cases import no_documents, odd_documents
from flowvigil.llm import quality, queries

FOLDER = "/root/testdata/sf0.01"


def test_held_out_rows_are_told_apart(spark):
    got = queries.op1_quality(spark, FOLDER).toPandas()
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    assert all(got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id])
    assert got.score.between(0, 1).all() and all(got.predicted == (got.score >= 0.3))
    both = got.merge(pd.read_parquet(f"{FOLDER}/labels.parquet"), on="doc_id")
    held = both[both.held_out]
    good, bad = held[held.quality == 1].score.values, held[held.quality == 0].score.values
    assert (good[:, None] > bad[None]).mean() > 0.97
    truth = held.quality.values == 1
    loss = -np.where(truth, np.log(held.score + 1e-9), np.log(1 - held.score + 1e-9)).mean()
    assert loss < 0.15


def test_odd_documents(spark, staging):
    docs = odd_documents(spark)
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(30)] + [(1, None), (None, 1), (103, 1), (100, 0), (500, 1)], "doc_id bigint, quality int"
    )
    model = quality.fit(docs, labels, staging)
    got = quality.score(docs, model).collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in docs.collect()]
    assert all(0 <= r.score <= 1 for r in got) and not got[-3].held_out
    assert len({r.score for r in got if r.doc_id in (0, 104)}) == 1
    kept = quality.keep_good(docs, model, 0.5)
    assert kept.columns == docs.columns and kept.count() == sum(r.score >= 0.5 for r in got)


def test_without_both_labels_all_get_the_share(spark, staging):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, labels, staging)).collect()} == {1.0}
    model = quality.fit(docs, labels.limit(0), staging)
    assert {r.score for r in quality.score(docs, model).collect()} == {0.5}
    assert quality.score(no_documents(spark), model).count() == 0


def test_memory_limits_do_not_change_vectors(monkeypatch):
    contexts = np.random.default_rng(1).normal(size=(quality.BUCKETS, quality.WIDTH)).astype(np.float32)
    texts = ["some words of a text", "Other WORDS!! in it, words", "some words of a text"]
    plain = [quality.pooled(x, contexts) for x in texts]
    monkeypatch.setattr(quality, "REMEMBERED", 4)
    monkeypatch.setattr(quality, "_VECTORS", [])
    for x, y in zip(texts, plain):
        assert np.allclose(quality.pooled(x, contexts), y, atol=1e-6)


def test_temperature_calibrates():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 6)).astype(np.float32)
    chance = 1 / (1 + np.exp(-2 * x[:, 0]))
    y = (rng.random(1500) < chance).astype(float)
    p = quality.train(x, y).probabilities(x)
    for low in np.arange(0, 1, 0.25):
        inside = (p >= low) & (p < low + 0.25)
        assert abs(p[inside].mean() - y[inside].mean()) < 0.15
