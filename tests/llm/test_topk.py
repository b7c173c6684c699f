import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import differences, duckdb_over
from flowvigil.llm import queries, topk

FOLDER = "/root/testdata/sf0.001"


def test_matches_sql(spark):
    got = queries.op9_topk(spark, FOLDER).toPandas()
    assert differences(got, duckdb_over(FOLDER).execute(queries.ORACLE["op9_topk"]).df()) == ""


def slow(rows, k=5):
    usable = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in usable:
        if q % 50 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q and len(a) == len(b)]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_odd_vectors(spark, staging, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * (1 + 20 * (i % 7 == 0)) for _ in range(6)]) for i in range(600)]
    rows += [(1000 + i, rows[1][1]) for i in range(30)]  # ties, and a common vector
    rows += [(650, None), (700, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (750, [math.nan] * 6), (800, [math.inf] + [0.0] * 5)]
    rows += [(850, [0.0] * 6), (900, []), (950, [1.0, 2.0]), (951, [3.0, 4.0]), (None, [1.0] * 6), (2000, [1e5] * 6)]
    rows += [rows[3], rows[3]]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit(1))
    got = sorted(tuple(r) for r in topk.top_k(frame, staging, F.col("vec_id") % 50 == 0).collect())
    assert got == slow(rows)


def test_empty_table_and_no_query(spark, staging):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk.top_k(frame, staging, F.col("vec_id") % 50 == 0).count() == 0
    frame = spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<float>")
    assert topk.top_k(frame, staging, F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_pruning_loses_nothing(seed):
    rng = np.random.default_rng(seed)
    v = (rng.normal(size=(2000, 8)) * rng.lognormal(0, 1, (2000, 1)) * 100).astype(np.int64)
    if seed % 2:
        v = v // 40
    ids = rng.permutation(2000).astype(np.int64)
    place = np.lexsort((ids, -np.sqrt((v**2).sum(1))))
    block = topk.Block(ids[place].tobytes(), v[place].tobytes(), 8)
    query, own = v[seed], int(ids[seed])
    best = sorted((-s, i) for s, i in zip((v @ query).tolist(), ids.tolist()) if i != own)[:5]
    for bound in (-best[4][0], -best[4][0] - 30, -np.inf):
        found, scores = topk.best(query.astype(float), query, own, block, bound, 5)
        assert [(-s, i) for s, i in zip(scores.tolist(), found.tolist())] == best


def test_blocks_of_vectors_do_not_pass_through_the_driver(spark, staging, monkeypatch, capsys):
    """Pairs of blocks are shuffled, not broadcast, and the driver gets one block for each dimension."""
    monkeypatch.setattr(topk, "BLOCK", 10)
    read = []
    first = topk.first_blocks
    monkeypatch.setattr(topk, "first_blocks", lambda blocks, dims: read.append((blocks, first(blocks, dims))) or read[-1][1])
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(3 + i % 3 % 2)]) for i in range(600)] + [(700, [9e15, 1.0, 2.0]), (750, [])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = topk.top_k(frame, staging, F.col("vec_id") % 50 == 0)
    found.explain()
    assert "Broadcast" not in capsys.readouterr().out
    blocks, starts = read[0]
    assert blocks.count() > 30
    lowest = [r[:3] for r in sorted(blocks.select("dim", "bucket", "part").collect())]
    assert sorted(tuple(r) for r in starts.select("dim", "bucket", "part").collect()) == [min(tuple(p) for p in lowest if p[0] == d) for d in (0, 3, 4)]


@pytest.mark.parametrize("most", [100, 127, 128, 32_768, 2**31, 2**50])
def test_vectors_keep_their_numbers_in_smaller_types(most):
    v = np.array([[-most, 0], [most, 3]], dtype=np.int64)
    packed = topk.narrowed(v).tobytes()
    assert len(packed) <= v.nbytes and (topk.Block(np.arange(2).tobytes(), packed, 2).whole == v).all()
    assert topk.Block(np.arange(2).tobytes(), b"", 0).whole.shape == (2, 0)
