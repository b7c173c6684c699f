import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowvigil.operators import evaluation as e, features, folds, prepare, profile
from flowvigil.operators.ordering import exact_quantiles, running_totals, with_row_number


def test_row_number_and_running_totals(spark, staging):
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 1, 1, 50]), rng.randrange(9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, k int, v int").repartition(7)
    order = [F.col("k").desc(), F.col("id")]
    numbered = {r.id: r.position for r in with_row_number(df, order, staging, "position").collect()}
    expected = sorted(rows, key=lambda x: (-x[1], x[0]))
    assert [numbered[x[0]] for x in expected] == list(range(1, 3001))
    totals = {r.id: r.upto for r in running_totals(df, order, {"upto": "v"}, staging).collect()}
    assert [totals[x[0]] for x in expected] == np.cumsum([x[2] for x in expected]).tolist()


def test_exact_quantiles(spark, staging):
    rng = random.Random(2)
    a = [rng.choice([0.0, rng.gauss(0, 5)]) for _ in range(501)]
    rows = [(x, None if i % 3 else x * 2) for i, x in enumerate(a)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(6)
    found = {(r.column_name, r.probability): r.value for r in exact_quantiles(df, ["a", "b"], [0.0, 0.005, 0.37, 0.995, 1.0], staging).collect()}
    for q in (0.0, 0.005, 0.37, 0.995, 1.0):
        assert found["a", q] == pytest.approx(np.quantile(a, q))
        assert found["b", q] == pytest.approx(np.quantile([y for _, y in rows if y is not None], q))


def test_dedupe_keys(spark):
    rows = [("u", "attack", 1.0), ("u", "normal", 2.0), (None, "attack", 5.0), (None, "attack", 3.0)]
    kept = prepare.dedupe(spark.createDataFrame(rows, "uid string, label string, ts double")).collect()
    assert sorted((r.uid or "", r.label, r.ts) for r in kept) == [("", "attack", 3.0), ("u", "normal", 2.0)]
    plain = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "orig_h string, x int")
    assert prepare.dedupe(plain).count() == 2
    assert prepare.dedupe(spark.createDataFrame([(1,), (1,)], "x int")).count() == 1


def test_dedupe_limits_rows_before_the_shuffle(spark):
    df = prepare.dedupe(spark.range(10).selectExpr("CAST(id % 3 AS STRING) AS uid", "id AS ts"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


def test_normalize_and_union(spark):
    normal = spark.createDataFrame([("1.5", "a", "10.0.0.1", "8.8.8.8", "x")], "ts string, uid string, `id.orig_h` string, `id.resp_h` string, extra string")
    attack = spark.createDataFrame([("bad", "b", "8.8.8.8", "9.9.9.9", "ssl")], "ts string, uid string, orig_h string, resp_h string, service string")
    both = prepare.prepare_labelled(normal, attack, drop_external_external=True).collect()
    assert [(r.uid, r.label, r.attack_type, r.service_norm, r.flow_dir) for r in both] == [("a", "normal", "none", "other", "i→e")]
    assert both[0].event_time.timestamp() == 1.5
    with pytest.raises(ValueError):
        prepare.apply_tunnel_policy(normal, "burn")


def test_feature_model_round_trip(spark, staging):
    rows = [(f"u{i}", "tcp" if i % 3 else "a-b", "http" if i % 4 else "rare", "SF", float(i), float(i % 5), i, 1, 0.0, 80) for i in range(40)]
    rows.append(("odd", "a b", None, "weird", None, None, None, None, None, None))
    schema = "uid string, proto string, service string, conn_state string, orig_bytes double, resp_bytes double, orig_pkts bigint, resp_pkts bigint, duration double, resp_p int"
    flows = spark.createDataFrame(rows, schema)
    model = features.FeatureModel.fit(flows, staging, k=1)
    assert features.FeatureModel.from_json(model.to_json()) == model
    matrix = model.matrix(flows)
    assert matrix.columns == ["uid", *model.columns, "y_bin", "y_multi"]
    assert "proto_a_b" in model.columns and model.services == ["http"]
    got = {r.uid: r for r in matrix.collect()}
    assert got["odd"].proto_a_b == 1 and got["u0"].proto_a_b == 1 and got["u1"].proto_a_b == 0
    assert got["odd"].service_norm_service_other_rare == 1 and got["odd"].conn_state_UNK == 1
    assert got["odd"].is_priv_port == 1 and got["odd"].is_ephemeral == 0
    assert got["u7"].bytes_ratio == pytest.approx(7 / 2)
    # A batch without some columns still has the fitted layout.
    assert model.matrix(flows.drop("proto", "resp_p")).columns == matrix.columns


def test_thresholds_and_areas(spark, staging):
    rng = random.Random(4)
    rows = [(rng.choice([0.1, 0.4, 0.4, 0.8, 0.9]) , int(rng.random() < 0.3)) for _ in range(500)]
    rows = [(min(1.0, s + 0.1 * y), y) for s, y in rows]
    df = spark.createDataFrame(rows, "p_cal double, y_bin int").repartition(5)
    points = e.curve(df, staging)
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    pairs = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert e.roc_auc(points).first()[0] == pytest.approx(pairs)
    steps, last = 0.0, 0
    for t in sorted({s for s, _ in rows}, reverse=True):
        tp, fp = sum(s >= t for s in pos), sum(s >= t for s in neg)
        steps += (tp - last) / len(pos) * tp / (tp + fp)
        last = tp
    assert e.average_precision(points).first()[0] == pytest.approx(steps)
    for targets in ((0.5, None), (None, 0.2), (0.3, 0.5), (1.1, 0.0)):
        best, chosen = (0.0, 0.0), None
        for t in sorted({s for s, _ in rows}):
            tp, fp = sum(s >= t for s in pos), sum(s >= t for s in neg)
            precision, recall, fpr = tp / (tp + fp + 1e-9), tp / (len(pos) + 1e-9), fp / (len(neg) + 1e-9)
            if (targets[0] is None or precision >= targets[0]) and (targets[1] is None or fpr <= targets[1]) and (recall, precision) > best:
                best, chosen = (recall, precision), t
        if chosen is None:
            f1 = lambda t: 2 * sum(s >= t for s in pos) / (sum(s >= t for s in pos) + sum(s >= t for s in neg) + len(pos))
            chosen = max(sorted({s for s, _ in rows}), key=f1)
        assert e.pick_threshold(points, *targets).first().threshold == chosen


def test_one_class_has_no_area(spark, staging):
    df = spark.createDataFrame([(0.2, 0), (0.3, 0)], "p_cal double, y_bin int")
    assert e.roc_auc(e.curve(df, staging)).first()[0] is None


def test_serpentine_balances(spark, staging):
    rows = [(f"h{h}", "attack" if i < h % 7 else "normal") for h in range(60) for i in range(10)]
    dealt = folds.serpentine_folds(folds.host_rates(spark.createDataFrame(rows, "orig_h string, label string")), 5, staging)
    assert {r.fold: r["count"] for r in dealt.groupBy("fold").count().collect()} == {f: 12 for f in range(5)}


def test_profile_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert [(r.column_name, r.null_rate) for r in profile.null_rates(df).collect()] == [("b", 0.6667), ("a", 0.3333)]


def test_type_weights_come_from_the_training_rows(spark):
    from flowvigil.operators import learning

    rows = [(0, 1, "a")] * 4 + [(0, 1, "b")] * 2 + [(1, 1, "b")] * 50 + [(0, 0, "none")] * 3 + [(1, 0, "none")]
    frame = spark.createDataFrame(rows, "fold int, y_bin int, attack_type string")
    train, held_out = learning.weighted_split(frame, 1)
    # Median of 4 and 2 is 3; the 50 rows of the other fold don't count.
    assert {r.attack_type: r.type_weight for r in train.collect()} == {"a": 0.75, "b": 1.5, "none": 1.0}
    assert held_out.count() == 51 and {r.weight for r in held_out.collect()} == {1.0}


def test_patience():
    from flowvigil.operators.learning import stopped

    assert stopped([5, 4, 3, 4, 4, 4, 1], 3) == (3, 6)  # ends before it could see the 1
    assert stopped([5, 4, 3, 4, 4, 2, 1], 3) == (7, 7)
    assert stopped([1, 1, 1], 5) == (1, 3)
    assert stopped([2, 1, 1, 1], 2) == (2, 4)


def test_newest_rows_without_one_task(spark):
    from flowvigil.operators.ordering import newest

    rng = random.Random(7)
    times = [None, -5.5, 0.0, *[rng.choice([1.0, 86_399.2, 86_400.0, 86_400.7, 200_000.0, 200_000.1, 1e9]) for _ in range(60)]]
    rows = [(t, i) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "ts double, id int").repartition(5)
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -r[1]))
    for n in (1, 2, 7, 30, 61, 62, 63, 100):
        found = newest(df, F.col("ts"), [F.col("id").desc()], n)
        assert found.columns == df.columns
        assert sorted((r.id for r in found.collect())) == sorted(i for _, i in ordered[:n]), n
    assert newest(df.limit(0), F.col("ts"), [F.col("id").desc()], 3).count() == 0
