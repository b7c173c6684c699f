import json

import pytest
from pyspark.sql import functions as F, types as T

from flowvigil.config import DEFAULT, LAB, profile, with_windows
from flowvigil.operators import learning
from flowvigil.schema import BAN_STATE, FLOW, RULE_ALERT, SCORED_FLOW
from flowvigil.sources import flow_logs as logs, settings, sinks


def test_json_log(spark, tmp_path):
    record = {"ts": 1.5, "uid": "a", "id.orig_h": "10.0.0.1", "id.orig_p": 5, "id.resp_h": "8.8.8.8", "id.resp_p": 53, "history": "ShAD"}
    (tmp_path / "a.json").write_text('["ts","uid"]\n' + json.dumps(record) + "\n{broken\n")
    rows = logs.read_flow_json(spark, str(tmp_path)).collect()
    assert [(r.uid, r.orig_h, r.resp_p, r.history, r.service) for r in rows] == [("a", "10.0.0.1", 53, "ShAD", None)]


def test_tsv_log(spark, tmp_path):
    values = {"ts": "2.5", "uid": "b", "orig_h": "h", "resp_p": "80", "service": "quic,ssl", "history": '"S'}
    line = "\t".join(values.get(c, "-") for c in logs.TSV_COLUMNS)
    (tmp_path / "conn.log").write_text("#separator \\x09\n#fields\tts\n" + line + "\n#close\n")
    rows = logs.read_flow_tsv(spark, str(tmp_path)).collect()
    assert [(r.ts, r.uid, r.service, r.resp_p, r.proto, r.history) for r in rows] == [(2.5, "b", "quic,ssl", 80, None, '"S')]


def test_headerless_csv(spark, tmp_path):
    full = ["1.5", "u1", "a", "1", "b", "22", "tcp", '"x,y"', "SF", "1", "2", "3", "4", "5", "6", "0.1", "0.2", "0", "-0.6"]
    lines = [",".join(full), ",".join([*full, "more"]), ",".join([*full, ""]), ",".join(full[:5]), ",".join(SCORED_FLOW.names)]
    (tmp_path / "s.csv").write_text("\n".join(lines) + "\n")
    rows = logs.read_csv_without_header(spark, str(tmp_path), SCORED_FLOW)
    got = sorted((r.uid, r.service or "", r.resp_p or 0, r.margin or 0.0) for r in rows.collect())
    assert got == [("u1", "", 0, 0.0), ("u1", "x,y", 22, -0.6), ("uid", "service", 0, 0.0)]
    assert rows.select("uid").count() == 3


def test_header_csv_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id.resp_p,uid,attack_type,duration\n80.0,u,ddos,bad\n")
    row = logs.read_csv(spark, str(tmp_path / "t.csv")).first()
    assert (row.resp_p, row.uid, row.attack_type, row.duration) == (80, "u", "ddos", None)


def test_tolerant_scan(spark, tmp_path):
    assert logs.scan_or_empty(spark, str(tmp_path / "none"), FLOW).count() == 0
    (tmp_path / "empty.csv").write_text("")
    read = lambda s, p: logs.read_csv_without_header(s, p, SCORED_FLOW)
    assert logs.scan_or_empty(spark, str(tmp_path / "empty.csv"), SCORED_FLOW, read).count() == 0
    folder = tmp_path / "mixed"
    spark.createDataFrame([("u",)], "uid string").write.parquet(str(folder))
    (folder / "part-broken.parquet").write_text("not parquet at all")
    assert logs.scan_or_empty(spark, str(folder), FLOW, skip_corrupt=True).where("uid IS NOT NULL").count() == 1


def test_rule_files(spark, tmp_path):
    (tmp_path / "scan.json").write_text('{"pair_threshold_short": 3, "s0_ratio_threshold": 1, "unknown": 5}')
    (tmp_path / "brute.json").write_text("{not json")
    (tmp_path / "ddos.json").write_text('{"udp_amplification_multipliers": {"53": 0.1}, "proto_scope": ["udp"]}')
    loaded = settings.load_profile(spark, str(tmp_path))
    assert loaded.scan.pair_threshold_short == 3 and loaded.scan.s0_ratio_threshold == 1.0
    assert loaded.brute == DEFAULT.brute and loaded.dns == DEFAULT.dns
    assert loaded.ddos.udp_amplification_multipliers == {"53": 0.1} and loaded.ddos.proto_scope == ("udp",)
    assert settings.load_profile(spark, str(tmp_path / "none"), LAB) == LAB
    narrow = with_windows(DEFAULT, 5, 60)
    assert (narrow.scan.short_window_seconds, narrow.brute.short_window_seconds, narrow.brute.slow_window_seconds) == (5, 60, 600)
    with pytest.raises(ValueError):
        profile("labs")


def test_yaml_settings(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "map.yml").write_text('map:\n  "ssl": "tls"\ndefault: "misc"\n')
    assert settings.load_service_map(spark, str(tmp_path / "map.yml")) == ({"ssl": "tls"}, "misc")
    assert settings.load_service_map(spark, None) == ({}, "other")
    (tmp_path / "thr.yml").write_text(settings.thresholds_yaml(settings.Thresholds(0.61)))
    assert settings.load_threshold(spark, str(tmp_path / "thr.yml")) == 0.61
    assert settings.load_threshold(spark, str(tmp_path / "no.yml")) == 0.5


def test_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "alerts")
    assert sinks.read_batches(spark, path, RULE_ALERT).count() == 0
    alerts = spark.createDataFrame([(86400.0 * i, f"t{i}") for i in range(3)], "ts_generated double, type string")
    for batch in (0, 1, 1):
        sinks.append_batch(alerts, path, batch, "ts_generated")
    assert sinks.read_batches(spark, path, RULE_ALERT).count() == 6
    recent = sinks.read_since(spark, path, RULE_ALERT, "ts_generated", 90000.0)
    assert {r.type for r in recent.collect()} == {"t2"}
    assert "PartitionFilters: [isnotnull(event_date" in recent._jdf.queryExecution().executedPlan().toString()


def test_ban_state_versions(spark, tmp_path):
    store = sinks.BanState(spark, str(tmp_path / "state"))
    assert store.load().count() == 0
    for version in (0, 1):
        store.save(spark.createDataFrame([("1.1.1.1", float(version))], BAN_STATE), version)
    assert store.load().first().last_added_ts == 1.0
    assert store.load(before=1).first().last_added_ts == 0.0


def test_reports_and_csv(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    sinks.write_report(df, str(tmp_path / "r"))
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "r")).count() == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["k", "n"]


def pooled(points):
    """Pool adjacent violators over (score, label) pairs, in plain Python."""
    merged = {}
    for s, y in points:
        total, n = merged.get(s, (0.0, 0))
        merged[s] = (total + y, n + 1)
    blocks = []
    for s in sorted(merged):
        blocks.append([merged[s][0], merged[s][1], [s]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            total, n, scores = blocks.pop()
            blocks[-1][0] += total
            blocks[-1][1] += n
            blocks[-1][2] += scores
    return {s: total / n for total, n, scores in blocks for s in scores}


def test_learning_round_trip(spark, tmp_path):
    rows = [(f"u{i}", i % 3, int(i % 4 == 0), float(i % 4 == 0) + (i % 7) / 10, float(i % 5)) for i in range(120)]
    df = spark.createDataFrame(rows, "uid string, fold int, y_bin int, a double, b double")
    data = learning.assemble(df, ["a", "b"]).cache()
    cfg = learning.TrainConfig(rounds=2, depth=2, learning_rate=0.3, min_leaf_rows=1, row_share=1.0)
    models = [x.model for x in learning.train_folds(data, 2, cfg)]
    sinks.save_models(models, str(tmp_path / "models"))
    loaded = sinks.load_models(spark, str(tmp_path / "models"))
    assert len(loaded) == 2
    with pytest.raises(FileNotFoundError):
        sinks.load_models(spark, str(tmp_path / "none"))
    oof = learning.out_of_fold(data.where("fold < 2"), loaded)
    assert oof.count() == 80
    points = [(r.p_raw, r.y_bin) for r in oof.select("p_raw", "y_bin").collect()]
    calibrator = learning.fit_isotonic(oof)
    expected = pooled(points)
    for r in learning.calibrate(oof.select("uid", "p_raw"), calibrator).collect():
        assert r.p_cal == pytest.approx(expected[r.p_raw])
    outside = spark.createDataFrame([(-5.0,), (5.0,), (None,), (float("nan"),)], "p_raw double")
    ends = [r.p_cal for r in learning.calibrate(outside, calibrator).collect()]
    assert ends[0] == min(expected.values()) and ends[1] == max(expected.values()) and ends[2] == ends[3]
    final = learning.ensemble_score(data, loaded, calibrator, 0.5)
    assert {"p_raw", "p_cal", "pred", "margin"} <= set(final.columns) and final.count() == 120
    data.unpersist()
    assert final.where(F.col("pred").isNull()).count() == 0


def test_ban_state_reads_only_complete_versions(spark, tmp_path):
    store = sinks.BanState(spark, str(tmp_path / "state"))
    rows = lambda t: spark.createDataFrame([("1.1.1.1", t)], BAN_STATE)
    assert store.load().count() == 0
    store.save(rows(1.0), 0)
    store.save(rows(2.0), 1)
    (tmp_path / "state" / "version=1" / "_SUCCESS").unlink()
    assert store.load().first().last_added_ts == 1.0
    assert store.load(before=0).count() == 0


def test_corrupt_files_are_an_error_unless_skipped(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([(1,), (2,)], "a int").coalesce(1).write.parquet(path)
    (tmp_path / "rows" / "broken.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        logs.scan_or_empty(spark, path, T.StructType([T.StructField("a", T.IntegerType())])).count()
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert logs.scan_or_empty(spark, path, schema, skip_corrupt=True).count() == 2
    assert [r.file.rsplit("/", 1)[-1] for r in logs.skipped_files(spark, path, schema).collect()] == ["broken.parquet"]


def test_thresholds_round_trip_with_their_targets(spark, tmp_path):
    given = settings.Thresholds(0.61, 0.9, 0.02)
    settings.save_thresholds(spark, given, str(tmp_path / "thresholds"))
    assert settings.load_thresholds(spark, str(tmp_path / "thresholds")) == given
