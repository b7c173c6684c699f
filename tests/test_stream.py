"""The live loop over files that arrive one after the other, with a restart in between."""

import random

from pyspark.sql import functions as F

from flowvigil.config import LAB, BanConfig, MergeConfig, override
from flowvigil.operators import detectors as d
from flowvigil.schema import RULE_ALERT
from flowvigil.streaming import live
import dataclasses

SCHEMA = (
    "ts double, uid string, orig_h string, orig_p int, resp_h string, resp_p int, proto string, service string, "
    "conn_state string, history string, duration double, orig_bytes double, resp_bytes double, orig_pkts bigint, resp_pkts bigint"
)


def flows(start, n, seed):
    rng = random.Random(seed)
    return [
        (start + i * 0.3, f"{seed}-{i}", f"10.0.0.{rng.randrange(1, 5)}", 50000, f"10.1.0.{rng.randrange(30)}", rng.randrange(1, 90),
         "tcp", None, rng.choice(["REJ", "SF", "OTH"]), "S", 0.1, 1.0, 1.0, 1, 1)
        for i in range(n)
    ]


def test_two_files_and_a_restart(spark, tmp_path):
    landing = tmp_path / "landing"
    profile = dataclasses.replace(LAB, fast_scan=override(LAB.fast_scan, {"min_ports": 6}))
    first = spark.createDataFrame(flows(1000.0, 150, 1), SCHEMA)
    second = spark.createDataFrame(flows(1060.0, 150, 2), SCHEMA)
    run = live.LiveRun(
        folder=str(tmp_path / "live"), flow_schema=first.schema, profile=profile,
        score=lambda batch: batch.withColumns({"p_raw": F.lit(0.1), "p_cal": F.when(F.col("resp_p") == 7, 0.9).otherwise(0.1)}),
        threshold=0.8, merge=MergeConfig(cooldown_seconds=300), ban=BanConfig(only_latest=True), clock=None,
    )

    def stream():
        return spark.readStream.schema(first.schema).parquet(str(landing))

    first.coalesce(1).write.parquet(str(landing))
    live.start_live(run, stream()).awaitTermination()
    second.coalesce(1).write.mode("append").parquet(str(landing))
    live.start_live(run, stream()).awaitTermination()
    # Nothing new: another start changes nothing.
    live.start_live(run, stream()).awaitTermination()

    scored = run.table(spark, "scored")
    assert scored.count() == 300 and scored.select("uid").distinct().count() == 300
    now = scored.agg(F.max("ts")).first()[0]
    passed = scored.where("pred = 0")
    batch_alerts = d.run_rules(passed, profile, now).unionByName(d.detect_fast_scan(passed, profile.fast_scan))
    live_alerts = run.table(spark, "rule_alerts").where("batch = 1").select(*RULE_ALERT.names)
    assert batch_alerts.count() > 0
    assert batch_alerts.exceptAll(live_alerts).count() == 0 and live_alerts.exceptAll(batch_alerts).count() == 0

    merged = run.table(spark, "merged_alerts")
    assert merged.where("source = 'ml'").count() == scored.where("pred = 1").count()
    # Alerts of the first batch are still cooling down in the second.
    keys = ["type", "attacker_ip", "target_ip"]
    again = merged.where("source = 'rules'").groupBy(*keys).agg(F.countDistinct("batch").alias("n"))
    assert again.where("n > 1").count() == 0

    bans = run.table(spark, "bans")
    assert 0 < bans.count() == bans.select("ip").distinct().count()

    # A batch that runs again after a failure replaces what it wrote.
    before = {t: run.table(spark, t).count() for t in ("scored", "rule_alerts", "merged_alerts", "bans")}
    live.process_batch(run, second, 1)
    assert {t: run.table(spark, t).count() for t in before} == before


def test_a_backlog_loses_no_alert(spark, tmp_path):
    """Twenty flagged flows spread over hours, in one batch, with the default settings."""
    rows = [(1000.0 + 600 * i, f"u{i}", "10.0.0.1", 1, "10.1.0.1", 7, "tcp", None, "SF", "S", 0.1, 1.0, 1.0, 1, 1) for i in range(20)]
    given = spark.createDataFrame(rows, SCHEMA)
    run = live.LiveRun(
        folder=str(tmp_path / "live"), flow_schema=given.schema, profile=LAB, threshold=0.8, clock=None,
        score=lambda batch: batch.withColumns({"p_raw": F.lit(0.9), "p_cal": F.lit(0.9)}),
    )
    live.process_batch(run, given, 0)
    assert run.table(spark, "merged_alerts").where("source = 'ml'").count() == 20


def test_stream_cooldown_keeps_unidentified_alerts_and_later_repeats(spark, tmp_path):
    schema = "ts double, type string, attacker_ip string, target_ip string"
    first = [(0.0, "x", "a", None), (10.0, "x", "a", None), (20.0, None, None, None), (21.0, None, None, None)]
    later = [(100600.0, "x", "a", None), (100601.0, None, None, None)]
    landing = str(tmp_path / "landing")
    stream = lambda: live.first_within_watermark(live.with_watermark(spark.readStream.schema(schema).parquet(landing), "60 seconds"))
    for rows in (first, [(100000.0, "y", "b", None)], [(100500.0, "z", "c", None)], later):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        live.write_updates(stream(), str(tmp_path / "out")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out" / "rows"))
    assert found.where("type is null").count() == 3
    repeats = sorted(r.ts for r in found.where("type = 'x'").collect())
    assert len(repeats) == 2 and repeats[0] <= 10.0 and repeats[1] == 100600.0
