"""Registered queries of settings, sinks and state that are written and read back, with their SQL counterparts."""

from __future__ import annotations

import dataclasses
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowvigil.config import FIXTURE, BanConfig
from flowvigil.operators import detectors as d, prepare, profile, response, rollup as r
from flowvigil.plans.alert_queries import _ALERTS, rule_alerts
from flowvigil.plans.rule_queries import _with_rows, port_scan_sql, readable
from flowvigil.plans.sample_flows import DUCKDB_FLOWS, load_flows
from flowvigil.schema import BAN_DECISION, RULE_ALERT
from flowvigil.sources import settings, sinks
from flowvigil.staging import Staging

#: What the rule file changes; all else stays as in the fixture profile.
RULE_FILE = {"unique_dst_threshold_short": 6, "pair_threshold_short": 9, "s0_ratio_threshold": 0.6}
SERVICE_FILE = "default: nothing\nmap:\n  mdns: names\n  '-': absent\n"
#: Batches of the ban replay, and its bans: a new ban one day after the last one at the earliest.
BATCHES = 6
REPLAY = BanConfig(proof_min=2, cooldown_seconds=6 * 86_400, ban_limit=0)


def _rule_files(spark: SparkSession, folder: str) -> DataFrame:
    """Port scans under a profile whose scan settings come from a rule file."""
    staging = Staging(spark)
    sinks.write_text(spark, json.dumps(RULE_FILE), (path := staging.path("rules")) + "/scan.json")
    read = settings.load_profile(spark, path, FIXTURE)
    base = staging.table(r.rollup(load_flows(spark, folder), read.slot_seconds()), "rollup")
    alerts = readable(d.detect(d.port_scan(base, read.scan), staging))
    return alerts.select("attacker_ip", "total", "uniq_hosts", "uniq_ports", "fail_ratio", "type", "severity")


def _service_file(spark: SparkSession, folder: str) -> DataFrame:
    """Service names under a mapping from a file."""
    sinks.write_text(spark, SERVICE_FILE, path := Staging(spark).path("services"))
    mapping, default = settings.load_service_map(spark, path)
    return prepare.with_service_norm(load_flows(spark, folder), mapping, default).select("uid", "service_norm")


def _csv_report(spark: SparkSession, folder: str) -> DataFrame:
    sinks.write_csv(rule_alerts(spark, folder).groupBy("type").agg(F.count("*").alias("n")), path := Staging(spark).path("counts"))
    return spark.read.option("header", True).schema("type string, n bigint").csv(path)


def _json_report(spark: SparkSession, folder: str) -> DataFrame:
    sinks.write_report(profile.null_rates(load_flows(spark, folder)).where("null_rate > 0"), path := Staging(spark).path("report"))
    return spark.read.schema("column_name string, null_rate double").json(path)


def _appended(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts in batches, one of them run twice, and only those of the last ten days read back."""
    path, alerts = Staging(spark).path("alerts"), rule_alerts(spark, folder)
    rows = alerts.select(*[(F.col(x.name) if x.name in alerts.columns else F.lit(None)).cast(x.dataType).alias(x.name) for x in RULE_ALERT.fields])
    part = F.pmod(F.floor("ts_generated"), F.lit(3))
    for batch in (0, 1, 1, 2):
        sinks.append_batch(rows.where(part == batch), path, batch, "ts_generated")
    newest = rows.agg(F.max("ts_generated")).first()[0]
    read = sinks.read_since(spark, path, RULE_ALERT, "ts_generated", (newest or 0.0) - 10 * 86_400)
    return readable(read.select("ts_generated", "type", "severity", "attacker_ip", "target_ip")).withColumn("batch", F.pmod(F.floor("ts_generated"), F.lit(3)))


def _ban_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Bans over six batches of alerts: an address is banned, held back while it cools down, and banned again."""
    staging = Staging(spark)
    alerts = staging.table(rule_alerts(spark, folder).withColumn("source", F.lit("rules")), "alerts")
    first, last = alerts.agg(F.min("ts_generated"), F.max("ts_generated")).first()
    store, bans = sinks.BanState(spark, staging.path("state")), staging.path("bans")
    if first is None:
        return spark.createDataFrame([], BAN_DECISION).select(F.lit(0).alias("batch"), "ip", "n_rows")
    width = (last - first) / BATCHES
    for batch in range(BATCHES):
        upto = last + 1 if batch == BATCHES - 1 else first + width * (batch + 1)
        ts, now = F.col("ts_generated"), first + width * (batch + 1)
        state = store.load(before=batch)
        decided = response.ban_decisions(
            alerts.where((ts >= first + width * batch) & (ts < upto)), state, now, REPLAY, response.whitelist(spark)
        )
        sinks.append_batch(decided, bans, batch, "added_ts")
        done = sinks.read_batches(spark, bans, BAN_DECISION).where(F.col("batch") == batch)
        store.save(response.updated_state(state, done, expired=now - REPLAY.cooldown_seconds), batch)
    rows = sinks.read_batches(spark, bans, BAN_DECISION)
    return rows.select(F.col("batch").cast("int").alias("batch"), "ip", "n_rows")


QUERIES = {
    "rule_files": _rule_files,
    "service_file": _service_file,
    "csv_report": _csv_report,
    "json_report": _json_report,
    "appended_alerts": _appended,
    "ban_replay": _ban_replay,
}

_RULES = f"WITH {DUCKDB_FLOWS}, rules AS ({_ALERTS.format(flows='flows')})"

ORACLE = {
    "rule_files": _with_rows(port_scan_sql(dataclasses.replace(FIXTURE.scan, **RULE_FILE))),
    # The sample's services, by the rule: TLS drops from a list, TLS over HTTP has a name, then the mapping, then the name.
    "service_file": f"""WITH {DUCKDB_FLOWS} SELECT uid, CASE coalesce(service, '') WHEN '' THEN 'nothing' WHEN 'quic,ssl' THEN 'quic_tls'
      WHEN 'ssl' THEN 'ssl' WHEN 'ssl,http' THEN 'http_tls' WHEN 'mdns' THEN 'names' WHEN '-' THEN 'absent' END AS service_norm FROM flows""",
    "csv_report": f"{_RULES} SELECT type, count(*) AS n FROM rules GROUP BY type",
    "json_report": f"""WITH {DUCKDB_FLOWS} SELECT 'service' AS column_name, round(avg(CAST(service IS NULL AS INT)), 4) AS null_rate
      FROM flows HAVING avg(CAST(service IS NULL AS INT)) > 0""",
    "appended_alerts": f"""{_RULES} SELECT round(ts_generated, 6) AS ts_generated, type, severity, coalesce(attacker_ip, '') AS attacker_ip,
      coalesce(target_ip, '') AS target_ip, CAST(floor(round(ts_generated, 6)) AS BIGINT) % 3 AS batch
      FROM rules WHERE ts_generated >= (SELECT max(ts_generated) FROM rules) - 864000""",
    "ban_replay": f"""WITH RECURSIVE {DUCKDB_FLOWS}, rules AS ({_ALERTS.format(flows='flows')}),
  span AS (SELECT min(ts_generated) AS first, max(ts_generated) AS last, (max(ts_generated) - min(ts_generated)) / {BATCHES} AS width FROM rules),
  batches AS (SELECT b AS batch, first + width * (b + 1) AS now, first + width * b AS since,
    CASE WHEN b = {BATCHES - 1} THEN last + 1 ELSE first + width * (b + 1) END AS upto FROM span, generate_series(0, {BATCHES - 1}) g(b)),
  cand AS (SELECT batch, now, attacker_ip AS ip, count(*) AS n_rows FROM rules JOIN batches ON ts_generated >= since AND ts_generated < upto
    WHERE lower(trim(severity)) IN ('med', 'high') AND attacker_ip IS NOT NULL AND attacker_ip NOT IN ('nan', '127.0.0.1', '::1')
    GROUP BY ALL HAVING count(*) >= {REPLAY.proof_min}),
  replay AS (
    SELECT 0 AS batch, ip, n_rows, now AS last, true AS banned FROM cand WHERE batch = 0
    UNION ALL
    SELECT n.batch, coalesce(c.ip, p.ip), c.n_rows, CASE WHEN c.ip IS NOT NULL AND n.now - coalesce(p.last, 0) >= {REPLAY.cooldown_seconds} THEN n.now ELSE p.last END,
      c.ip IS NOT NULL AND n.now - coalesce(p.last, 0) >= {REPLAY.cooldown_seconds}
    FROM (SELECT * FROM batches WHERE batch = (SELECT max(batch) + 1 FROM replay)) n,
      ((SELECT * FROM replay WHERE last IS NOT NULL) p FULL JOIN (SELECT * FROM cand WHERE batch = (SELECT max(batch) + 1 FROM replay)) c ON p.ip = c.ip))
  SELECT CAST(batch AS INT) AS batch, ip, n_rows FROM replay WHERE banned""",
}
