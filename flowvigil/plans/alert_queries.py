"""Registered queries of alerts, bans and browsing, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowvigil.config import BanConfig, MergeConfig
from flowvigil.functions.coercion import text_or
from flowvigil.operators import alerts as a, browse, detectors as d, response
from flowvigil.operators.profile import frequencies
from flowvigil.plans.sample_flows import DUCKDB_FLOWS, load_flows

DAY = 86400
THRESHOLD = 0.8
MERGE = MergeConfig(max_rows=0, window_seconds=21 * DAY, cooldown_seconds=9 * DAY)
BANS = BanConfig(since_seconds=20 * DAY, proof_min=3, ban_limit=40, cooldown_seconds=6 * DAY, exclude_types=("none",))
ALLOWED = ("10.0.0.9", "10.0.0.17", "not-an-address", "45.33.0.1")

# Rule-like alerts, one per attack flow; the same text on both engines.
_ALERTS = """SELECT ts AS ts_generated, attack_type AS type,
  CASE WHEN resp_p < 100 THEN 'high' WHEN resp_p < 2000 THEN ' Med ' ELSE 'low' END AS severity,
  CASE WHEN orig_pkts % 10 = 9 THEN NULL WHEN orig_pkts % 10 = 8 THEN 'nan' ELSE orig_h END AS attacker_ip,
  CASE WHEN attack_type = 'port_scan' THEN NULL ELSE resp_h END AS target_ip
FROM {flows} WHERE label = 'attack'"""


def scored_flows(spark: SparkSession, folder: str) -> DataFrame:
    flows = load_flows(spark, folder).drop("label", "attack_type")
    return a.with_prediction(flows.withColumn("p_cal", F.col("p_raw")), THRESHOLD)


def rule_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(_ALERTS, flows=load_flows(spark, folder))


def _merged(spark, folder, cfg: MergeConfig = MERGE, previous: DataFrame | None = None) -> DataFrame:
    flagged, _ = a.split_scored(scored_flows(spark, folder))
    rules = rule_alerts(spark, folder)
    return a.merge_alerts(flagged, rules, d.latest(rules, "ts_generated"), cfg, previous)


def _shown(df: DataFrame) -> DataFrame:
    columns = []
    for name, dtype in df.dtypes:
        if dtype == "string":
            columns.append(text_or(name, "").alias(name))
        elif dtype == "double":
            columns.append(F.round(F.coalesce(name, F.lit(-1.0)), 6).alias(name))
        else:
            columns.append(F.coalesce(name, F.lit(-1)).cast(dtype).alias(name))
    return df.select(*columns)


def _earlier(spark, folder) -> DataFrame:
    """Alerts merged before: the severe ones, each stamped when it was generated."""
    rules = rule_alerts(spark, folder).where("severity = 'high'")
    return rules.select("type", "attacker_ip", "target_ip", F.col("ts_generated").alias("ts_merged"))


def _ban_state(spark, folder) -> DataFrame:
    severe = rule_alerts(spark, folder).where("severity = 'high' AND type = 'ddos'")
    return severe.groupBy(F.col("attacker_ip").alias("ip")).agg(
        F.max("ts_generated").alias("last_added_ts")
    ).where("ip IS NOT NULL")


def _decisions(spark, folder) -> DataFrame:
    rules = rule_alerts(spark, folder).withColumn("source", F.lit("RULES"))
    return response.ban_decisions(
        rules, _ban_state(spark, folder), d.latest(rules, "ts_generated"), BANS,
        response.whitelist(spark, ALLOWED),
    )


def _split(spark, folder) -> DataFrame:
    flagged, passed = a.split_scored(scored_flows(spark, folder))
    return flagged.select("uid", "pred").unionByName(passed.select("uid", "pred"))


def _ban_log(spark, folder) -> DataFrame:
    """A log with one ban line per severe alert, between lines of other kinds."""
    rules = rule_alerts(spark, folder).where("attacker_ip IS NOT NULL")
    bans = response.ban_log(
        rules.select(
            F.col("attacker_ip").alias("ip"),
            F.col("ts_generated").alias("added_ts"),
            (F.col("ts_generated") + 600).alias("expires_ts"),
            F.lit("ml_blacklist").alias("set_name"),
            "severity",
        ).where("severity = 'high'")
    )
    other = rules.where("severity <> 'high'").select(
        F.col("ts_generated").alias("ts"),
        F.col("attacker_ip").alias("ip"),
        F.concat(F.lit("[actions] skip "), F.col("attacker_ip")).alias("line"),
    )
    return bans.unionByName(other)


QUERIES = {
    "ml_split": _split,
    "margin": lambda s, f: scored_flows(s, f).select("uid", "pred", F.round("margin", 6).alias("margin")),
    "merge_alerts": lambda s, f: _shown(_merged(s, f).drop("reason")),
    "merge_newest": lambda s, f: _shown(
        a.newest_rows(rule_alerts(s, f), 200).select("ts_generated", "type", "severity")
    ),
    "cooldown": lambda s, f: _shown(
        _merged(s, f, previous=_earlier(s, f)).select(
            "uid", "type", "severity", "attacker_ip", "target_ip", "source"
        )
    ),
    "first_alerts": lambda s, f: _shown(
        a.first_per_identity(
            rule_alerts(s, f).withColumnRenamed("ts_generated", "ts")
        ).select("ts", "type", "attacker_ip", "target_ip")
    ),
    "alert_counts": lambda s, f: _shown(
        frequencies(_merged(s, f), ["source", "type", "severity"], 5)
    ),
    "ban_candidates": lambda s, f: _shown(_decisions(s, f)),
    "ban_state_update": lambda s, f: _shown(
        response.updated_state(_ban_state(s, f), _decisions(s, f))
    ),
    "alerts_browse": lambda s, f: _shown(browse.browse_alerts(_merged(s, f), "med", ("RULES", "ml"))),
    "alerts_browse_all": lambda s, f: _shown(browse.browse_alerts(_merged(s, f), "low", (), limit=1000)),
    "recent_bans": lambda s, f: _shown(browse.recent_bans(_ban_log(s, f))),
}

_BASE = f"""WITH {DUCKDB_FLOWS}, rules AS ({_ALERTS.format(flows='flows')}),
scored AS (SELECT *, p_raw AS p_cal, CAST(p_raw > {THRESHOLD} + 1e-12 AS INT) AS pred, p_raw - {THRESHOLD} AS margin FROM flows),
clock AS (SELECT max(ts_generated) AS now FROM rules),
merged AS (
  SELECT ts, uid, orig_h, orig_p, resp_h, resp_p, proto, coalesce(service, '') AS service, conn_state, p_cal, pred,
         round(margin, 6) AS margin, NULL::VARCHAR AS type, NULL::VARCHAR AS severity, NULL::VARCHAR AS attacker_ip,
         NULL::VARCHAR AS target_ip, 'ml' AS source
  FROM scored WHERE pred = 1 AND ts >= (SELECT max(ts) FROM scored WHERE pred = 1) - {MERGE.window_seconds}
  UNION ALL
  SELECT -1, '', '', -1, '', -1, '', '', '', -1, -1, -1, type, severity, attacker_ip, target_ip, 'rules'
  FROM rules WHERE ts_generated >= (SELECT max(ts_generated) FROM rules) - {MERGE.window_seconds})"""
_STATE = """state AS (SELECT attacker_ip AS ip, max(ts_generated) AS last FROM rules
  WHERE severity = 'high' AND type = 'ddos' AND attacker_ip IS NOT NULL GROUP BY ALL)"""
_DECIDED = f"""cand AS (SELECT attacker_ip AS ip, count(*) AS n_rows FROM rules, clock
  WHERE ts_generated >= now - {BANS.since_seconds} AND lower(trim(severity)) IN ('med', 'high') AND type <> 'none'
    AND attacker_ip IS NOT NULL AND attacker_ip <> 'nan'
    AND attacker_ip NOT IN ('127.0.0.1', '::1', '10.0.0.9', '10.0.0.17', '45.33.0.1')
  GROUP BY ALL HAVING count(*) >= {BANS.proof_min}),
decided AS (SELECT ip, n_rows, now AS added_ts, now + {BANS.block_seconds} AS expires_ts, 'ml_blacklist' AS set_name
  FROM cand LEFT JOIN state USING (ip), clock WHERE now - coalesce(last, 0) >= {BANS.cooldown_seconds}
  ORDER BY n_rows DESC, ip LIMIT {BANS.ban_limit})"""

# All alerts carry one stamp: the newest flow first, then the other columns in the order shown.
_BROWSED = """SELECT round(ts, 6) AS ts, round(now, 6) AS ts_merged, source, coalesce(type, '') AS type,
  lower(trim(coalesce(severity, ''))) AS severity, coalesce(attacker_ip, '') AS attacker_ip, coalesce(target_ip, '') AS target_ip,
  proto, service, resp_p, margin, p_cal FROM merged, clock"""
_BROWSE_ORDER = """merged.ts DESC, source, coalesce(type, ''), lower(trim(coalesce(severity, ''))), coalesce(attacker_ip, ''),
  coalesce(target_ip, ''), proto, service, resp_p, margin, p_cal"""

ORACLE = {
    "ml_split": f"{_BASE} SELECT uid, pred FROM scored",
    "margin": f"{_BASE} SELECT uid, pred, round(margin, 6) AS margin FROM scored",
    "merge_alerts": f"""{_BASE} SELECT round(ts, 6) AS ts, uid, orig_h, orig_p, resp_h, resp_p, proto, service, conn_state,
      p_cal, pred, margin, coalesce(type, '') AS type, coalesce(severity, '') AS severity,
      coalesce(attacker_ip, '') AS attacker_ip, coalesce(target_ip, '') AS target_ip, source,
      round(now, 6) AS ts_merged FROM merged, clock""",
    "merge_newest": f"""{_BASE} SELECT round(ts_generated, 6) AS ts_generated, type, severity FROM rules
      ORDER BY rules.ts_generated DESC, type, severity, attacker_ip NULLS FIRST, target_ip NULLS FIRST LIMIT 200""",
    "cooldown": f"""{_BASE} SELECT uid, coalesce(type, '') AS type, coalesce(severity, '') AS severity,
      coalesce(attacker_ip, '') AS attacker_ip, coalesce(target_ip, '') AS target_ip, source FROM merged m
      WHERE m.source = 'ml' OR NOT EXISTS (SELECT 1 FROM rules p, clock WHERE p.severity = 'high'
        AND p.ts_generated >= now - {MERGE.cooldown_seconds} AND p.type IS NOT DISTINCT FROM m.type
        AND p.attacker_ip IS NOT DISTINCT FROM m.attacker_ip AND p.target_ip IS NOT DISTINCT FROM m.target_ip)""",
    "first_alerts": f"""{_BASE} SELECT round(min(ts_generated), 6) AS ts, type, coalesce(attacker_ip, '') AS attacker_ip,
      coalesce(target_ip, '') AS target_ip FROM rules GROUP BY ALL""",
    "alert_counts": f"""{_BASE} SELECT source, coalesce(type, '') AS type, coalesce(severity, '') AS severity, count(*) AS n
      FROM merged GROUP BY ALL ORDER BY n DESC, source, type, severity LIMIT 5""",
    "ban_candidates": f"""{_BASE}, {_STATE}, {_DECIDED} SELECT ip, n_rows, round(added_ts, 6) AS added_ts,
      round(expires_ts, 6) AS expires_ts, set_name FROM decided""",
    "ban_state_update": f"""{_BASE}, {_STATE}, {_DECIDED} SELECT ip, round(max(t), 6) AS last_added_ts FROM (
      SELECT ip, last AS t FROM state UNION ALL SELECT ip, added_ts FROM decided) GROUP BY ip""",
    "alerts_browse": f"{_BASE} {_BROWSED} WHERE lower(trim(severity)) IN ('med', 'high') ORDER BY {_BROWSE_ORDER} LIMIT 500",
    "alerts_browse_all": f"{_BASE} {_BROWSED} ORDER BY {_BROWSE_ORDER} LIMIT 1000",
    "recent_bans": f"""{_BASE}, log AS (SELECT ts_generated AS ts, attacker_ip AS ip,
        CASE WHEN severity = 'high' THEN 'ipset add ml_blacklist ' || attacker_ip || ' timeout 600'
             ELSE '[actions] skip ' || attacker_ip END AS line FROM rules WHERE attacker_ip IS NOT NULL),
      tail AS (SELECT * FROM log ORDER BY ts DESC, line DESC LIMIT 400)
      SELECT round(ts, 6) AS ts, ip, line FROM tail WHERE contains(line, 'ipset add') ORDER BY tail.ts DESC, line DESC LIMIT 10""",
}
