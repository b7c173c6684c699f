"""Registered queries of sources and streams, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowvigil.config import FIXTURE, BanConfig, MergeConfig
from flowvigil.plans.rule_queries import WHOLE_RANGE, readable, rules_union_sql
from flowvigil.plans.alert_queries import _ALERTS
from flowvigil.plans.sample_flows import DUCKDB_FLOWS, flows_of, load_flows
from flowvigil.schema import FLOW, RULE_ALERT, SCORED_FLOW
from flowvigil.sources import flow_logs as logs
from flowvigil.staging import Staging
from flowvigil.streaming import live

DAY = 86400
THRESHOLD = 0.8
SOURCE_COLUMNS = (
    "ts", "uid", "orig_h", "orig_p", "resp_h", "resp_p", "proto", "service", "conn_state",
    "duration", "orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts", "missed_bytes",
)


def _log(flows: DataFrame) -> DataFrame:
    return flows.select(
        *[F.col(c).cast(FLOW[c].dataType).alias(logs._DOTTED.get(c, c)) for c in SOURCE_COLUMNS], "history"
    )


def _read_back(df: DataFrame) -> DataFrame:
    return df.select(
        "uid", F.round("ts", 6).alias("ts"), "orig_h", "resp_h", "orig_p", "resp_p", "proto",
        F.coalesce("service", F.lit("none")).alias("service"), "conn_state",
        F.coalesce("history", F.lit("none")).alias("history"),
        F.round("duration", 6).alias("duration"), "orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts",
        "missed_bytes",
    )


def _json_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = Staging(spark).path("flows-json")
    # Header text between the records, as a careless exporter leaves it.
    headers = spark.range(3).selectExpr("'[\"ts\",\"uid\"]' AS value")
    _log(load_flows(spark, folder)).select(F.to_json(F.struct("*")).alias("value")).unionByName(
        headers
    ).write.text(path)
    return _read_back(logs.read_flow_json(spark, path))


def _tsv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = Staging(spark).path("flows-tsv")
    flows = load_flows(spark, folder)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in logs.TSV_COLUMNS]
    header = spark.range(1).select(F.lit("#separator \\x09").alias("value"))
    flows.select(F.concat_ws("\t", *fields).alias("value")).unionByName(header).write.text(path)
    return _read_back(logs.read_flow_tsv(spark, path))


def _csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = Staging(spark).path("flows-csv")
    _log(load_flows(spark, folder)).write.option("header", True).csv(path)
    return _read_back(logs.read_csv(spark, path))


def _bad_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh line is too long, every eleventh too short."""
    path = Staging(spark).path("scored-csv")
    flows = load_flows(spark, folder)
    n = F.expr("CAST(substring(uid, 2) AS BIGINT)")
    quoted = [
        F.concat(F.lit('"'), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"')) for c in SOURCE_COLUMNS
    ]
    scores = [F.col("p_raw").cast("string")] * 2 + [F.lit("1"), F.lit("0.5")]
    line = F.concat_ws(",", *quoted, *scores)
    line = F.when(n % 7 == 0, F.concat(line, F.lit(",surplus,")))\
        .when(n % 11 == 0, F.concat_ws(",", *quoted[:6])).otherwise(line)
    flows.select(line.alias("value")).write.text(path)
    rows = logs.read_csv_without_header(spark, path, SCORED_FLOW)
    return rows.select(
        "uid", F.round("ts", 6).alias("ts"), "resp_p",
        F.coalesce("proto", F.lit("none")).alias("proto"),
        F.coalesce("service", F.lit("none")).alias("service"),
        F.coalesce("p_cal", F.lit(-1.0)).alias("p_cal"),
    )


def _tolerant_scan(spark: SparkSession, folder: str) -> DataFrame:
    staging = Staging(spark)
    flows = load_flows(spark, folder).select(*[F.col(f.name).cast(f.dataType) for f in FLOW.fields])
    path = staging.path("flows")
    flows.write.parquet(path)
    there = logs.scan_or_empty(spark, path, FLOW)
    absent = logs.scan_or_empty(spark, staging.path("absent"), FLOW)
    return there.unionByName(absent).select("uid", F.round("ts", 6).alias("ts"), "resp_p")


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream of files."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    # A glob serves a single file as well as a folder of part files.
    return spark.readStream.schema(schema).parquet(f"{folder}/events.parque[t]")


def _tumbling(spark: SparkSession, folder: str) -> DataFrame:
    out = Staging(spark).path("victim-windows")
    windows = live.victim_windows(live.with_watermark(flows_of(event_stream(spark, folder)), "1 day"), DAY)
    live.write_updates(windows, out).awaitTermination()
    rows = live.latest_updates(spark, out, windows.schema, ["window_start", "resp_h"])
    return rows.select("window_start", "resp_h", "n", "orig_pkts")


def live_run(spark: SparkSession, folder: str) -> live.LiveRun:
    flows = flows_of(event_stream(spark, folder))
    run = live.LiveRun(
        folder=Staging(spark).path("live"),
        flow_schema=flows.schema,
        profile=FIXTURE,
        score=lambda batch: batch.withColumn("p_cal", F.col("p_raw")),
        threshold=THRESHOLD,
        merge=MergeConfig(max_rows=0, window_seconds=0, cooldown_seconds=300),
        ban=BanConfig(only_latest=True, proof_min=2),
        look_back=WHOLE_RANGE,
        clock=None,
    )
    live.start_live(run, flows).awaitTermination()
    return run


BACKLOG_FILES = 6
#: Rows of a landed file, about, at most.
ROWS_A_FILE = 100_000


def backlog_run(spark: SparkSession, folder: str) -> live.LiveRun:
    """Default settings over a log that lands in several parts, in time order, one part a batch.

    A part is a JSON file, or as many files as its rows need.
    """
    staging = Staging(spark)
    landing = staging.path("landing")
    flows = load_flows(spark, folder)
    first, last = (flows.agg(f("ts")).scalar() for f in (F.min, F.max))
    parts = flows.withColumn("part", F.least(F.floor((F.col("ts") - first) * BACKLOG_FILES / (last - first)), F.lit(BACKLOG_FILES - 1)))
    parts = staging.table(parts, "parts")
    largest = parts.where(F.col("part").isNotNull()).groupBy("part").count().agg(F.max("count")).first()[0] or 1
    files = -(-largest // ROWS_A_FILE)
    for part in range(BACKLOG_FILES):
        rows = parts.where(F.col("part") == part)
        rows = rows.coalesce(1) if files == 1 else rows.repartition(files, "uid", "ts")
        _log(rows).write.json(f"{landing}/{part}")
    stream = logs.read_flow_json_stream(spark, f"{landing}/*", max_files=files)
    run = live.LiveRun(
        folder=staging.path("live"), flow_schema=stream.schema, profile=FIXTURE, score=_sample_score, threshold=THRESHOLD, clock=None,
    )
    live.start_live(run, stream).awaitTermination()
    return run


def _sample_score(batch: DataFrame) -> DataFrame:
    """The sample's score, from what the log holds of it."""
    mille = F.pmod(F.col("orig_bytes").cast("bigint") * 7 + F.col("orig_pkts") - 1, F.lit(1000))
    return batch.withColumns({c: mille.cast("double") / 1000.0 for c in ("p_raw", "p_cal")})


def _stream_backlog(spark: SparkSession, folder: str) -> DataFrame:
    """Every flagged flow is merged, once, whichever of the batches it came in."""
    merged = backlog_run(spark, folder).table(spark, "merged_alerts")
    return merged.where("source = 'ml'").select("uid", F.round("margin", 6).alias("margin"))


def _stream_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = live_run(spark, folder).table(spark, "rule_alerts")
    # The fast rule has its own query; its alerts are the only scans with a target.
    found = found.where("type <> 'port_scan' OR target_ip IS NULL").select(*RULE_ALERT.names)
    return readable(found.withColumn("ts_generated", F.round("ts_generated", 3)))


def _stream_merged(spark: SparkSession, folder: str) -> DataFrame:
    merged = live_run(spark, folder).table(spark, "merged_alerts")
    return merged.groupBy("source", F.coalesce("type", F.lit("")).alias("type")).agg(F.count("*").alias("n"))


def _stream_bans(spark: SparkSession, folder: str) -> DataFrame:
    bans = live_run(spark, folder).table(spark, "bans")
    return bans.select("ip", "n_rows", "set_name")


def _stream_cooldown(spark: SparkSession, folder: str) -> DataFrame:
    staging = Staging(spark)
    out = staging.path("cooldown")
    alerts = spark.sql(_ALERTS, flows=flows_of(event_stream(spark, folder)))
    timed = live.with_watermark(alerts.withColumn("ts", F.col("ts_generated")), "90 days")
    live.write_updates(live.first_within_watermark(timed), out).awaitTermination()
    rows = spark.read.schema(timed.schema).parquet(f"{out}/rows")
    return readable(rows.select("type", "attacker_ip", "target_ip"))


QUERIES = {
    "flow_json_scan": _json_scan,
    "flow_tsv_scan": _tsv_scan,
    "flow_csv_scan": _csv_scan,
    "flow_csv_badlines": _bad_lines,
    "tolerant_scan": _tolerant_scan,
    "stream_tumbling": _tumbling,
    "stream_rules": _stream_rules,
    "stream_merged": _stream_merged,
    "stream_bans": _stream_bans,
    "stream_cooldown": _stream_cooldown,
    "stream_backlog": _stream_backlog,
}


def _scan_sql(service: str = "service") -> str:
    return f"""WITH {DUCKDB_FLOWS} SELECT uid, round(ts, 6) AS ts, orig_h, resp_h, orig_p, resp_p, proto,
      coalesce({service}, 'none') AS service, conn_state, history, round(duration, 6) AS duration,
      CAST(orig_bytes AS DOUBLE) AS orig_bytes, CAST(resp_bytes AS DOUBLE) AS resp_bytes, orig_pkts, resp_pkts,
      missed_bytes FROM flows"""


_PASSED = f"SELECT * FROM flows WHERE NOT p_raw > {THRESHOLD} + 1e-12"
_FAST = f"""fast AS (SELECT orig_h AS attacker_ip, resp_h AS target_ip
  FROM ({_PASSED} AND proto = 'tcp' AND conn_state IN ('REJ', 'S0')) t
  WHERE ts >= (SELECT max(ts) FROM ({_PASSED} AND proto = 'tcp' AND conn_state IN ('REJ', 'S0'))) - {FIXTURE.fast_scan.window_seconds}
  GROUP BY ALL HAVING count(DISTINCT resp_p) >= {FIXTURE.fast_scan.min_ports})"""
_RULES = f"""WITH {DUCKDB_FLOWS}, {_FAST}, found AS ({rules_union_sql(_PASSED)}),
alerts AS (SELECT type, severity, attacker_ip FROM found
  UNION ALL SELECT 'port_scan', 'med', attacker_ip FROM fast)"""

ORACLE = {
    "flow_json_scan": _scan_sql(),
    "flow_tsv_scan": _scan_sql("nullif(service, '-')"),
    "flow_csv_scan": _scan_sql(),
    "flow_csv_badlines": f"""WITH {DUCKDB_FLOWS}, v AS (SELECT *, CAST(uid[2:] AS BIGINT) % 11 = 0 AS short FROM flows
      WHERE CAST(uid[2:] AS BIGINT) % 7 <> 0)
      SELECT uid, round(ts, 6) AS ts, resp_p, CASE WHEN short THEN 'none' ELSE proto END AS proto,
        CASE WHEN short THEN 'none' ELSE coalesce(service, 'none') END AS service,
        CASE WHEN short THEN -1.0::DOUBLE ELSE p_raw END AS p_cal FROM v""",
    "tolerant_scan": f"WITH {DUCKDB_FLOWS} SELECT uid, round(ts, 6) AS ts, resp_p FROM flows",
    "stream_tumbling": f"""WITH {DUCKDB_FLOWS} SELECT CAST(floor(ts / {DAY}) AS BIGINT) * {DAY} AS window_start, resp_h,
      count(*) AS n, CAST(sum(orig_pkts) AS BIGINT) AS orig_pkts FROM flows GROUP BY ALL""",
    "stream_rules": rules_union_sql(_PASSED),
    "stream_merged": f"""{_RULES} SELECT 'rules' AS source, type, count(*) AS n FROM alerts GROUP BY ALL
      UNION ALL SELECT 'ml', '', count(*) FROM flows WHERE p_raw > {THRESHOLD} + 1e-12""",
    "stream_bans": f"""{_RULES} SELECT attacker_ip AS ip, count(*) AS n_rows, 'ml_blacklist' AS set_name FROM alerts
      WHERE severity IN ('med', 'high') AND attacker_ip <> '' GROUP BY ALL HAVING count(*) >= 2
      ORDER BY n_rows DESC, ip LIMIT 100""",
    "stream_backlog": f"""WITH {DUCKDB_FLOWS} SELECT uid, round(p_raw - {THRESHOLD}, 6) AS margin FROM flows
      WHERE p_raw > {THRESHOLD} + 1e-12""",
    "stream_cooldown": f"""WITH {DUCKDB_FLOWS}, alerts AS ({_ALERTS.format(flows='flows')})
      SELECT DISTINCT type, coalesce(attacker_ip, '') AS attacker_ip, coalesce(target_ip, '') AS target_ip FROM alerts""",
}
