"""Registered queries of the rule statistics and detectors, with their SQL counterparts."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowvigil.config import FIXTURE, BruteConfig, DdosConfig, ScanConfig
from flowvigil.functions.coercion import text_or
from flowvigil.operators import detectors as d, rollup as r
from flowvigil.plans.sample_flows import DUCKDB_FLOWS, load_flows
from flowvigil.staging import Staging

DAY, WEEK = 86400, 604800
WHOLE_RANGE = 60 * DAY
FAIL = "('S0','S1','SH','REJ','RSTO','RSTR','RSTOS0')"
SUCCESS = "('SF','S1','ESTAB')"

# Same thresholds as the fixture profile, but off-focus flows may trigger too.
BRUTE_OFF_FOCUS = dataclasses.replace(
    FIXTURE.brute, require_focus_for_trigger=False, off_focus_multiplier=2.5, ports_focus=(22, 23),
    services_focus=("ssl",), exclude_ports=(3389,),
)
# Same thresholds, but some sources and targets are allowed: they count in all statistics and are in no hit.
ICMP_ALLOWED = dataclasses.replace(
    FIXTURE.icmp_flood, src_ip_whitelist=("10.0.0.10", "45.33.0.6", "10.0.0.3"), dst_ip_whitelist=("192.168.1.7", "8.8.4.8")
)
#: Rows that the newest-rows run of the rules reads.
NEWEST = 3000
DDOS_REFLECTION = dataclasses.replace(
    FIXTURE.ddos,
    s0_ratio_threshold=1.01, syn_noack_mean_threshold=1.01,
    victim_unique_src_threshold_short=30, victim_unique_src_threshold_long=100,
    victim_rows_threshold_short=40, victim_rows_threshold_long=160,
    victim_pairs_threshold_short=38, victim_pairs_threshold_long=150,
    udp_amplification_ports=(53, 123, 1900, 5353),
    udp_amplification_multipliers={"53": 0.4, "1900": 0.5},
)


def _rollup(spark: SparkSession, folder: str) -> tuple[DataFrame, Staging]:
    staging = Staging(spark)
    flows = load_flows(spark, folder)
    return staging.table(r.rollup(flows, FIXTURE.slot_seconds()), "rollup"), staging


def _detector(detector, cfg, columns: list[str]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        base, staging = _rollup(spark, folder)
        return readable(d.detect(detector(base, cfg), staging)).select(*columns)

    return run


def readable(alerts: DataFrame) -> DataFrame:
    """Alerts with missing text as '' and missing counts as -1, ratios to six digits."""
    shown = []
    for name, dtype in alerts.dtypes:
        if dtype == "string":
            shown.append(text_or(name, "").alias(name))
        elif dtype == "bigint":
            shown.append(F.coalesce(name, F.lit(-1).cast("bigint")).alias(name))
        else:
            shown.append(F.round(F.coalesce(name, F.lit(-1.0)), 6).alias(name))
    return alerts.select(*shown)


def _statistics(keys: list[str], names: list[str], where: str = "proto = 'tcp'", **shown: str):
    """Exact statistics per key and window; ``shown`` has the SQL text of columns beside them."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = r.with_windows(r.rollup(load_flows(spark, folder), DAY), DAY, WEEK).where(where)
        found = r.exact_statistics(rows, keys, names)
        kept = [x for x in names if x not in ("syn", "source_ports")]
        return found.select(*keys, *kept, *[F.expr(text).alias(name) for name, text in shown.items()])

    return run


def _rejscan_fast(spark: SparkSession, folder: str) -> DataFrame:
    alerts = d.detect_fast_scan(load_flows(spark, folder), FIXTURE.fast_scan)
    return alerts.select(
        "attacker_ip", "target_ip", "uniq_ports", "type", "severity",
        F.round("ts_generated", 3).alias("ts_generated"),
    )


def _rules_all(spark: SparkSession, folder: str) -> DataFrame:
    flows = load_flows(spark, folder)
    alerts = d.run_rules(
        flows, FIXTURE, d.latest(flows), look_back=WHOLE_RANGE, staging=Staging(spark)
    )
    return readable(alerts.withColumn("ts_generated", F.round("ts_generated", 3)))


def _rules_newest(spark: SparkSession, folder: str) -> DataFrame:
    """The rules over the newest rows only."""
    flows = load_flows(spark, folder)
    alerts = d.run_rules(flows, FIXTURE, d.latest(flows), look_back=WHOLE_RANGE, max_rows=NEWEST, staging=Staging(spark))
    return readable(alerts.withColumn("ts_generated", F.round("ts_generated", 3)))


def _rules_window(spark: SparkSession, folder: str) -> DataFrame:
    flows = load_flows(spark, folder)
    alerts = d.run_rules(flows, FIXTURE, d.latest(flows), staging=Staging(spark))
    return readable(alerts.withColumn("ts_generated", F.round("ts_generated", 3)))


def _fail_ratio(spark: SparkSession, folder: str) -> DataFrame:
    rows = r.with_windows(r.rollup(load_flows(spark, folder), DAY), DAY, WEEK)
    stats = {"n": r.rows_total(), "fails": r.fails_total(), "successes": r.successes_total()}
    return r.group_statistics(rows.where("proto = 'tcp'"), ["orig_h", "short_bin"], stats).withColumn(
        "fail_ratio", F.round(r.ratio(F.col("fails"), F.col("n")), 6)
    )


def _pps_reply_ratio(spark: SparkSession, folder: str) -> DataFrame:
    rows = r.with_windows(r.rollup(load_flows(spark, folder), DAY), DAY, WEEK)
    stats = {c: F.sum(c) for c in ("orig_pkts", "resp_pkts", "duration")}
    sums = r.group_statistics(
        rows.where("proto = 'icmp' AND echo_like"), ["orig_h", "short_bin"], stats
    )
    return sums.select(
        "orig_h",
        "short_bin",
        F.round(F.col("orig_pkts") / F.greatest("duration", F.lit(1.0)), 6).alias("pps"),
        F.round(r.ratio(F.col("resp_pkts"), F.col("orig_pkts")), 6).alias("reply_ratio"),
    )


def _byte_ratio(spark: SparkSession, folder: str) -> DataFrame:
    rows = r.with_windows(r.rollup(load_flows(spark, folder), DAY), DAY, WEEK)
    stats = {c: F.sum(c) for c in ("orig_bytes", "resp_bytes")}
    sums = r.group_statistics(
        rows.where("proto = 'udp' AND resp_p = 53"), ["resp_h", "short_bin"], stats
    )
    sent = F.col("orig_bytes")
    quotient = F.when(sent > 0, F.col("resp_bytes") / F.greatest(sent, F.lit(1.0))).otherwise(0.0)
    return sums.select("resp_h", "short_bin", F.round(quotient, 6).alias("byte_ratio"))


def _approx_distinct(spark: SparkSession, folder: str) -> DataFrame:
    base, _ = _rollup(spark, folder)
    rows = r.with_windows(base, DAY, WEEK)
    keys = ["resp_h", "long_bin"]
    # On its own: beside exact distinct counts every different value would carry sketches.
    near = rows.groupBy(*keys).agg(
        F.approx_count_distinct("orig_h", 0.02).alias("sources_near"),
        F.approx_count_distinct(F.struct("orig_h", "resp_p"), 0.02).alias("pairs_near"),
    )
    exact = r.exact_statistics(rows, keys, ["sources", "source_ports"]).withColumnRenamed("source_ports", "pairs")
    groups = near.join(exact, keys)

    def close(name: str) -> Column:
        # Five standard deviations of the estimate, and one for small counts.
        return F.abs(F.col(f"{name}_near") - F.col(name)) <= F.greatest(0.1 * F.col(name), F.lit(1.0))

    return groups.select(
        "resp_h", "long_bin", "sources", "pairs", close("sources").alias("sources_close"), close("pairs").alias("pairs_close")
    )


def _sketch_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Windows from stored sketches of day slots, beside the exact counts; the sketches are all that is read again."""
    base, staging = _rollup(spark, folder)
    names = ("sources", "source_ports")
    stored = staging.table(r.slot_sketches(base, ["resp_h"], names), "sketches")
    near = r.window_estimates(stored, ["resp_h"], names, WEEK).withColumnsRenamed({x: f"{x}_near" for x in names})
    rows = r.with_windows(base, DAY, WEEK).withColumn("bin", F.col("long_bin"))
    exact = r.exact_statistics(rows, ["resp_h", "bin"], names)

    def close(name: str) -> Column:
        return F.abs(F.col(f"{name}_near") - F.col(name)) <= F.greatest(0.05 * F.col(name), F.lit(1.0))

    return near.join(exact, ["resp_h", "bin"]).select(
        "resp_h", "bin", "n", "sources", "source_ports", *[close(x).alias(f"{x}_close") for x in names]
    )


def _rollup_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = r.rollup(load_flows(spark, folder), DAY)
    return rows.select(
        "orig_h", "resp_h", "resp_p", "proto", "service",
        F.col("echo_like").cast("int").alias("echo_like"), "slot",
        "n", "fails", "successes", "orig_pkts", "resp_pkts",
        F.col("syn").cast("bigint").alias("syn"),
        F.round("duration", 4).alias("duration"),
        F.round("orig_bytes", 2).alias("orig_bytes"),
        F.round("resp_bytes", 2).alias("resp_bytes"),
    )


_ALERT = ["type", "severity"]

QUERIES = {
    "flow_rollup": _rollup_query,
    "stat_src_short": _statistics(
        ["orig_h", "short_bin"], ["n", "fails", "syn", "hosts", "ports", "pairs"],
        syn_mean="round(syn / n, 6)",
    ),
    "stat_src_long": _statistics(["orig_h", "long_bin"], ["hosts", "ports", "pairs"]),
    "stat_victim_short": _statistics(["resp_h", "short_bin"], ["n", "sources", "source_ports"], pairs="source_ports"),
    "stat_victim_long": _statistics(["resp_h", "long_bin"], ["n", "sources", "source_ports"], pairs="source_ports"),
    "stat_pair": _statistics(["orig_h", "resp_h", "short_bin"], ["n"]),
    "stat_pair_port": _statistics(["orig_h", "resp_h", "resp_p", "short_bin"], ["n"]),
    "fail_ratio": _fail_ratio,
    "pps_reply_ratio": _pps_reply_ratio,
    "byte_ratio": _byte_ratio,
    "approx_distinct": _approx_distinct,
    "sketch_windows": _sketch_windows,
    "icmp_allowed": _detector(d.icmp_flood, ICMP_ALLOWED, ["target_ip", "total", "uniq_src", *_ALERT]),
    "rules_newest": _rules_newest,
    "port_scan": _detector(
        d.port_scan, FIXTURE.scan,
        ["attacker_ip", "total", "uniq_hosts", "uniq_ports", "fail_ratio", *_ALERT],
    ),
    "bruteforce": _detector(
        d.bruteforce, FIXTURE.brute,
        ["attacker_ip", "target_ip", "attempts", "uniq_ports", "fail_ratio", *_ALERT],
    ),
    "bruteforce_off_focus": _detector(
        d.bruteforce, BRUTE_OFF_FOCUS,
        ["attacker_ip", "target_ip", "attempts", "uniq_ports", "fail_ratio", *_ALERT],
    ),
    "icmp_flood": _detector(
        d.icmp_flood, FIXTURE.icmp_flood, ["target_ip", "total", "uniq_src", *_ALERT]
    ),
    "dns_flood": _detector(
        d.dns_flood, FIXTURE.dns, ["target_ip", "total", "uniq_src", *_ALERT]
    ),
    "ddos": _detector(
        d.ddos, FIXTURE.ddos, ["target_ip", "total", "uniq_src", "uniq_pairs", *_ALERT]
    ),
    "ddos_reflection": _detector(
        d.ddos, DDOS_REFLECTION, ["target_ip", "total", "uniq_src", "uniq_pairs", *_ALERT]
    ),
    "rejscan_fast": _rejscan_fast,
    "rules_all": _rules_all,
    "rules_window": _rules_window,
}


# --- SQL counterparts: the direct form, statistics joined back to single flows ---

_BINNED = f"""rows_ AS (
  SELECT *, CAST(floor(ts / {DAY}) AS BIGINT) * {DAY} AS sb,
         CAST(floor(ts / {WEEK}) AS BIGINT) * {WEEK} AS lb,
         CASE WHEN conn_state IN {FAIL} THEN 1 ELSE 0 END AS fail,
         CASE WHEN conn_state IN {SUCCESS} THEN 1 ELSE 0 END AS succ,
         CASE WHEN contains(history, 'S') AND NOT contains(lower(history), 'h') THEN 1.0 ELSE 0.0 END AS syn,
         contains(history, 'D') AND NOT contains(history, 'd') AS echo
  FROM {{flows}})"""


def _in(values) -> str:
    values = list(values)
    if not values:
        return "(NULL)"
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def port_scan_sql(c: ScanConfig) -> str:
    return f"""
  t AS (SELECT * FROM rows_ WHERE proto = 'tcp'),
  ss AS (SELECT orig_h, sb, count(*) AS n, count(DISTINCT resp_h) AS h, count(DISTINCT resp_p) AS p,
                count(DISTINCT resp_h || '|' || resp_p) AS hp, avg(fail) AS f, avg(syn) AS y
         FROM t GROUP BY ALL),
  sl AS (SELECT orig_h, lb, count(DISTINCT resp_h) AS h, count(DISTINCT resp_p) AS p,
                count(DISTINCT resp_h || '|' || resp_p) AS hp FROM t GROUP BY ALL),
  vs AS (SELECT resp_h, sb, count(DISTINCT orig_h) AS s FROM t GROUP BY ALL),
  vl AS (SELECT resp_h, lb, count(DISTINCT orig_h) AS s FROM t GROUP BY ALL),
  hit AS (SELECT t.* FROM t JOIN ss USING (orig_h, sb) JOIN sl USING (orig_h, lb)
          JOIN vs USING (resp_h, sb) JOIN vl USING (resp_h, lb)
          WHERE ss.h >= {c.unique_dst_threshold_short} OR ss.p >= {c.unique_port_threshold_short}
             OR ss.hp >= {c.pair_threshold_short} OR sl.h >= {c.unique_dst_threshold_long}
             OR sl.p >= {c.unique_port_threshold_long} OR sl.hp >= {c.pair_threshold_long}
             OR ss.n >= {c.burst_conn_threshold_short} OR ss.f >= {c.s0_ratio_threshold}
             OR ss.y >= {c.syn_noack_threshold} OR vs.s >= {c.victim_unique_src_threshold_short}
             OR vl.s >= {c.victim_unique_src_threshold_long}),
  s AS (SELECT orig_h AS attacker_ip, count(*) AS total, count(DISTINCT resp_h) AS uniq_hosts,
               count(DISTINCT resp_p) AS uniq_ports, round(avg(fail), 6) AS fail_ratio
        FROM hit GROUP BY orig_h)
  SELECT *, 'port_scan' AS type,
    CASE WHEN uniq_hosts >= {c.unique_dst_threshold_long} OR uniq_ports >= {c.unique_port_threshold_long} THEN 'high'
         WHEN uniq_hosts >= {c.unique_dst_threshold_short} OR uniq_ports >= {c.unique_port_threshold_short} THEN 'med'
         ELSE 'low' END AS severity FROM s"""


def bruteforce_sql(c: BruteConfig) -> str:
    off = lambda th: int(th * c.off_focus_multiplier)
    eff = lambda th: f"CASE WHEN gate THEN {th} ELSE {off(th)} END"
    eff_fail = (
        f"CASE WHEN gate THEN {c.fail_ratio_threshold} ELSE {c.fail_ratio_threshold * 1.5} END"
    )
    focus = "AND gate" if c.require_focus_for_trigger else ""
    return f"""
  t AS (SELECT *, (coalesce(resp_p IN {_in(c.ports_focus)}, false)
                   OR coalesce(lower(service) IN {_in(c.services_focus)}, false))
                  AND NOT coalesce(resp_p IN {_in(c.exclude_ports)}, false) AS gate
        FROM rows_ WHERE proto = 'tcp'),
  ss AS (SELECT orig_h, sb, count(*) AS n, avg(fail) AS f, sum(succ) AS ok, avg(syn) AS y FROM t GROUP BY ALL),
  sd AS (SELECT orig_h, resp_h, sb, count(*) AS n FROM t GROUP BY ALL),
  sp AS (SELECT orig_h, resp_h, resp_p, sb, count(*) AS n FROM t GROUP BY ALL),
  vs AS (SELECT resp_h, sb, count(DISTINCT orig_h) AS s FROM t GROUP BY ALL),
  sl AS (SELECT orig_h, lb, count(*) AS n, avg(fail) AS f FROM t GROUP BY ALL),
  hit AS (SELECT t.* FROM t JOIN ss USING (orig_h, sb) JOIN sd USING (orig_h, resp_h, sb)
          JOIN sp USING (orig_h, resp_h, resp_p, sb) JOIN vs USING (resp_h, sb) JOIN sl USING (orig_h, lb)
          WHERE (ss.n >= {eff(c.per_src_attempt_threshold)} OR sd.n >= {eff(c.per_srcdst_attempt_threshold)}
              OR sp.n >= {eff(c.per_srcdstport_attempt_threshold)} OR ss.f >= {eff_fail}
              OR ss.y >= {c.syn_noack_mean_threshold} OR vs.s >= {c.per_dst_multi_src_threshold}
              OR (sl.n >= {c.slow_attempt_threshold} AND sl.f >= {eff_fail}))
            AND ss.ok < {c.success_break_threshold} {focus}),
  s AS (SELECT orig_h AS attacker_ip, resp_h AS target_ip, count(*) AS attempts,
               count(DISTINCT resp_p) AS uniq_ports, round(avg(fail), 6) AS fail_ratio, avg(fail) AS fr
        FROM hit GROUP BY orig_h, resp_h)
  SELECT * EXCLUDE (fr), 'bruteforce' AS type,
    CASE WHEN attempts >= {c.slow_attempt_threshold} OR fr >= 0.9 THEN 'high'
         WHEN attempts >= {c.per_srcdst_attempt_threshold} THEN 'med' ELSE 'low' END AS severity FROM s"""


def _victim_sql(kind: str, short: int, long: int, extra: str = "") -> str:
    return f"""
  s AS (SELECT resp_h AS target_ip, count(*) AS total, count(DISTINCT orig_h) AS uniq_src{extra}
        FROM hit GROUP BY resp_h)
  SELECT *, '{kind}' AS type, CASE WHEN uniq_src >= {long} THEN 'high'
         WHEN uniq_src >= {short} THEN 'med' ELSE 'low' END AS severity FROM s"""


def icmp_flood_sql(c) -> str:
    echo = "AND echo" if c.enforce_echo_like else ""
    listed = [f"t.{name} NOT IN {_in(x)}" for name, x in (("orig_h", c.src_ip_whitelist), ("resp_h", c.dst_ip_whitelist)) if x]
    allowed = "".join(f" AND {x}" for x in listed)
    return f"""
  t AS (SELECT * FROM rows_ WHERE (proto = 'icmp' OR coalesce(lower(service) = 'icmp', false)) {echo}),
  ss AS (SELECT orig_h, sb, count(*) AS n, sum(orig_pkts) / greatest(sum(duration), 1.0) AS pps,
                coalesce(sum(resp_pkts) / nullif(sum(orig_pkts), 0), 0.0) AS rr FROM t GROUP BY ALL),
  sl AS (SELECT orig_h, lb, count(*) AS n FROM t GROUP BY ALL),
  ps AS (SELECT orig_h, resp_h, sb, count(*) AS n FROM t GROUP BY ALL),
  pl AS (SELECT orig_h, resp_h, lb, count(*) AS n FROM t GROUP BY ALL),
  vs AS (SELECT resp_h, sb, count(*) AS n, count(DISTINCT orig_h) AS s FROM t GROUP BY ALL),
  vl AS (SELECT resp_h, lb, count(*) AS n, count(DISTINCT orig_h) AS s FROM t GROUP BY ALL),
  hit AS (SELECT t.* FROM t JOIN ss USING (orig_h, sb) JOIN sl USING (orig_h, lb)
          JOIN ps USING (orig_h, resp_h, sb) JOIN pl USING (orig_h, resp_h, lb)
          JOIN vs USING (resp_h, sb) JOIN vl USING (resp_h, lb)
          WHERE (ss.n >= {c.src_total_threshold_short} OR sl.n >= {c.src_total_threshold_long}
             OR ps.n >= {c.pair_threshold_short} OR pl.n >= {c.pair_threshold_long}
             OR vs.n >= {c.victim_total_threshold_short} OR vs.s >= {c.victim_unique_src_threshold_short}
             OR vl.n >= {c.victim_total_threshold_long} OR vl.s >= {c.victim_unique_src_threshold_long}
             OR (ss.pps >= {c.pps_threshold_short} AND ss.rr <= {c.reply_ratio_max})){allowed}),
  {_victim_sql("icmp_flood", c.victim_unique_src_threshold_short, c.victim_unique_src_threshold_long)}"""


def dns_flood_sql(c) -> str:
    return f"""
  t AS (SELECT * FROM rows_ WHERE proto = 'udp' AND resp_p IN {_in(c.focus_ports)}),
  vs AS (SELECT resp_h, sb, count(*) AS n, count(DISTINCT orig_h) AS s,
                CASE WHEN sum(orig_bytes) > 0 THEN CAST(sum(resp_bytes) AS DOUBLE) / greatest(sum(orig_bytes), 1) ELSE 0.0 END AS ratio
         FROM t GROUP BY ALL),
  vl AS (SELECT resp_h, lb, count(*) AS n, count(DISTINCT orig_h) AS s FROM t GROUP BY ALL),
  hit AS (SELECT t.* FROM t JOIN vs USING (resp_h, sb) JOIN vl USING (resp_h, lb)
          WHERE vs.n >= {c.victim_rows_threshold_short} OR vs.s >= {c.victim_unique_src_threshold_short}
             OR vl.n >= {c.victim_rows_threshold_long} OR vl.s >= {c.victim_unique_src_threshold_long}
             OR (vs.n >= {c.udp_min_rows_for_ratio} AND vs.ratio >= {c.udp_bytes_ratio_threshold})),
  {_victim_sql("dns_flood", c.victim_unique_src_threshold_short, c.victim_unique_src_threshold_long)}"""


def ddos_sql(c: DdosConfig) -> str:
    cases = " ".join(
        f"WHEN resp_p = {p} THEN CAST({c.udp_amplification_multipliers.get(str(p), c.udp_amplification_multiplier)} AS DOUBLE)"
        for p in c.udp_amplification_ports
    )
    factor = f"CASE WHEN proto <> 'udp' THEN 1.0::DOUBLE {cases} ELSE 1.0::DOUBLE END"
    return f"""
  t AS (SELECT *, {factor} AS m FROM rows_ WHERE proto IN {_in(c.proto_scope)}
        AND NOT resp_p IN {_in(c.exclude_ports)}
        AND ((proto = 'tcp' AND resp_p IN {_in(c.tcp_focus_ports)})
          OR (proto = 'udp' AND resp_p IN {_in(c.udp_focus_ports)}))),
  vs AS (SELECT resp_h, sb, count(*) AS n, count(DISTINCT orig_h) AS s,
                count(DISTINCT orig_h || '|' || resp_p) AS sp, avg(fail) AS f, avg(syn) AS y FROM t GROUP BY ALL),
  vl AS (SELECT resp_h, lb, count(*) AS n, count(DISTINCT orig_h) AS s,
                count(DISTINCT orig_h || '|' || resp_p) AS sp FROM t GROUP BY ALL),
  hit AS (SELECT t.* FROM t JOIN vs USING (resp_h, sb) JOIN vl USING (resp_h, lb)
          WHERE vs.s >= {c.victim_unique_src_threshold_short} * m OR vs.n >= {c.victim_rows_threshold_short} * m
             OR vs.sp >= {c.victim_pairs_threshold_short} * m OR vl.s >= {c.victim_unique_src_threshold_long} * m
             OR vl.n >= {c.victim_rows_threshold_long} * m OR vl.sp >= {c.victim_pairs_threshold_long} * m
             OR vs.f >= {c.s0_ratio_threshold} OR vs.y >= {c.syn_noack_mean_threshold}),
  {_victim_sql("ddos", c.victim_unique_src_threshold_short, c.victim_unique_src_threshold_long,
               ", count(DISTINCT orig_h || '|' || resp_p) AS uniq_pairs")}"""


def _with_rows(body: str, source: str = "flows") -> str:
    return f"WITH {DUCKDB_FLOWS}, {_BINNED.format(flows=source)}, {body.lstrip()}"


_DETECTOR_SQL = {
    "port_scan": port_scan_sql(FIXTURE.scan),
    "bruteforce": bruteforce_sql(FIXTURE.brute),
    "icmp_flood": icmp_flood_sql(FIXTURE.icmp_flood),
    "dns_flood": dns_flood_sql(FIXTURE.dns),
    "ddos": ddos_sql(FIXTURE.ddos),
}

_ALERT_COLUMNS = {
    "attacker_ip": ("''", {"port_scan", "bruteforce"}),
    "target_ip": ("''", {"bruteforce", "icmp_flood", "dns_flood", "ddos"}),
    "total": ("-1", {"port_scan", "icmp_flood", "dns_flood", "ddos"}),
    "uniq_src": ("-1", {"icmp_flood", "dns_flood", "ddos"}),
    "uniq_hosts": ("-1", {"port_scan"}),
    "uniq_ports": ("-1", {"port_scan", "bruteforce"}),
    "uniq_pairs": ("-1", {"ddos"}),
    "fail_ratio": ("-1.0::DOUBLE", {"port_scan", "bruteforce"}),
    "attempts": ("-1", {"bruteforce"}),
}


def rules_union_sql(source: str) -> str:
    """All detectors over one row source, in the rule-alert layout."""
    parts = []
    for kind, body in _DETECTOR_SQL.items():
        columns = ", ".join(
            f"CAST({name if kind in kinds else fill} AS BIGINT) AS {name}"
            if fill == "-1"
            else f"{name if kind in kinds else fill} AS {name}"
            for name, (fill, kinds) in _ALERT_COLUMNS.items()
        )
        parts.append(f"SELECT type, severity, {columns} FROM (WITH {body.lstrip()})")
    return f"""WITH {DUCKDB_FLOWS}, kept AS ({source}), {_BINNED.format(flows="kept")}
SELECT (SELECT round(max(ts), 3) FROM flows) AS ts_generated, a.* FROM (
{" UNION ALL ".join(parts)}) a"""


_TCP = "FROM rows_ WHERE proto = 'tcp' GROUP BY ALL"

ORACLE = {
    "approx_distinct": f"""WITH {DUCKDB_FLOWS} SELECT resp_h, CAST(floor(ts / {WEEK}) AS BIGINT) * {WEEK} AS long_bin,
      count(DISTINCT orig_h) AS sources, count(DISTINCT (orig_h, resp_p)) AS pairs, TRUE AS sources_close, TRUE AS pairs_close
      FROM flows GROUP BY ALL""",
    "flow_rollup": _with_rows("""
  t AS (SELECT orig_h, resp_h, resp_p, proto, coalesce(lower(service), '-') AS service,
               CAST(CASE WHEN proto = 'icmp' AND echo THEN 1 ELSE 0 END AS INT) AS echo_like, sb AS slot,
               fail, succ, syn, duration, orig_bytes, resp_bytes, orig_pkts, resp_pkts FROM rows_)
  SELECT orig_h, resp_h, resp_p, proto, service, echo_like, slot, count(*) AS n,
         CAST(sum(fail) AS BIGINT) AS fails, CAST(sum(succ) AS BIGINT) AS successes,
         CAST(sum(orig_pkts) AS BIGINT) AS orig_pkts, CAST(sum(resp_pkts) AS BIGINT) AS resp_pkts,
         CAST(sum(syn) AS BIGINT) AS syn, round(sum(duration), 4) AS duration,
         round(CAST(sum(orig_bytes) AS DOUBLE), 2) AS orig_bytes,
         round(CAST(sum(resp_bytes) AS DOUBLE), 2) AS resp_bytes
  FROM t GROUP BY ALL"""),
    "stat_src_short": _with_rows(f"""
  z AS (SELECT orig_h, sb AS short_bin, count(*) AS n, CAST(sum(fail) AS BIGINT) AS fails,
               count(DISTINCT resp_h) AS hosts, count(DISTINCT resp_p) AS ports,
               count(DISTINCT resp_h || '|' || resp_p) AS pairs, round(CAST(avg(syn) AS DOUBLE), 6) AS syn_mean {_TCP})
  SELECT * FROM z"""),
    "stat_src_long": _with_rows(f"""
  z AS (SELECT orig_h, lb AS long_bin, count(DISTINCT resp_h) AS hosts, count(DISTINCT resp_p) AS ports,
               count(DISTINCT resp_h || '|' || resp_p) AS pairs {_TCP})
  SELECT * FROM z"""),
    "stat_victim_short": _with_rows(f"""
  z AS (SELECT resp_h, sb AS short_bin, count(*) AS n, count(DISTINCT orig_h) AS sources,
               count(DISTINCT orig_h || '|' || resp_p) AS pairs {_TCP})
  SELECT * FROM z"""),
    "stat_victim_long": _with_rows(f"""
  z AS (SELECT resp_h, lb AS long_bin, count(*) AS n, count(DISTINCT orig_h) AS sources,
               count(DISTINCT orig_h || '|' || resp_p) AS pairs {_TCP})
  SELECT * FROM z"""),
    "stat_pair": _with_rows(f"""
  z AS (SELECT orig_h, resp_h, sb AS short_bin, count(*) AS n {_TCP}) SELECT * FROM z"""),
    "stat_pair_port": _with_rows(f"""
  z AS (SELECT orig_h, resp_h, resp_p, sb AS short_bin, count(*) AS n {_TCP}) SELECT * FROM z"""),
    "fail_ratio": _with_rows(f"""
  z AS (SELECT orig_h, sb AS short_bin, count(*) AS n, CAST(sum(fail) AS BIGINT) AS fails,
               CAST(sum(succ) AS BIGINT) AS successes, round(avg(fail), 6) AS fail_ratio {_TCP})
  SELECT * FROM z"""),
    "pps_reply_ratio": _with_rows("""
  z AS (SELECT orig_h, sb AS short_bin, round(sum(orig_pkts) / greatest(sum(duration), 1.0), 6) AS pps,
               round(coalesce(sum(resp_pkts) / nullif(sum(orig_pkts), 0), 0.0), 6) AS reply_ratio
        FROM rows_ WHERE proto = 'icmp' AND echo GROUP BY ALL) SELECT * FROM z"""),
    "byte_ratio": _with_rows("""
  z AS (SELECT resp_h, sb AS short_bin, round(CASE WHEN sum(orig_bytes) > 0
               THEN CAST(sum(resp_bytes) AS DOUBLE) / greatest(sum(orig_bytes), 1) ELSE 0.0 END, 6) AS byte_ratio
        FROM rows_ WHERE proto = 'udp' AND resp_p = 53 GROUP BY ALL) SELECT * FROM z"""),
    **{name: _with_rows(body) for name, body in _DETECTOR_SQL.items()},
    "bruteforce_off_focus": _with_rows(bruteforce_sql(BRUTE_OFF_FOCUS)),
    "ddos_reflection": _with_rows(ddos_sql(DDOS_REFLECTION)),
    "rejscan_fast": f"""WITH {DUCKDB_FLOWS},
  t AS (SELECT * FROM flows WHERE proto = 'tcp' AND conn_state IN ('REJ', 'S0')),
  m AS (SELECT max(ts) AS newest FROM t)
  SELECT orig_h AS attacker_ip, resp_h AS target_ip, count(DISTINCT resp_p) AS uniq_ports,
         'port_scan' AS type, 'med' AS severity, round(max(newest), 3) AS ts_generated
  FROM t, m WHERE ts >= newest - {FIXTURE.fast_scan.window_seconds} GROUP BY orig_h, resp_h
  HAVING count(DISTINCT resp_p) >= {FIXTURE.fast_scan.min_ports}""",
    "rules_all": rules_union_sql("SELECT * FROM flows"),
    "icmp_allowed": _with_rows(icmp_flood_sql(ICMP_ALLOWED)),
    "rules_newest": rules_union_sql(f"SELECT * FROM (SELECT * FROM flows ORDER BY ts DESC, uid DESC LIMIT {NEWEST})"),
    "sketch_windows": f"""WITH {DUCKDB_FLOWS} SELECT resp_h, CAST(floor(ts / {WEEK}) AS BIGINT) * {WEEK} AS bin, count(*) AS n,
      count(DISTINCT orig_h) AS sources, count(DISTINCT (orig_h, resp_p)) AS source_ports,
      TRUE AS sources_close, TRUE AS source_ports_close FROM flows GROUP BY ALL""",
    "rules_window": rules_union_sql(
        f"SELECT * FROM flows WHERE ts >= (SELECT max(ts) FROM flows) - {FIXTURE.look_back_seconds()}"
    ),
}
