"""Windowed threshold detectors over the flow rollup.

A detector decides per flow, from the statistics of the windows that hold it, whether the
flow is a hit, and then summarises the hits per attacker, pair or victim over the whole
look-back. Statistics are taken over all flows in the detector's protocol scope; only the
groups that can turn a row into a hit are joined back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from flowvigil.config import (
    BruteConfig,
    DdosConfig,
    DnsConfig,
    FastScanConfig,
    IcmpConfig,
    RuleProfile,
    ScanConfig,
)
from flowvigil.functions.categories import severity
from flowvigil.functions.coercion import number_or_null, number_or_zero, whole_or_null
from flowvigil.functions.flow import any_of, in_set
from flowvigil.operators import rollup as r
from flowvigil.operators.ordering import newest
from flowvigil.operators.rollup import Detection, Scope, ratio
from flowvigil.schema import RULE_ALERT
from flowvigil.staging import NoStaging, Staging

NO_STAGING = NoStaging()


def _alerts(summary: DataFrame, kind: str, level: Column, **columns: str) -> DataFrame:
    """Summary rows in the rule-alert layout, without the generation time."""
    names = {"attacker_ip": None, "target_ip": None, **columns}
    shaped = []
    for f in RULE_ALERT.fields[1:]:
        if f.name == "type":
            value = F.lit(kind)
        elif f.name == "severity":
            value = level
        else:
            source = names.get(f.name) or (f.name if f.name in summary.columns else None)
            value = F.col(source) if source else F.lit(None)
        shaped.append(value.cast(f.dataType).alias(f.name))
    return summary.select(*shaped)


def port_scan(flows: DataFrame, cfg: ScanConfig = ScanConfig()) -> Detection:
    """One alert per source that fans out over hosts, ports or host-port pairs."""
    tcp = r.with_windows(
        flows.where(F.col("proto") == "tcp"), cfg.short_window_seconds, cfg.long_window_seconds
    )
    n, hosts, ports, pairs = F.col("n"), F.col("hosts"), F.col("ports"), F.col("pairs")
    fan_out = ("hosts", "ports", "pairs")
    scopes = [
        Scope(
            "src_short",
            ("orig_h",), "short",
            ("n", "fails", "syn", *fan_out),
            any_of(
                [
                    hosts >= cfg.unique_dst_threshold_short,
                    ports >= cfg.unique_port_threshold_short,
                    pairs >= cfg.pair_threshold_short,
                    n >= cfg.burst_conn_threshold_short,
                    ratio(F.col("fails"), n) >= cfg.s0_ratio_threshold,
                    ratio(F.col("syn"), n) >= cfg.syn_noack_threshold,
                ]
            ),
        ),
        Scope(
            "src_long",
            ("orig_h",), "long",
            fan_out,
            any_of(
                [
                    hosts >= cfg.unique_dst_threshold_long,
                    ports >= cfg.unique_port_threshold_long,
                    pairs >= cfg.pair_threshold_long,
                ]
            ),
        ),
        Scope(
            "victim_short",
            ("resp_h",), "short",
            ("sources",),
            F.col("sources") >= cfg.victim_unique_src_threshold_short,
        ),
        Scope(
            "victim_long",
            ("resp_h",), "long",
            ("sources",),
            F.col("sources") >= cfg.victim_unique_src_threshold_long,
        ),
    ]

    def alerts(groups: dict[str, DataFrame]) -> DataFrame:
        hits = r.join_back(tcp, scopes, groups).where(
            F.coalesce(
                "src_short_n", "src_long_hosts", "victim_short_sources", "victim_long_sources"
            ).isNotNull()
        )
        found = r.exact_statistics(hits, ["orig_h"], ["n", "fails", "hosts", "ports"])
        summary = found.select(
            "orig_h",
            F.col("n").alias("total"),
            F.col("hosts").alias("uniq_hosts"),
            F.col("ports").alias("uniq_ports"),
            ratio(F.col("fails"), F.col("n")).alias("fail_ratio"),
        )
        hosts, ports = F.col("uniq_hosts"), F.col("uniq_ports")
        level = severity(
            (hosts >= cfg.unique_dst_threshold_long) | (ports >= cfg.unique_port_threshold_long),
            (hosts >= cfg.unique_dst_threshold_short) | (ports >= cfg.unique_port_threshold_short),
        )
        return _alerts(summary, "port_scan", level, attacker_ip="orig_h")

    return Detection("port_scan", tcp, scopes, alerts)


def bruteforce(flows: DataFrame, cfg: BruteConfig = BruteConfig()) -> Detection:
    """One alert per source and target with repeated, mostly failing attempts."""
    tcp = r.with_windows(
        flows.where(F.col("proto") == "tcp"), cfg.short_window_seconds, cfg.slow_window_seconds
    )
    gate = (
        in_set("resp_p", cfg.ports_focus)
        | in_set("service", [s.lower() for s in cfg.services_focus])
    ) & ~in_set("resp_p", cfg.exclude_ports)

    def eased(threshold: int) -> int:
        return int(threshold * cfg.off_focus_multiplier)

    def lowest(threshold: int) -> int:
        return threshold if cfg.require_focus_for_trigger else min(threshold, eased(threshold))

    def effective(threshold: int) -> Column:
        return F.when(F.col("gate"), threshold).otherwise(eased(threshold))

    n = F.col("n")
    fail = ratio(F.col("fails"), n)
    unbroken = Scope(
        "src",
        ("orig_h",), "short",
        ("n", "fails", "successes", "syn"),
        F.col("successes") < cfg.success_break_threshold,
    )
    counted = [
        Scope(
            "pair",
            ("orig_h", "resp_h"), "short",
            ("n",),
            n >= lowest(cfg.per_srcdst_attempt_threshold),
        ),
        Scope(
            "pair_port",
            ("orig_h", "resp_h", "resp_p"), "short",
            ("n",),
            n >= lowest(cfg.per_srcdstport_attempt_threshold),
        ),
        Scope(
            "victim",
            ("resp_h",), "short",
            ("sources",),
            F.col("sources") >= cfg.per_dst_multi_src_threshold,
        ),
        Scope(
            "slow",
            ("orig_h",), "long",
            ("n", "fails"),
            (n >= cfg.slow_attempt_threshold) & (fail >= cfg.fail_ratio_threshold),
        ),
    ]

    def alerts(groups: dict[str, DataFrame]) -> DataFrame:
        rows = tcp.withColumn("gate", gate)
        if cfg.require_focus_for_trigger:
            rows = rows.where("gate")
        rows = r.join_back(rows, [unbroken], groups, how="inner")
        rows = r.join_back(rows, counted, groups)
        fail_limit = F.when(F.col("gate"), cfg.fail_ratio_threshold).otherwise(
            cfg.fail_ratio_threshold * 1.5
        )
        hits = rows.where(
            any_of(
                [
                    F.col("src_n") >= effective(cfg.per_src_attempt_threshold),
                    F.col("pair_n") >= effective(cfg.per_srcdst_attempt_threshold),
                    F.col("pair_port_n") >= effective(cfg.per_srcdstport_attempt_threshold),
                    ratio(F.col("src_fails"), F.col("src_n")) >= fail_limit,
                    ratio(F.col("src_syn"), F.col("src_n")) >= cfg.syn_noack_mean_threshold,
                    F.col("victim_sources").isNotNull(),
                    F.try_divide(F.col("slow_fails"), F.col("slow_n")) >= fail_limit,
                ]
            )
        )
        summary = hits.groupBy("orig_h", "resp_h").agg(
            r.rows_total().alias("attempts"),
            r.distinct_ports().alias("uniq_ports"),
            ratio(r.fails_total(), r.rows_total()).alias("fail_ratio"),
        )
        attempts = F.col("attempts")
        level = severity(
            (attempts >= cfg.slow_attempt_threshold) | (F.col("fail_ratio") >= 0.9),
            attempts >= cfg.per_srcdst_attempt_threshold,
        )
        return _alerts(summary, "bruteforce", level, attacker_ip="orig_h", target_ip="resp_h")

    return Detection("bruteforce", tcp, [unbroken, *counted], alerts)


def _victim_alerts(hits: DataFrame, kind: str, short: int, long: int, **extra: str) -> DataFrame:
    """One alert per victim, graded by the number of distinct sources among the hits."""
    found = r.exact_statistics(hits, ["resp_h"], ["n", "sources", *extra.values()])
    summary = found.select(
        "resp_h", F.col("n").alias("total"), F.col("sources").alias("uniq_src"), *[F.col(stat).alias(name) for name, stat in extra.items()]
    )
    sources = F.col("uniq_src")
    return _alerts(summary, kind, severity(sources >= long, sources >= short), target_ip="resp_h")


def icmp_flood(flows: DataFrame, cfg: IcmpConfig = IcmpConfig()) -> Detection:
    """One alert per victim of echo-like ICMP in volume, breadth or rate."""
    icmp = flows.where((F.col("proto") == "icmp") | (F.col("service") == "icmp"))
    if cfg.enforce_echo_like:
        icmp = icmp.where("echo_like")
    icmp = r.with_windows(icmp, cfg.short_window_seconds, cfg.long_window_seconds)
    n = F.col("n")
    pps = F.col("orig_pkts") / F.greatest(F.col("duration"), F.lit(1.0))
    replies = ratio(F.col("resp_pkts"), F.col("orig_pkts"))
    volume = ("n",)
    scopes = [
        Scope(
            "src_short",
            ("orig_h",), "short",
            ("n", "orig_pkts", "resp_pkts", "duration"),
            (n >= cfg.src_total_threshold_short)
            | ((pps >= cfg.pps_threshold_short) & (replies <= cfg.reply_ratio_max)),
        ),
        Scope("src_long", ("orig_h",), "long", volume, n >= cfg.src_total_threshold_long),
        Scope(
            "pair_short", ("orig_h", "resp_h"), "short", volume, n >= cfg.pair_threshold_short
        ),
        Scope("pair_long", ("orig_h", "resp_h"), "long", volume, n >= cfg.pair_threshold_long),
        Scope(
            "victim_short",
            ("resp_h",), "short",
            ("n", "sources"),
            (n >= cfg.victim_total_threshold_short)
            | (F.col("sources") >= cfg.victim_unique_src_threshold_short),
        ),
        Scope(
            "victim_long",
            ("resp_h",), "long",
            ("n", "sources"),
            (n >= cfg.victim_total_threshold_long)
            | (F.col("sources") >= cfg.victim_unique_src_threshold_long),
        ),
    ]

    def alerts(groups: dict[str, DataFrame]) -> DataFrame:
        rows = icmp.where(
            ~in_set("orig_h", cfg.src_ip_whitelist) & ~in_set("resp_h", cfg.dst_ip_whitelist)
        )
        hits = r.join_back(rows, scopes, groups).where(
            F.coalesce(*[f"{scope.name}_n" for scope in scopes]).isNotNull()
        )
        return _victim_alerts(
            hits,
            "icmp_flood",
            cfg.victim_unique_src_threshold_short,
            cfg.victim_unique_src_threshold_long,
        )

    return Detection("icmp_flood", icmp, scopes, alerts)


def dns_flood(flows: DataFrame, cfg: DnsConfig = DnsConfig()) -> Detection:
    """One alert per victim of many, many-sourced or amplified UDP flows to the DNS ports."""
    udp = flows.where(F.col("proto") == "udp")
    if cfg.require_focus:
        udp = udp.where(in_set("resp_p", cfg.focus_ports))
    udp = r.with_windows(udp, cfg.short_window_seconds, cfg.long_window_seconds)
    n, sources = F.col("n"), F.col("sources")
    short_tests = [
        n >= cfg.victim_rows_threshold_short,
        sources >= cfg.victim_unique_src_threshold_short,
    ]
    if cfg.enable_udp_bytes_ratio:
        sent = F.col("orig_bytes")
        amplification = F.when(
            sent > 0, F.col("resp_bytes") / F.greatest(sent, F.lit(1.0))
        ).otherwise(0.0)
        short_tests.append(
            (n >= cfg.udp_min_rows_for_ratio) & (amplification >= cfg.udp_bytes_ratio_threshold)
        )
    scopes = [
        Scope(
            "victim_short",
            ("resp_h",), "short",
            ("n", "sources", "orig_bytes", "resp_bytes"),
            any_of(short_tests),
        ),
        Scope(
            "victim_long",
            ("resp_h",), "long",
            ("n", "sources"),
            (n >= cfg.victim_rows_threshold_long)
            | (sources >= cfg.victim_unique_src_threshold_long),
        ),
    ]

    def alerts(groups: dict[str, DataFrame]) -> DataFrame:
        hits = r.join_back(udp, scopes, groups).where(
            F.coalesce("victim_short_n", "victim_long_n").isNotNull()
        )
        return _victim_alerts(
            hits,
            "dns_flood",
            cfg.victim_unique_src_threshold_short,
            cfg.victim_unique_src_threshold_long,
        )

    return Detection("dns_flood", udp, scopes, alerts)


def ddos(flows: DataFrame, cfg: DdosConfig = DdosConfig()) -> Detection:
    """One alert per victim of distributed load; reflection ports get lower thresholds."""
    proto, port = F.col("proto"), F.col("resp_p")
    scoped = flows.where(
        in_set("proto", [p.lower() for p in cfg.proto_scope]) & ~in_set("resp_p", cfg.exclude_ports)
    )
    if cfg.require_victim_focus:
        scoped = scoped.where(
            ((proto == "tcp") & in_set("resp_p", cfg.tcp_focus_ports))
            | ((proto == "udp") & in_set("resp_p", cfg.udp_focus_ports))
        )
    scoped = r.with_windows(scoped, cfg.short_window_seconds, cfg.long_window_seconds)

    by_port = {int(p): float(m) for p, m in cfg.udp_amplification_multipliers.items()}
    reflected = [(p, by_port.get(p, cfg.udp_amplification_multiplier)) for p in cfg.udp_amplification_ports]
    factor = F.lit(1.0)
    for reflection_port, multiplier in reflected:
        factor = F.when((proto == "udp") & (port == reflection_port), multiplier).otherwise(factor)
    loosest = min([1.0, *[multiplier for _, multiplier in reflected]])

    limits = {
        "short": (
            cfg.victim_unique_src_threshold_short,
            cfg.victim_rows_threshold_short,
            cfg.victim_pairs_threshold_short,
        ),
        "long": (
            cfg.victim_unique_src_threshold_long,
            cfg.victim_rows_threshold_long,
            cfg.victim_pairs_threshold_long,
        ),
    }
    load = ("sources", "n", "source_ports")

    def load_tests(window: str, scale: Column, prefix: str = "") -> list[Column]:
        return [
            F.col(prefix + stat) >= F.lit(float(limit)) * scale
            for stat, limit in zip(load, limits[window])
        ]

    def quality_tests(prefix: str = "") -> list[Column]:
        total = F.col(f"{prefix}n")
        return [
            F.try_divide(F.col(f"{prefix}fails"), total) >= cfg.s0_ratio_threshold,
            F.try_divide(F.col(f"{prefix}syn"), total) >= cfg.syn_noack_mean_threshold,
        ]

    scopes = [
        Scope(
            "victim_short",
            ("resp_h",), "short",
            (*load, "fails", "syn"),
            any_of(load_tests("short", F.lit(loosest)) + quality_tests()),
        ),
        Scope(
            "victim_long",
            ("resp_h",), "long",
            load,
            any_of(load_tests("long", F.lit(loosest))),
        ),
    ]

    def alerts(groups: dict[str, DataFrame]) -> DataFrame:
        hits = r.join_back(scoped.withColumn("factor", factor), scopes, groups).where(
            any_of(
                load_tests("short", F.col("factor"), "victim_short_")
                + load_tests("long", F.col("factor"), "victim_long_")
                + quality_tests("victim_short_")
            )
        )
        return _victim_alerts(
            hits,
            "ddos",
            cfg.victim_unique_src_threshold_short,
            cfg.victim_unique_src_threshold_long,
            uniq_pairs="source_ports",
        )

    return Detection("ddos", scoped, scopes, alerts)


def detect_fast_scan(flows: DataFrame, cfg: FastScanConfig = FastScanConfig()) -> DataFrame:
    """One 'med' alert per pair with many refused or unanswered ports in the latest window.

    The window ends at the newest refused or unanswered TCP flow, which also dates the alerts.
    """
    tries = (
        flows.where((F.lower("proto") == "tcp") & F.col("conn_state").isin("REJ", "S0"))
        .select(
            number_or_null("ts").alias("ts"),
            "orig_h",
            "resp_h",
            whole_or_null("resp_p").alias("resp_p"),
        )
        .dropna()
    )
    newest = tries.agg(F.max("ts")).scalar()
    pairs = (
        tries.where(F.col("ts") >= newest - cfg.window_seconds)
        .groupBy("orig_h", "resp_h")
        .agg(r.distinct_ports().alias("uniq_ports"))
        .where(F.col("uniq_ports") >= cfg.min_ports)
    )
    alerts = _alerts(
        pairs, "port_scan", F.lit("med"), attacker_ip="orig_h", target_ip="resp_h"
    )
    return alerts.select(newest.alias("ts_generated"), *alerts.columns)


def detect(detection: Detection, staging: Staging | NoStaging = NO_STAGING) -> DataFrame:
    """Alerts of one detector, for example ``detect(port_scan(rollup, cfg))``."""
    return r.run_detections([detection], staging)[0]


def moment(as_of: float | Column) -> Column:
    """A clock value as a Column; ``latest(flows)`` makes one from the data."""
    return as_of if isinstance(as_of, Column) else F.lit(float(as_of))


def latest(flows: DataFrame, time_column: str = "ts") -> Column:
    """The newest time in the data, as a scalar subquery."""
    return flows.agg(F.max(number_or_null(time_column))).scalar()


def read_window(
    flows: DataFrame, as_of: float | Column, seconds: int, max_rows: int | None = None
) -> DataFrame:
    """Flows of the last ``seconds`` before ``as_of``; with ``max_rows`` only the newest ones.

    Flows with an unusable time are outside every window.
    """
    ts = number_or_zero("ts")
    recent = flows.where(ts >= moment(as_of) - seconds)
    if max_rows is None:
        return recent
    return newest(recent, ts, [F.col("uid").desc()], max_rows)


def run_rules(
    flows: DataFrame,
    profile: RuleProfile,
    as_of: float | Column,
    look_back: int | None = None,
    max_rows: int | None = None,
    staging: Staging | NoStaging = NO_STAGING,
) -> DataFrame:
    """All five windowed detectors over the look-back, in the rule-alert layout.

    The look-back defaults to the longest window of the profile. The flows are scanned and
    shuffled once: every detector reads the same staged rollup.
    """
    recent = read_window(flows, as_of, look_back or profile.look_back_seconds(), max_rows)
    base = staging.table(r.rollup(recent, profile.slot_seconds()), "rollup")
    alerts = r.run_detections(
        [
            port_scan(base, profile.scan),
            bruteforce(base, profile.brute),
            icmp_flood(base, profile.icmp_flood),
            dns_flood(base, profile.dns),
            ddos(base, profile.ddos),
        ],
        staging,
    )
    union = reduce(DataFrame.unionByName, alerts)
    return union.select(moment(as_of).alias("ts_generated"), *union.columns)
