"""Detectors against a row-by-row evaluation in plain Python, on small random flows."""

import dataclasses
import random
from collections import defaultdict

import pytest

from flowvigil.config import FIXTURE, LAB, DdosConfig, DnsConfig, FastScanConfig, IcmpConfig, ScanConfig, BruteConfig
from flowvigil.operators import detectors as d, rollup as r
from flowvigil.plans.sample_flows import load_flows
from flowvigil.schema import FAIL_STATES, SUCCESS_STATES

COLUMNS = (
    "ts double, uid string, orig_h string, resp_h string, resp_p int, proto string, service string, "
    "conn_state string, history string, duration double, orig_bytes double, resp_bytes double, "
    "orig_pkts bigint, resp_pkts bigint"
)

SCAN = ScanConfig(20, 600, 0.9, 0.8, 4, 9, 5, 9, 6, 12, 9, 4, 8)
BRUTE = BruteConfig(45, 1200, 9, 4, 3, 4, 0.8, 0.6, 14, 2, False, 1.5, (22, 80), ("SSH",), (443,))
ICMP = IcmpConfig(20, 180, 4, 9, 3, 5, 6, 12, 4, 7, 12.0, 0.4, True, ("h1",), ("v2",))
DNS = DnsConfig(20, 600, True, (53,), 2, 4, 2, 3, True, 3.0, 1)
DDOS = DdosConfig(
    20, 600, ("tcp", "udp"), (22,), (80, 443), (53, 123), True, 6, 11, 9, 30, 8, 20, 0.95, 0.9,
    (53, 123), 0.6, {"53": 0.5},
)


def random_flows(n, seed):
    """Flows in which one source and one victim take part in about a third of all rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "h0" if rng.random() < 0.33 else f"h{rng.randrange(12)}"
        victim = "v0" if rng.random() < 0.33 else f"v{rng.randrange(8)}"
        rows.append(
            (
                rng.uniform(0, 3000), f"u{i}", source, victim, rng.choice([22, 53, 80, 123, 443, 8080]),
                rng.choice(["tcp", "TCP", "udp", "icmp"]), rng.choice([None, "ssh", "icmp", "-"]),
                rng.choice(["SF", "S1", "S0", "REJ", "OTH", None]), rng.choice(["S", "ShAD", "D", "Dd", None]),
                rng.choice([0.0, 0.2, 5.0]), float(rng.randrange(50)), float(rng.randrange(150)),
                rng.randrange(40), rng.randrange(8),
            )
        )
    return rows


class Flow:
    def __init__(self, row):
        (self.ts, self.uid, self.src, self.dst, self.port, proto, service, state, history, self.duration,
         self.sent, self.received, self.packets, self.replies) = row
        self.proto, self.service = proto.lower(), (service or "-").lower()
        self.fail, self.success = state in FAIL_STATES, state in SUCCESS_STATES
        history = history or "-"
        self.syn = float("S" in history and "h" not in history.lower())
        self.echo = "D" in history and "d" not in history

    def bin(self, width):
        return int(self.ts // width)


def groups(flows, key):
    found = defaultdict(list)
    for f in flows:
        found[key(f)].append(f)
    return lambda f: found[key(f)]


def distinct(flows, value):
    return len({value(f) for f in flows})


def mean(flows, value):
    return sum(value(f) for f in flows) / len(flows)


def summarize(hits, key, columns):
    found = defaultdict(list)
    for f in hits:
        found[key(f)].append(f)
    return {k: tuple(c(v) for c in columns) for k, v in found.items()}


def brute_scan(flows, c):
    tcp = [f for f in flows if f.proto == "tcp"]
    ss = groups(tcp, lambda f: (f.src, f.bin(c.short_window_seconds)))
    sl = groups(tcp, lambda f: (f.src, f.bin(c.long_window_seconds)))
    vs = groups(tcp, lambda f: (f.dst, f.bin(c.short_window_seconds)))
    vl = groups(tcp, lambda f: (f.dst, f.bin(c.long_window_seconds)))
    host, port, pair, source = (lambda f: f.dst), (lambda f: f.port), (lambda f: (f.dst, f.port)), (lambda f: f.src)
    hits = [
        f for f in tcp
        if distinct(ss(f), host) >= c.unique_dst_threshold_short or distinct(ss(f), port) >= c.unique_port_threshold_short
        or distinct(ss(f), pair) >= c.pair_threshold_short or len(ss(f)) >= c.burst_conn_threshold_short
        or mean(ss(f), lambda x: x.fail) >= c.s0_ratio_threshold or mean(ss(f), lambda x: x.syn) >= c.syn_noack_threshold
        or distinct(sl(f), host) >= c.unique_dst_threshold_long or distinct(sl(f), port) >= c.unique_port_threshold_long
        or distinct(sl(f), pair) >= c.pair_threshold_long or distinct(vs(f), source) >= c.victim_unique_src_threshold_short
        or distinct(vl(f), source) >= c.victim_unique_src_threshold_long
    ]
    return summarize(
        hits, source, [len, lambda v: distinct(v, host), lambda v: distinct(v, port), lambda v: mean(v, lambda x: x.fail)]
    )


def brute_bruteforce(flows, c):
    tcp = [f for f in flows if f.proto == "tcp"]
    w, slow = c.short_window_seconds, c.slow_window_seconds
    ss = groups(tcp, lambda f: (f.src, f.bin(w)))
    sd = groups(tcp, lambda f: (f.src, f.dst, f.bin(w)))
    sp = groups(tcp, lambda f: (f.src, f.dst, f.port, f.bin(w)))
    vs = groups(tcp, lambda f: (f.dst, f.bin(w)))
    sl = groups(tcp, lambda f: (f.src, f.bin(slow)))
    hits = []
    for f in tcp:
        gate = (f.port in c.ports_focus or f.service in {s.lower() for s in c.services_focus}) and f.port not in c.exclude_ports
        if sum(x.success for x in ss(f)) >= c.success_break_threshold or (c.require_focus_for_trigger and not gate):
            continue
        limit = (lambda th: th) if gate else (lambda th: int(th * c.off_focus_multiplier))
        fail = c.fail_ratio_threshold if gate else c.fail_ratio_threshold * 1.5
        if (
            len(ss(f)) >= limit(c.per_src_attempt_threshold) or len(sd(f)) >= limit(c.per_srcdst_attempt_threshold)
            or len(sp(f)) >= limit(c.per_srcdstport_attempt_threshold) or mean(ss(f), lambda x: x.fail) >= fail
            or mean(ss(f), lambda x: x.syn) >= c.syn_noack_mean_threshold
            or distinct(vs(f), lambda x: x.src) >= c.per_dst_multi_src_threshold
            or (len(sl(f)) >= c.slow_attempt_threshold and mean(sl(f), lambda x: x.fail) >= fail)
        ):
            hits.append(f)
    return summarize(
        hits, lambda f: (f.src, f.dst), [len, lambda v: distinct(v, lambda x: x.port), lambda v: mean(v, lambda x: x.fail)]
    )


VICTIM = [len, lambda v: distinct(v, lambda x: x.src)]


def brute_icmp(flows, c):
    rows = [f for f in flows if (f.proto == "icmp" or f.service == "icmp") and (f.echo or not c.enforce_echo_like)]
    w, wl = c.short_window_seconds, c.long_window_seconds
    ss, sl = groups(rows, lambda f: (f.src, f.bin(w))), groups(rows, lambda f: (f.src, f.bin(wl)))
    ps, pl = groups(rows, lambda f: (f.src, f.dst, f.bin(w))), groups(rows, lambda f: (f.src, f.dst, f.bin(wl)))
    vs, vl = groups(rows, lambda f: (f.dst, f.bin(w))), groups(rows, lambda f: (f.dst, f.bin(wl)))
    source = lambda x: x.src

    def fast(g):
        packets = sum(x.packets for x in g)
        replies = sum(x.replies for x in g) / packets if packets else 0.0
        return packets / max(sum(x.duration for x in g), 1.0) >= c.pps_threshold_short and replies <= c.reply_ratio_max

    hits = [
        f for f in rows
        if f.src not in c.src_ip_whitelist and f.dst not in c.dst_ip_whitelist and (
            len(ss(f)) >= c.src_total_threshold_short or len(sl(f)) >= c.src_total_threshold_long
            or len(ps(f)) >= c.pair_threshold_short or len(pl(f)) >= c.pair_threshold_long
            or len(vs(f)) >= c.victim_total_threshold_short or distinct(vs(f), source) >= c.victim_unique_src_threshold_short
            or len(vl(f)) >= c.victim_total_threshold_long or distinct(vl(f), source) >= c.victim_unique_src_threshold_long
            or fast(ss(f)))
    ]
    return summarize(hits, lambda f: f.dst, VICTIM)


def brute_dns(flows, c):
    rows = [f for f in flows if f.proto == "udp" and (f.port in c.focus_ports or not c.require_focus)]
    vs = groups(rows, lambda f: (f.dst, f.bin(c.short_window_seconds)))
    vl = groups(rows, lambda f: (f.dst, f.bin(c.long_window_seconds)))
    source = lambda x: x.src

    def amplified(g):
        sent, received = sum(x.sent for x in g), sum(x.received for x in g)
        return len(g) >= c.udp_min_rows_for_ratio and (received / max(sent, 1.0) if sent > 0 else 0.0) >= c.udp_bytes_ratio_threshold

    hits = [
        f for f in rows
        if len(vs(f)) >= c.victim_rows_threshold_short or distinct(vs(f), source) >= c.victim_unique_src_threshold_short
        or len(vl(f)) >= c.victim_rows_threshold_long or distinct(vl(f), source) >= c.victim_unique_src_threshold_long
        or (c.enable_udp_bytes_ratio and amplified(vs(f)))
    ]
    return summarize(hits, lambda f: f.dst, VICTIM)


def brute_ddos(flows, c):
    def focus(f):
        return f.port in (c.tcp_focus_ports if f.proto == "tcp" else c.udp_focus_ports)

    rows = [f for f in flows if f.proto in c.proto_scope and f.port not in c.exclude_ports and focus(f)]
    vs = groups(rows, lambda f: (f.dst, f.bin(c.short_window_seconds)))
    vl = groups(rows, lambda f: (f.dst, f.bin(c.long_window_seconds)))
    source, pair = (lambda x: x.src), (lambda x: (x.src, x.port))
    hits = []
    for f in rows:
        m = 1.0
        if f.proto == "udp" and f.port in c.udp_amplification_ports:
            m = c.udp_amplification_multipliers.get(str(f.port), c.udp_amplification_multiplier)
        if (
            distinct(vs(f), source) >= c.victim_unique_src_threshold_short * m or len(vs(f)) >= c.victim_rows_threshold_short * m
            or distinct(vs(f), pair) >= c.victim_pairs_threshold_short * m
            or distinct(vl(f), source) >= c.victim_unique_src_threshold_long * m or len(vl(f)) >= c.victim_rows_threshold_long * m
            or distinct(vl(f), pair) >= c.victim_pairs_threshold_long * m
            or mean(vs(f), lambda x: x.fail) >= c.s0_ratio_threshold or mean(vs(f), lambda x: x.syn) >= c.syn_noack_mean_threshold
        ):
            hits.append(f)
    return summarize(hits, lambda f: f.dst, [*VICTIM, lambda v: distinct(v, pair)])


CASES = {
    "port_scan": (d.port_scan, SCAN, brute_scan, ["attacker_ip"], ["total", "uniq_hosts", "uniq_ports", "fail_ratio"]),
    "bruteforce": (d.bruteforce, BRUTE, brute_bruteforce, ["attacker_ip", "target_ip"], ["attempts", "uniq_ports", "fail_ratio"]),
    "bruteforce_focus": (
        d.bruteforce, dataclasses.replace(BRUTE, require_focus_for_trigger=True), brute_bruteforce,
        ["attacker_ip", "target_ip"], ["attempts", "uniq_ports", "fail_ratio"],
    ),
    "icmp_flood": (d.icmp_flood, ICMP, brute_icmp, ["target_ip"], ["total", "uniq_src"]),
    "dns_flood": (d.dns_flood, DNS, brute_dns, ["target_ip"], ["total", "uniq_src"]),
    "ddos": (d.ddos, DDOS, brute_ddos, ["target_ip"], ["total", "uniq_src", "uniq_pairs"]),
}


@pytest.mark.parametrize("staged", [True, False])
@pytest.mark.parametrize("case", CASES)
def test_matches_row_by_row(spark, staging, case, staged):
    detector, cfg, brute, keys, values = CASES[case]
    rows = random_flows(700, seed=len(case))
    base = r.rollup(spark.createDataFrame(rows, COLUMNS).repartition(5), 5)
    alerts = d.detect(detector(base, cfg), staging if staged else d.NO_STAGING)
    found = {
        (tuple(a[k] for k in keys) if len(keys) > 1 else a[keys[0]]): tuple(a[v] for v in values)
        for a in alerts.collect()
    }
    expected = brute([Flow(x) for x in rows], cfg)
    assert expected and set(found) == set(expected)
    for key, want in expected.items():
        assert found[key] == pytest.approx(want), key


def test_fast_scan_boundary(spark):
    tries = [(100.0 + p, f"u{p}", "a", "b", p, "TCP", "REJ") for p in range(20)]
    short = [(100.0 + p, f"x{p}", "a", "c", p, "tcp", "S0") for p in range(19)]
    old = [(-80.0, "o1", "a", "c", 99, "tcp", "S0"), (None, "o2", "a", "c", 98, "tcp", "S0"), (119.0, "o3", "a", "c", 97, "tcp", "SF")]
    flows = spark.createDataFrame(
        tries + short + old, "ts double, uid string, orig_h string, resp_h string, resp_p int, proto string, conn_state string"
    )
    alerts = d.detect_fast_scan(flows, FastScanConfig()).collect()
    assert [(a.attacker_ip, a.target_ip, a.uniq_ports, a.ts_generated) for a in alerts] == [("a", "b", 20, 119.0)]


def test_run_rules_ignores_row_order(spark, staging):
    rows = random_flows(400, seed=3)
    flows = spark.createDataFrame(rows, COLUMNS)
    columns = ["type", "attacker_ip", "target_ip", "uniq_src", "uniq_hosts", "uniq_ports", "uniq_pairs"]

    def run(df):
        found = d.run_rules(df, LAB, 3000.0, look_back=3000, staging=staging).collect()
        return {tuple(a[c] for c in columns): (a.total or a.attempts) for a in found}

    once = run(flows)
    assert once and run(flows.orderBy("uid").repartition(7)) == once
    assert LAB.slot_seconds() == 5 and FIXTURE.slot_seconds() == 86400


def test_shuffle_joins_give_the_same_alerts(spark, staging):
    flows = spark.createDataFrame(random_flows(400, seed=3), COLUMNS)
    small = d.run_rules(flows, LAB, 3000.0, look_back=3000, staging=staging).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = d.run_rules(flows, LAB, 3000.0, look_back=3000, staging=staging).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(str, small)) == sorted(map(str, large))


def test_read_window(spark):
    flows = spark.createDataFrame([("1", "a"), ("9", "b"), ("bad", "c"), ("10", "d")], "ts string, uid string")
    assert {f.uid for f in d.read_window(flows, 10.0, 1).collect()} == {"b", "d"}
    assert [f.uid for f in d.read_window(flows, 10.0, 10, max_rows=1).collect()] == ["d"]


def test_missing_columns_and_empty_input(spark):
    flows = spark.createDataFrame([], "ts double, uid string, orig_h string, resp_h string")
    assert d.run_rules(flows, LAB, 1.0).count() == 0


def test_windows_must_be_multiples_of_the_slot(spark):
    from flowvigil.operators import rollup as r

    rows = r.rollup(spark.createDataFrame([(1.0, "a", "b", 1)], "ts double, orig_h string, resp_h string, resp_p int"), 30)
    with pytest.raises(ValueError):
        r.with_windows(rows, 20, 60)
    assert r.with_windows(rows, 60, 90).count() == 1


def test_statistics_copy_no_rows_and_are_exact(spark):
    """Exact counts of different values without Expand or Generate, against plain sets."""
    rng = random.Random(3)
    rows = [(f"s{rng.randrange(3)}", f"d{rng.randrange(6)}", rng.randrange(8), 60 * rng.randrange(3), rng.randrange(1, 4), 1) for _ in range(400)]
    df = spark.createDataFrame(rows, "orig_h string, resp_h string, resp_p int, slot bigint, n bigint, fails bigint")
    found = r.exact_statistics(df, ["orig_h", "slot"], ["n", "fails", "hosts", "ports", "pairs"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan
    for g in found.collect():
        own = [x for x in rows if (x[0], x[3]) == (g.orig_h, g.slot)]
        assert (g.n, g.fails) == (sum(x[4] for x in own), len(own))
        assert (g.hosts, g.ports, g.pairs) == (len({x[1] for x in own}), len({x[2] for x in own}), len({x[1:3] for x in own}))
    assert r.exact_statistics(df, ["orig_h"], ["ports"]).count() == 3
    assert r.exact_statistics(df.limit(0), ["orig_h"], ["n", "hosts", "ports"]).count() == 0


def test_detectors_copy_no_rows(spark):
    flows = load_flows(spark, "/root/testdata/sf0.001")
    base = r.rollup(flows, FIXTURE.slot_seconds())
    for detection in (d.port_scan(base, FIXTURE.scan), d.ddos(base, FIXTURE.ddos)):
        plan = d.detect(detection)._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan and "Generate" not in plan


def test_windows_from_sketches(spark):
    """Sketches of slots give any window, with the flows gone."""
    rows = [(f"v{i % 2}", f"h{i % 700}", 60 * (i % 30), 1) for i in range(6000)]
    df = spark.createDataFrame(rows, "resp_h string, orig_h string, slot bigint, n bigint")
    sketches = r.slot_sketches(df, ["resp_h"], ["sources"])
    for seconds in (60, 600, 1800):
        for g in r.window_estimates(sketches, ["resp_h"], ["sources"], seconds).collect():
            own = {x[1] for x in rows if x[0] == g.resp_h and x[2] // seconds * seconds == g.bin}
            assert abs(g.sources - len(own)) <= 0.05 * len(own) + 1
