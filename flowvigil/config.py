"""Detector thresholds, rule profiles and the other fixed settings.

Field names of the detector settings are the keys of the rule files, so a rule file can be
read straight into these classes. Every value here is a fixed value of the detection rules.
"""

from __future__ import annotations

import dataclasses
import json
import math
from dataclasses import dataclass, field

REMOTE_LOGIN_PORTS = (22, 21, 23, 25, 110, 143, 445, 3389, 5900, 3306, 5432, 8080, 8443)
REMOTE_LOGIN_SERVICES = (
    "ssh", "ftp", "telnet", "smtp", "imap", "pop3", "smb", "rdp", "vnc", "http", "ssl", "https",
)
WEB_PORTS = (80, 443, 8080, 8443, 8000, 8081)
UDP_REFLECTION_PORTS = (53, 123, 1900, 161, 389, 11211, 111, 69, 137, 5353)
PORT_MULTIPLIERS = {"11211": 0.4, "1900": 0.5, "53": 0.55, "123": 0.55}


@dataclass(frozen=True)
class ScanConfig:
    short_window_seconds: int = 30
    long_window_seconds: int = 600
    s0_ratio_threshold: float = 0.5
    syn_noack_threshold: float = 0.5
    unique_dst_threshold_short: int = 12
    unique_dst_threshold_long: int = 60
    unique_port_threshold_short: int = 15
    unique_port_threshold_long: int = 80
    pair_threshold_short: int = 20
    pair_threshold_long: int = 120
    burst_conn_threshold_short: int = 300
    victim_unique_src_threshold_short: int = 25
    victim_unique_src_threshold_long: int = 80


@dataclass(frozen=True)
class BruteConfig:
    short_window_seconds: int = 60
    slow_window_seconds: int = 600
    per_src_attempt_threshold: int = 40
    per_srcdst_attempt_threshold: int = 15
    per_srcdstport_attempt_threshold: int = 10
    per_dst_multi_src_threshold: int = 30
    fail_ratio_threshold: float = 0.7
    syn_noack_mean_threshold: float = 0.35
    slow_attempt_threshold: int = 120
    success_break_threshold: int = 1
    require_focus_for_trigger: bool = True
    off_focus_multiplier: float = 3.0
    ports_focus: tuple = REMOTE_LOGIN_PORTS
    services_focus: tuple = REMOTE_LOGIN_SERVICES
    exclude_ports: tuple = ()


@dataclass(frozen=True)
class IcmpConfig:
    short_window_seconds: int = 30
    long_window_seconds: int = 600
    src_total_threshold_short: int = 150
    src_total_threshold_long: int = 800
    pair_threshold_short: int = 100
    pair_threshold_long: int = 400
    victim_total_threshold_short: int = 300
    victim_total_threshold_long: int = 1200
    victim_unique_src_threshold_short: int = 25
    victim_unique_src_threshold_long: int = 80
    pps_threshold_short: float = 500.0
    reply_ratio_max: float = 0.1
    enforce_echo_like: bool = True
    src_ip_whitelist: tuple = ()
    dst_ip_whitelist: tuple = ()


@dataclass(frozen=True)
class DnsConfig:
    short_window_seconds: int = 30
    long_window_seconds: int = 600
    require_focus: bool = True
    focus_ports: tuple = (53,)
    victim_rows_threshold_short: int = 400
    victim_rows_threshold_long: int = 2000
    victim_unique_src_threshold_short: int = 35
    victim_unique_src_threshold_long: int = 140
    enable_udp_bytes_ratio: bool = True
    udp_bytes_ratio_threshold: float = 6.0
    udp_min_rows_for_ratio: int = 80


@dataclass(frozen=True)
class DdosConfig:
    short_window_seconds: int = 30
    long_window_seconds: int = 600
    proto_scope: tuple = ("tcp", "udp")
    exclude_ports: tuple = (22, 3389)
    tcp_focus_ports: tuple = WEB_PORTS
    udp_focus_ports: tuple = UDP_REFLECTION_PORTS
    require_victim_focus: bool = True
    victim_unique_src_threshold_short: int = 120
    victim_unique_src_threshold_long: int = 600
    victim_rows_threshold_short: int = 2000
    victim_rows_threshold_long: int = 6000
    victim_pairs_threshold_short: int = 1200
    victim_pairs_threshold_long: int = 2400
    s0_ratio_threshold: float = 0.40
    syn_noack_mean_threshold: float = 0.35
    udp_amplification_ports: tuple = UDP_REFLECTION_PORTS
    udp_amplification_multiplier: float = 0.6
    udp_amplification_multipliers: dict = field(default_factory=dict)


@dataclass(frozen=True)
class FastScanConfig:
    window_seconds: int = 180
    min_ports: int = 20


@dataclass(frozen=True)
class RuleProfile:
    scan: ScanConfig = ScanConfig()
    brute: BruteConfig = BruteConfig()
    icmp_flood: IcmpConfig = IcmpConfig()
    dns: DnsConfig = DnsConfig()
    ddos: DdosConfig = DdosConfig()
    fast_scan: FastScanConfig = FastScanConfig()

    def windows(self) -> list[int]:
        return [
            self.scan.short_window_seconds, self.scan.long_window_seconds,
            self.brute.short_window_seconds, self.brute.slow_window_seconds,
            self.icmp_flood.short_window_seconds, self.icmp_flood.long_window_seconds,
            self.dns.short_window_seconds, self.dns.long_window_seconds,
            self.ddos.short_window_seconds, self.ddos.long_window_seconds,
        ]

    def slot_seconds(self) -> int:
        """Widest slot that every window is a whole multiple of."""
        return math.gcd(*self.windows())

    def look_back_seconds(self) -> int:
        return max(self.windows())


DEFAULT = RuleProfile()

LAB = RuleProfile(
    scan=ScanConfig(
        short_window_seconds=20, long_window_seconds=600,
        s0_ratio_threshold=0.45, syn_noack_threshold=0.45,
        unique_dst_threshold_short=10, unique_dst_threshold_long=50,
        unique_port_threshold_short=12, unique_port_threshold_long=70,
        pair_threshold_short=15, pair_threshold_long=90,
        burst_conn_threshold_short=200,
        victim_unique_src_threshold_short=18, victim_unique_src_threshold_long=60,
    ),
    brute=BruteConfig(
        short_window_seconds=45, slow_window_seconds=1200,
        per_src_attempt_threshold=30, per_srcdst_attempt_threshold=10,
        per_srcdstport_attempt_threshold=8, per_dst_multi_src_threshold=18,
        fail_ratio_threshold=0.65, syn_noack_mean_threshold=0.30, slow_attempt_threshold=90,
        off_focus_multiplier=2.5, exclude_ports=(53, 123, 1900, 5353),
    ),
    icmp_flood=IcmpConfig(
        short_window_seconds=20, long_window_seconds=180,
        src_total_threshold_short=120, src_total_threshold_long=600,
        pair_threshold_short=80, pair_threshold_long=300,
        victim_total_threshold_short=220, victim_total_threshold_long=900,
        victim_unique_src_threshold_short=20, victim_unique_src_threshold_long=60,
        pps_threshold_short=450.0, reply_ratio_max=0.15,
    ),
    dns=DnsConfig(
        short_window_seconds=20, long_window_seconds=600,
        victim_rows_threshold_short=300, victim_rows_threshold_long=1400,
        victim_unique_src_threshold_short=25, victim_unique_src_threshold_long=100,
        udp_bytes_ratio_threshold=6.0, udp_min_rows_for_ratio=60,
    ),
    ddos=DdosConfig(
        short_window_seconds=20, long_window_seconds=600,
        victim_unique_src_threshold_short=120, victim_unique_src_threshold_long=600,
        victim_rows_threshold_short=2200, victim_rows_threshold_long=6500,
        victim_pairs_threshold_short=1100, victim_pairs_threshold_long=2600,
        s0_ratio_threshold=0.40, syn_noack_mean_threshold=0.35,
        udp_amplification_multipliers=PORT_MULTIPLIERS,
    ),
)

PROD = RuleProfile(
    scan=ScanConfig(
        short_window_seconds=30, long_window_seconds=900,
        s0_ratio_threshold=0.55, syn_noack_threshold=0.55,
        unique_dst_threshold_short=18, unique_dst_threshold_long=90,
        unique_port_threshold_short=20, unique_port_threshold_long=110,
        pair_threshold_short=28, pair_threshold_long=160,
        burst_conn_threshold_short=450,
        victim_unique_src_threshold_short=35, victim_unique_src_threshold_long=120,
    ),
    brute=BruteConfig(
        short_window_seconds=60, slow_window_seconds=1800,
        per_src_attempt_threshold=60, per_srcdst_attempt_threshold=22,
        per_srcdstport_attempt_threshold=14, per_dst_multi_src_threshold=45,
        fail_ratio_threshold=0.80, syn_noack_mean_threshold=0.40, slow_attempt_threshold=180,
        off_focus_multiplier=4.0, exclude_ports=(53, 123, 1900, 5353),
    ),
    icmp_flood=IcmpConfig(
        short_window_seconds=30, long_window_seconds=300,
        src_total_threshold_short=220, src_total_threshold_long=1200,
        pair_threshold_short=150, pair_threshold_long=700,
        victim_total_threshold_short=450, victim_total_threshold_long=2000,
        victim_unique_src_threshold_short=40, victim_unique_src_threshold_long=120,
        pps_threshold_short=700.0, reply_ratio_max=0.12,
    ),
    dns=DnsConfig(
        short_window_seconds=30, long_window_seconds=900,
        victim_rows_threshold_short=800, victim_rows_threshold_long=3500,
        victim_unique_src_threshold_short=70, victim_unique_src_threshold_long=220,
        udp_bytes_ratio_threshold=8.0, udp_min_rows_for_ratio=120,
    ),
    ddos=DdosConfig(
        short_window_seconds=30, long_window_seconds=900,
        victim_unique_src_threshold_short=180, victim_unique_src_threshold_long=900,
        victim_rows_threshold_short=4000, victim_rows_threshold_long=10000,
        victim_pairs_threshold_short=1800, victim_pairs_threshold_long=3600,
        s0_ratio_threshold=0.45, syn_noack_mean_threshold=0.40,
        udp_amplification_multipliers=PORT_MULTIPLIERS,
    ),
)

# Windows of a day and a week, for event tables whose rows are minutes apart.
FIXTURE = RuleProfile(
    scan=ScanConfig(
        short_window_seconds=86400, long_window_seconds=604800,
        s0_ratio_threshold=1.01, syn_noack_threshold=1.01,
        unique_dst_threshold_short=6, unique_dst_threshold_long=14,
        unique_port_threshold_short=5, unique_port_threshold_long=10,
        pair_threshold_short=6, pair_threshold_long=16,
        burst_conn_threshold_short=7,
        victim_unique_src_threshold_short=20, victim_unique_src_threshold_long=66,
    ),
    brute=BruteConfig(
        short_window_seconds=86400, slow_window_seconds=604800,
        per_src_attempt_threshold=4, per_srcdst_attempt_threshold=2,
        per_srcdstport_attempt_threshold=99, per_dst_multi_src_threshold=18,
        fail_ratio_threshold=0.65, syn_noack_mean_threshold=0.3, slow_attempt_threshold=8,
        ports_focus=(22, 23, 80, 443, 3389, 8080), services_focus=(), exclude_ports=(),
    ),
    icmp_flood=IcmpConfig(
        short_window_seconds=86400, long_window_seconds=604800,
        src_total_threshold_short=2, src_total_threshold_long=3,
        pair_threshold_short=2, pair_threshold_long=2,
        victim_total_threshold_short=3, victim_total_threshold_long=7,
        victim_unique_src_threshold_short=3, victim_unique_src_threshold_long=7,
        pps_threshold_short=60.0, reply_ratio_max=0.15,
    ),
    dns=DnsConfig(
        short_window_seconds=86400, long_window_seconds=604800,
        victim_rows_threshold_short=5, victim_rows_threshold_long=16,
        victim_unique_src_threshold_short=5, victim_unique_src_threshold_long=15,
        udp_bytes_ratio_threshold=6.0, udp_min_rows_for_ratio=2,
    ),
    ddos=DdosConfig(
        short_window_seconds=86400, long_window_seconds=604800,
        tcp_focus_ports=(80, 443, 8080), udp_focus_ports=(53, 123, 1900, 5353),
        victim_unique_src_threshold_short=16, victim_unique_src_threshold_long=67,
        victim_rows_threshold_short=17, victim_rows_threshold_long=80,
        victim_pairs_threshold_short=17, victim_pairs_threshold_long=75,
        s0_ratio_threshold=1.0, syn_noack_mean_threshold=0.75,
        udp_amplification_ports=(),
    ),
    fast_scan=FastScanConfig(window_seconds=1_209_600, min_ports=3),
)

PROFILES = {"default": DEFAULT, "lab": LAB, "prod": PROD, "fixture": FIXTURE}

# Names of the rule files of one profile folder.
RULE_FILES = ("scan", "brute", "icmp_flood", "dns", "ddos")


def profile(name: str) -> RuleProfile:
    if name not in PROFILES:
        raise ValueError(f"unknown rule profile {name!r}; known: {sorted(PROFILES)}")
    return PROFILES[name]


def override(config, values: dict):
    """A copy of a detector configuration with the known keys of ``values`` replaced.

    A value of another kind than the setting (text for a switch, say) is an error.
    """
    known = {f.name: getattr(config, f.name) for f in dataclasses.fields(config)}
    changes = {
        key: _as_kind(key, value, known[key]) for key, value in values.items() if key in known and value is not None
    }
    return dataclasses.replace(config, **changes)


def _as_kind(key: str, value, now):
    """``value`` in the type of the present setting."""
    kind = type(now)
    if kind is tuple:
        fits = isinstance(value, list | tuple | set | frozenset)
    elif kind in (int, float):
        fits = isinstance(value, int | float) and not isinstance(value, bool)
        fits = fits and (kind is float or float(value).is_integer())
    else:
        fits = isinstance(value, kind)
    if not fits:
        raise TypeError(f"{key} takes {kind.__name__}, not {value!r}")
    return kind(value)


def with_windows(base: RuleProfile, short: int, long: int) -> RuleProfile:
    """Profile whose windows come from run arguments; brute force never goes below 60/600 s."""
    span = dict(short_window_seconds=short, long_window_seconds=long)
    return dataclasses.replace(
        base,
        scan=override(base.scan, span),
        brute=override(
            base.brute,
            dict(short_window_seconds=max(60, short), slow_window_seconds=max(600, long)),
        ),
        icmp_flood=override(base.icmp_flood, span),
        dns=override(base.dns, span),
        ddos=override(base.ddos, span),
    )


def profile_from_json(texts: dict[str, str], base: RuleProfile = DEFAULT) -> RuleProfile:
    """Profile from the JSON text of each rule file; a missing or unreadable one keeps ``base``."""
    changed = {}
    for name in RULE_FILES:
        try:
            values = json.loads(texts.get(name) or "{}")
        except ValueError:
            continue
        if isinstance(values, dict):
            changed[name] = override(getattr(base, name), values)
    return dataclasses.replace(base, **changed)


# Service name mapping and the name of a missing service.
SERVICE_MAP = {
    "ssl": "tls",
    "quic,ssl": "quic_tls",
    "quic, ssl": "quic_tls",
    "quic": "quic",
    "ssdp": "lan_discovery",
    "mdns": "lan_discovery",
    "llmnr": "lan_discovery",
    "-": "unknown",
    "ayiya": "tunnel_ayiya",
    "quic,ssl,ayiya": "quic_tls",
    "quic, ssl, ayiya": "quic_tls",
    "tls": "tls",
    "dns": "dns",
    "http": "http",
    "ssh": "ssh",
    "smtp": "smtp",
    "imap": "imap",
    "pop3": "pop3",
    "ntp": "ntp",
    "ocsp": "ocsp",
    "dhcp": "dhcp",
    "rdp": "rdp",
    "smb": "smb",
    "ldap": "ldap",
    "ftp": "ftp",
    "tftp": "tftp",
    "stun": "stun",
    "sip": "sip",
}
SERVICE_DEFAULT = "other"


@dataclass(frozen=True)
class Thresholds:
    threshold: float = 0.80
    precision_target: float = 0.98
    fpr_target: float = 0.005


# Threshold used when no threshold table has been written yet.
FALLBACK_THRESHOLD = 0.5


@dataclass(frozen=True)
class MergeConfig:
    # 0 keeps all alerts; a cap is for whoever wants only the newest ones.
    max_rows: int = 0
    window_seconds: int = 0
    cooldown_seconds: int = 0


@dataclass(frozen=True)
class BanConfig:
    only_latest: bool = False
    since_seconds: int = 0
    min_severity: str = "med"
    sources: tuple = ("rules", "ml")
    types: tuple = ()
    exclude_types: tuple = ()
    set_name: str = "ml_blacklist"
    block_seconds: int = 600
    cooldown_seconds: int = 60
    ban_limit: int = 100
    proof_min: int = 1


# Addresses that are never banned.
BUILTIN_WHITELIST = ("127.0.0.1", "::1")
