import ipaddress
import math
import random

import pytest
from pyspark.sql import functions as F

from flowvigil.config import SERVICE_MAP
from flowvigil.functions import categories as c, coercion, flow
from flowvigil.functions.address import is_internal, is_valid_ip


def evaluate(spark, values, rule, dtype="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[1] for r in rows.select("i", rule(F.col("v"))).orderBy("i").collect()]


@pytest.mark.parametrize(
    "service, expected",
    [
        (None, "other"), ("", "other"), (" , ,", "other"), ("-", "unknown"), ("ssl", "tls"),
        (" SSL ", "tls"), ("ssl,ssl", "tls"), ("quic,ssl", "quic_tls"), ("ssl, quic", "quic_tls"),
        ("quic,ssl,ayiya", "tunnel_ayiya"), ("AYIYA", "tunnel_ayiya"), ("ssl,http", "http_tls"),
        ("imap,ssl", "imap_tls"), ("pop3,ssl", "pop3_tls"), ("ssl,mdns", "lan_discovery"),
        ("ssl,gopher", "gopher"), ("gopher,http", "gopher"), ("mdns,ssh", "lan_discovery"),
        ("quic", "quic"), ("\thttp\n", "http"),
    ],
)
def test_service_norm(spark, service, expected):
    assert evaluate(spark, [service], lambda v: c.service_norm(v, SERVICE_MAP)) == [expected]


def test_service_norm_without_map(spark):
    assert evaluate(spark, ["mdns", None, "ssl"], lambda v: c.service_norm(v, {})) == ["mdns", "other", "ssl"]


def test_category_features(spark):
    states = ["sf", " S0 ", "-", "", None, "ODD", "rstrh", "unk"]
    assert evaluate(spark, states, c.conn_state_norm) == ["SF", "S0", "UNK", "UNK", "UNK", "UNK", "RSTRH", "UNK"]
    protos = [" TCP", "-", "", None, "nan", "Sctp"]
    assert evaluate(spark, protos, c.proto_norm) == ["tcp", "unknown", "unknown", "unknown", "unknown", "sctp"]
    arrows = ["i↔i", "i→e", "e→i", "e↔e", "-", None, "e_e", "sideways"]
    assert evaluate(spark, arrows, c.direction_feature) == [
        "i_i", "i_to_e", "e_to_i", "e_e", "unknown", "unknown", "e_e", "unknown",
    ]


def test_attack_type(spark):
    kinds = [None, "", " None ", "DDoS "]
    assert evaluate(spark, kinds, lambda v: c.attack_type_norm(v, "attack")) == [
        "unknown_attack", "unknown_attack", "unknown_attack", "ddos",
    ]
    assert evaluate(spark, kinds, lambda v: c.attack_type_norm(v, "normal")) == ["none"] * 4


def test_numbers_never_raise(spark):
    texts = ["5.0", "-", "", None, "nan", "1e3", " 7 ", "inf"]
    assert evaluate(spark, texts, coercion.number_or_null) == [5.0, None, None, None, None, 1000.0, 7.0, math.inf]
    assert evaluate(spark, texts[:7], coercion.whole_or_zero) == [5, 0, 0, 0, 0, 1000, 7]
    assert evaluate(spark, ["99999999999"], coercion.whole_or_null) == [None]


def test_epoch(spark):
    rule = lambda v: F.unix_micros(coercion.epoch_to_timestamp(v))
    assert evaluate(spark, ["1.15", "soon", None, "-0.5"], rule) == [1150000, None, None, -500000]


def test_flow_signals(spark):
    history = ["S", "Sh", "ShAD", "D", "Dd", "SH", "", "^s"]
    assert evaluate(spark, history, flow.syn_noack) == [1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]
    assert evaluate(spark, history, flow.echo_like) == [False, False, True, True, False, False, False, False]
    times = [0.0, 19.9, 20.0, 45.5, -0.5]
    assert evaluate(spark, times, lambda v: flow.time_bin(v, 20), "double") == [0, 0, 20, 40, -20]


def reference_valid(ip):
    try:
        return ipaddress.ip_address(ip)
    except ValueError:
        return None


def test_addresses_against_the_standard_library(spark):
    rng = random.Random(7)
    texts = [
        "", "::", "::1", "1::", "::1.2.3.4", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2::3::4",
        ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "1:2:3:4:5:6:7:8:9", "12345::", "fe80::1%eth0", "fe80::1%",
        "::ffff:10.0.0.1", "::ffff:8.8.8.8", "::ffff:192.0.0.9", "2001:1::1", "2001:1::3", "2001:3::9",
        "2001:20::1", "2001:40::", "2001:200::", "2001:db8::5", "64:ff9b:1::9", "64:ff9b::9", "fec0::",
        "01.2.3.4", "256.1.1.1", "1.2.3", "192.0.0.9", "192.0.0.11", "192.0.0.170", "100.64.0.1",
        "172.15.0.1", "172.31.1.1", "198.20.1.1", "239.1.1.1", "255.255.255.255", "169.254.1.1", ":", ":::",
    ]
    for _ in range(400):
        texts.append(str(ipaddress.IPv4Address(rng.getrandbits(32))))
        six = ipaddress.IPv6Address(rng.choice([rng.getrandbits(128), rng.getrandbits(20), 0x2001 << 112 | rng.getrandbits(105)]))
        texts += [str(six), six.exploded.upper()]
        broken = str(six)
        at = rng.randrange(len(broken))
        texts.append(broken[:at] + rng.choice(":.0g%") + broken[at + 1:])
    valid = evaluate(spark, [*texts, None], is_valid_ip)
    internal = evaluate(spark, [*texts, None], is_internal)
    for text, ok, inside in zip(texts, valid, internal):
        known = reference_valid(text)
        assert ok == (known is not None), text
        assert inside == (known is not None and (known.is_private or known.is_link_local)), text
    assert valid[-1] is False and internal[-1] is False


def test_severity_rank(spark):
    assert evaluate(spark, ["low", "med", "high", "odd", None], c.severity_rank) == [0, 1, 2, 0, 0]
