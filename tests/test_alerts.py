import pytest

from flowvigil.config import BanConfig, MergeConfig, override
from flowvigil.operators import alerts as a, browse, response
from flowvigil.schema import BAN_STATE, MERGED_ALERT, RULE_ALERT

ALERT = "ts_merged double, type string, severity string, attacker_ip string, target_ip string, source string"


def test_strict_threshold(spark):
    scored = spark.createDataFrame([(0.8,), (0.8 + 1e-13,), (0.81,), (None,)], "p_cal double")
    assert [r.pred for r in a.with_prediction(scored, 0.8).collect()] == [0, 0, 1, 0]
    assert [r.pred for r in a.with_prediction(scored, 0.8, inclusive=True).collect()] == [1, 1, 1, 0]
    assert [r.pred for r in a.with_prediction(scored).collect()] == [1, 1, 1, 0]


def test_merge_layout_and_window(spark):
    model = spark.createDataFrame([(10.0, "u1", 1, 0.9), (200.0, "u2", 1, 0.95)], "ts double, uid string, pred int, p_cal double")
    rules = spark.createDataFrame([(190.0, "ddos", None, "v", "RULES"), (50.0, "ddos", None, "w", None)], "ts_generated double, type string, attacker_ip string, target_ip string, source string")
    merged = a.merge_alerts(model, rules, 300.0, MergeConfig(window_seconds=100))
    assert merged.columns == MERGED_ALERT.names
    got = {(r.source, r.uid or "", r.target_ip or "", r.ts_merged) for r in merged.collect()}
    assert got == {("ml", "u2", "", 300.0), ("rules", "", "v", 300.0)}


def test_cooldown_matches_missing_parts(spark):
    previous = spark.createDataFrame(
        [(95.0, "port_scan", "med", "a", None, "rules"), (10.0, "ddos", "med", None, "v", "rules"), (99.0, None, None, None, None, "ml")], ALERT
    )
    fresh = spark.createDataFrame(
        [(100.0, "port_scan", "med", "a", None, "rules"), (100.0, "port_scan", "med", "a", "b", "rules"),
         (100.0, "ddos", "med", None, "v", "rules"), (100.0, None, None, None, None, "ml"), (100.0, None, None, None, None, "ml")], ALERT
    )
    kept = a.suppress_repeated(fresh, previous, 100.0, 30)
    assert sorted((r.type or "", r.attacker_ip or "", r.target_ip or "") for r in kept.collect()) == [
        ("", "", ""), ("", "", ""), ("ddos", "", "v"), ("port_scan", "a", "b"),
    ]
    assert a.suppress_repeated(fresh, previous, 100.0, 0).count() == 5


def bans(spark, rows, state=(), **changes):
    alerts = spark.createDataFrame(rows, ALERT)
    held = spark.createDataFrame(list(state), BAN_STATE)
    cfg = BanConfig(**changes)
    return alerts, held, response.ban_decisions(alerts, held, 1000.0, cfg)


def test_ban_selection(spark):
    rows = [(990.0, "port_scan", " HIGH ", " 9.9.9.1 ", "t", "Rules")] * 3
    rows += [(990.0, "port_scan", "med", "9.9.9.2", "t", "rules")] * 2
    rows += [(990.0, "port_scan", "med", "9.9.9.3", "t", "rules")]
    rows += [(990.0, "port_scan", "low", "9.9.9.4", "t", "rules"), (990.0, "x", "med", "9.9.9.5", "t", "other"),
             (990.0, "x", "med", "nan", "t", "ml"), (990.0, "x", "med", None, "t", "ml"),
             (990.0, "x", "high", "192.168.1.36", "t", "ml"), (10.0, "x", "high", "9.9.9.6", "t", "ml")]
    _, _, due = bans(spark, rows, ban_limit=2, since_seconds=100)
    assert [(r.ip, r.n_rows, r.added_ts, r.expires_ts) for r in due.orderBy("ip").collect()] == [
        ("9.9.9.1", 3, 1000.0, 1600.0), ("9.9.9.2", 2, 1000.0, 1600.0),
    ]
    _, _, proven = bans(spark, rows, proof_min=2, exclude_types=("x",))
    assert {r.ip for r in proven.collect()} == {"9.9.9.1", "9.9.9.2"}
    _, _, latest = bans(spark, [*rows, (995.0, "x", "med", "9.9.9.9", "t", "ml")], only_latest=True)
    assert [r.ip for r in latest.collect()] == ["9.9.9.9"]


def test_ban_cooldown_and_state(spark):
    rows = [(990.0, "port_scan", "high", f"9.9.9.{i}", "t", "rules") for i in range(1, 4)]
    _, held, due = bans(spark, rows, [("9.9.9.1", 941.0), ("9.9.9.2", 940.0), ("8.8.8.8", 5.0)])
    assert {r.ip for r in due.collect()} == {"9.9.9.2", "9.9.9.3"}
    state = {r.ip: r.last_added_ts for r in response.updated_state(held, due).collect()}
    assert state == {"9.9.9.1": 941.0, "9.9.9.2": 1000.0, "9.9.9.3": 1000.0, "8.8.8.8": 5.0}
    assert response.updated_state(held, due, dry_run=True).count() == 3
    assert {r.line for r in response.ban_log(due).collect()} == {
        "ipset add ml_blacklist 9.9.9.2 timeout 600", "ipset add ml_blacklist 9.9.9.3 timeout 600",
    }


def test_whitelist_sources(spark, tmp_path):
    (tmp_path / "allow.txt").write_text("1.1.1.1\n\nbogus\n 2.2.2.2 \n")
    found = {r.ip for r in response.whitelist(spark, ("3.3.3.3", "x"), str(tmp_path / "allow.txt")).collect()}
    assert found == {"127.0.0.1", "::1", "1.1.1.1", "2.2.2.2", "3.3.3.3"}


def test_browse(spark):
    alerts = spark.createDataFrame(
        [(1.0, "x", "HIGH", "a", "b", "ML"), (3.0, "y", "med", "a", "b", "rules"), (2.0, "z", "low", "a", "b", "ml"), (4.0, "w", "odd", "a", "b", "ml")], ALERT
    )
    assert [r.type for r in browse.browse_alerts(alerts).collect()] == ["y", "x"]
    assert [r.type for r in browse.browse_alerts(alerts, "low", (), limit=3).collect()] == ["w", "y", "z"]


def test_alerts_need_a_time(spark):
    with pytest.raises(ValueError):
        response.clean_alerts(spark.createDataFrame([("x",)], "type string"))
    assert RULE_ALERT.names[0] == "ts_generated"


def test_nothing_is_capped_by_default(spark):
    assert MergeConfig().max_rows == 0
    with pytest.raises(TypeError):
        override(BanConfig(), {"only_latest": "false"})
    with pytest.raises(TypeError):
        override(BanConfig(), {"sources": "rules"})
    assert override(BanConfig(), {"ban_limit": 5.0, "sources": ["ml"]}) == BanConfig(ban_limit=5, sources=("ml",))
