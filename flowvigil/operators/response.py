"""Ban decisions: which addresses to block, until when, and the state that remembers them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowvigil.config import BUILTIN_WHITELIST, BanConfig
from flowvigil.functions.address import is_valid_ip
from flowvigil.functions.categories import severity_rank
from flowvigil.functions.coercion import number_or_zero, strip
from flowvigil.functions.flow import in_set
from flowvigil.operators.alerts import time_column
from flowvigil.operators.detectors import moment
from flowvigil.schema import BAN_STATE, SEVERITIES


def _text(df: DataFrame, name: str) -> Column:
    return F.coalesce(strip(name), F.lit("")) if name in df.columns else F.lit("")


def clean_alerts(alerts: DataFrame) -> DataFrame:
    """Trimmed text, lower-case labels, absent text as '', and the alert time as ``alert_ts``."""
    column = time_column(alerts)
    if column is None:
        raise ValueError("alerts carry no time column")
    lowered = {c: F.lower(_text(alerts, c)) for c in ("severity", "source", "type")}
    trimmed = {c: _text(alerts, c) for c in ("attacker_ip", "target_ip")}
    return alerts.withColumns({**lowered, **trimmed, "alert_ts": number_or_zero(column)})


def select_alerts(alerts: DataFrame, cfg: BanConfig, as_of: float | Column) -> DataFrame:
    """Alerts that may lead to a ban."""
    rows = clean_alerts(alerts)
    if cfg.only_latest:
        rows = rows.where(F.col("alert_ts") == rows.agg(F.max("alert_ts")).scalar())
    elif cfg.since_seconds > 0:
        rows = rows.where(F.col("alert_ts") >= moment(as_of) - cfg.since_seconds)
    keep = (
        (severity_rank("severity") >= SEVERITIES.index(cfg.min_severity))
        & in_set("source", cfg.sources)
        & (F.col("attacker_ip") != "")
    )
    if cfg.types:
        keep &= in_set("type", cfg.types)
    if cfg.exclude_types:
        keep &= ~in_set("type", cfg.exclude_types)
    return rows.where(keep)


def whitelist(
    spark: SparkSession, addresses: tuple[str, ...] = (), path: str | None = None
) -> DataFrame:
    """Built-in, listed and file-listed addresses; anything that is not an address is left out."""
    listed = F.array(*[F.lit(a) for a in (*BUILTIN_WHITELIST, *addresses)])
    known = spark.range(1).select(F.explode(listed).alias("ip"))
    if path:
        known = known.unionByName(spark.read.text(path).select(F.col("value").alias("ip")))
    return known.select(strip("ip").alias("ip")).where(is_valid_ip("ip")).distinct()


def ban_candidates(selected: DataFrame, cfg: BanConfig, allowed: DataFrame) -> DataFrame:
    """Attackers with enough alerts that are addresses and not allowed, with their number of alerts."""
    counts = selected.groupBy(F.col("attacker_ip").alias("ip")).agg(F.count("*").alias("n_rows"))
    proven = counts.where((F.col("n_rows") >= max(1, cfg.proof_min)) & is_valid_ip("ip"))
    return proven.join(allowed, "ip", "left_anti")


def ban_decisions(
    alerts: DataFrame,
    state: DataFrame,
    as_of: float | Column,
    cfg: BanConfig = BanConfig(),
    allowed: DataFrame | None = None,
) -> DataFrame:
    """Addresses to block now: candidates whose last ban is at least one cooldown ago.

    Those with most alerts come first, ties by address, and ``ban_limit`` of them are blocked at most. Neither an
    address that cools down nor text that is no address takes the place of one that is due.
    """
    if allowed is None:
        allowed = whitelist(alerts.sparkSession)
    candidates = ban_candidates(select_alerts(alerts, cfg, as_of), cfg, allowed)
    last = F.coalesce(number_or_zero("last_added_ts"), F.lit(0.0))
    due = candidates.join(state, "ip", "left").where(
        moment(as_of) - last >= max(0, cfg.cooldown_seconds)
    )
    if cfg.ban_limit:
        due = due.orderBy(F.desc("n_rows"), "ip").limit(cfg.ban_limit)
    return due.select(
        "ip",
        "n_rows",
        moment(as_of).alias("added_ts"),
        (moment(as_of) + cfg.block_seconds).alias("expires_ts"),
        F.lit(cfg.set_name).alias("set_name"),
    )


def updated_state(
    state: DataFrame, decisions: DataFrame, dry_run: bool = False, expired: float | Column | None = None
) -> DataFrame:
    """Last ban time per address after the decisions; a dry run leaves the state as it is.

    Bans at or before ``expired`` are forgotten: once the cooldown is over they hold nobody back.
    """
    if dry_run:
        return state
    added = decisions.select("ip", F.col("added_ts").alias("last_added_ts"))
    last = (
        state.select(*BAN_STATE.names).unionByName(added)
        .groupBy("ip").agg(F.max("last_added_ts").alias("last_added_ts"))
    )
    return last if expired is None else last.where(F.col("last_added_ts") > moment(expired))


def ban_log(decisions: DataFrame) -> DataFrame:
    """One log line per decision."""
    line = F.format_string(
        "ipset add %s %s timeout %d",
        "set_name",
        "ip",
        (F.col("expires_ts") - F.col("added_ts")).cast("bigint"),
    )
    return decisions.select(F.col("added_ts").alias("ts"), "ip", line.alias("line"))
