"""Read-only views for people: latest alerts and latest bans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowvigil.functions.categories import severity_rank
from flowvigil.functions.flow import in_set
from flowvigil.operators.prepare import ensure_columns
from flowvigil.operators.response import clean_alerts
from flowvigil.schema import MERGED_ALERT, SEVERITIES

# The columns shown, in order.
ALERT_COLUMNS = (
    "ts", "ts_merged", "source", "type", "severity", "attacker_ip", "target_ip",
    "proto", "service", "resp_p", "margin", "p_cal",
)
# Texts that mark a ban in the action log.
BAN_MARKS = ("will ADD to ipset=", "ipset add")


def browse_alerts(
    alerts: DataFrame,
    min_severity: str = "med",
    sources: tuple[str, ...] = ("ml", "rules"),
    limit: int = 500,
) -> DataFrame:
    """The newest merged alerts of at least a severity; no sources means every source.

    The last merged come first, and of those the newest flows. Absent text shows as ''; columns that the alerts
    lack are NULL.
    """
    rows = ensure_columns(clean_alerts(alerts), MERGED_ALERT).withColumn("ts_merged", F.col("alert_ts"))
    wanted = severity_rank("severity") >= SEVERITIES.index(min_severity)
    if sources:
        wanted &= in_set("source", tuple(s.lower() for s in sources))
    shown = rows.where(wanted).select(*ALERT_COLUMNS)
    rest = [c for c in ALERT_COLUMNS if c not in ("ts_merged", "ts")]
    return shown.orderBy(F.desc("ts_merged"), F.desc("ts"), *rest).limit(limit)


def recent_bans(log: DataFrame, tail: int = 400, limit: int = 10) -> DataFrame:
    """Ban lines among the last ``tail`` lines of the action log, newest first."""
    last = log.orderBy(F.desc("ts"), F.desc("line")).limit(tail)
    marked = F.col("line").contains(BAN_MARKS[0]) | F.col("line").contains(BAN_MARKS[1])
    return last.where(marked).orderBy(F.desc("ts"), F.desc("line")).limit(limit)
