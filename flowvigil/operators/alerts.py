"""Scored-flow split, alert merge and alert cooldown."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowvigil.config import FALLBACK_THRESHOLD, MergeConfig
from flowvigil.functions.coercion import number_or_null, text_or
from flowvigil.operators.detectors import moment
from flowvigil.operators.ordering import newest
from flowvigil.operators.prepare import ensure_columns
from flowvigil.schema import MERGED_ALERT

TIME_COLUMNS = ("ts_merged", "ts_generated", "ts")
COOLDOWN_KEY = ("type", "attacker_ip", "target_ip")
# Scores this close above the threshold still count as normal.
SCORE_TOLERANCE = 1e-12


def with_prediction(
    scored: DataFrame, threshold: float | None = None, inclusive: bool = False
) -> DataFrame:
    """Add ``pred`` and ``margin``; a score equal to the threshold is normal unless ``inclusive``."""
    limit = FALLBACK_THRESHOLD if threshold is None else threshold
    score = F.col("p_cal")
    hit = score >= limit if inclusive else score > limit + SCORE_TOLERANCE
    return scored.withColumns(
        {"pred": F.coalesce(hit, F.lit(False)).cast("int"), "margin": score - limit}
    )


def split_scored(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flows the model flags, and flows that go on to the rules."""
    return scored.where("pred = 1"), scored.where("pred = 0")


def time_column(df: DataFrame) -> str | None:
    return next((c for c in TIME_COLUMNS if c in df.columns), None)


def recent_alerts(df: DataFrame, seconds: int) -> DataFrame:
    """Alerts within ``seconds`` of the newest one; all of them when no time is usable."""
    column = time_column(df)
    if not column or seconds <= 0:
        return df
    time = number_or_null(column)
    newest = df.agg(F.max(time)).scalar()
    return df.where(newest.isNull() | (time >= newest - seconds))


def tag_source(df: DataFrame, name: str) -> DataFrame:
    source = F.lower(text_or("source", name)) if "source" in df.columns else F.lit(name)
    return df.withColumn("source", source)


def newest_rows(df: DataFrame, max_rows: int) -> DataFrame:
    """The newest ``max_rows`` rows; 0 keeps all."""
    column = time_column(df)
    if not max_rows:
        return df
    if not column:
        return df.orderBy(*[F.col(c) for c in df.columns]).limit(max_rows)
    return newest(df, number_or_null(column), [F.col(c) for c in df.columns if c != column], max_rows)


def _merge_shape(df: DataFrame) -> DataFrame:
    kept = [f for f in MERGED_ALERT.fields if f.name != "ts_merged"]
    full = ensure_columns(df, MERGED_ALERT)
    return full.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in kept])


def merge_alerts(
    model_alerts: DataFrame,
    rule_alerts: DataFrame,
    as_of: float | Column,
    cfg: MergeConfig = MergeConfig(),
    previous: DataFrame | None = None,
) -> DataFrame:
    """Model and rule alerts in one layout, stamped, without those still cooling down.

    ``previous`` holds the alerts merged before; without it nothing is suppressed.
    """
    parts = []
    for alerts, name in ((model_alerts, "ml"), (rule_alerts, "rules")):
        kept = tag_source(recent_alerts(alerts, cfg.window_seconds), name)
        parts.append(_merge_shape(newest_rows(kept, cfg.max_rows)))
    merged = reduce(DataFrame.unionByName, parts).withColumn("ts_merged", moment(as_of))
    if previous is None:
        return merged
    return suppress_repeated(merged, previous, as_of, cfg.cooldown_seconds)


def suppress_repeated(
    alerts: DataFrame, previous: DataFrame, as_of: float | Column, cooldown_seconds: int
) -> DataFrame:
    """Drop alerts whose type, attacker and target were merged within the cooldown.

    Missing parts of the key match missing parts. An alert without any of the three has no
    identity to repeat and always passes; it also takes no part in the join.
    """
    if cooldown_seconds <= 0:
        return alerts
    time = number_or_null("ts_merged")
    recent = (
        previous.where(time >= moment(as_of) - cooldown_seconds)
        .select(*[F.col(k).alias(f"_{k}") for k in COOLDOWN_KEY])
        .distinct()
    )
    identified = F.coalesce(*COOLDOWN_KEY).isNotNull()
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in COOLDOWN_KEY])
    fresh = alerts.where(identified).join(recent, same, "left_anti")
    return fresh.unionByName(alerts.where(~identified))


def first_per_identity(alerts: DataFrame) -> DataFrame:
    """One alert per type, attacker and target (the earliest); unidentified ones all stay."""
    identified = F.coalesce(*COOLDOWN_KEY).isNotNull()
    order = [F.col(c) for c in ("ts", *[c for c in alerts.columns if c != "ts"])]
    rank = F.row_number().over(Window.partitionBy(*COOLDOWN_KEY).orderBy(*order))
    first = alerts.where(identified).withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    return first.unionByName(alerts.where(~identified))
