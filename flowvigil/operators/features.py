"""Feature matrix of the flow classifier: fitted once, applied the same way everywhere."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from flowvigil.functions import categories
from flowvigil.functions.coercion import number_or_zero, text_or
from flowvigil.operators.ordering import exact_quantiles
from flowvigil.schema import CONN_STATES
from flowvigil.staging import Staging

METRICS = ("bytes_total", "pkts_total", "bytes_ratio", "bps", "pps")
FLAGS = ("is_zero_bytes", "is_priv_port", "is_ephemeral")
CATEGORIES = ("proto", "service_norm", "conn_state", "flow_dir")
RARE_SERVICE = "service_other_rare"

# Rate denominator guard, clipping quantile, kept services, port borders.
EPSILON = 1e-6
CLIP_QUANTILE = 0.995
TOP_SERVICES = 60
PRIVILEGED_BELOW = 1024
EPHEMERAL_FROM = 49152

# A category with more levels than this does not fit a one-column-per-level matrix.
MAX_LEVELS = 2000


def _number(df: DataFrame, name: str) -> Column:
    return number_or_zero(name) if name in df.columns else F.lit(0.0)


def with_category_features(df: DataFrame) -> DataFrame:
    """Normalized category columns; ``service_norm`` falls back to ``service``."""
    service = next((F.col(c) for c in ("service_norm", "service") if c in df.columns), F.lit(None))
    columns = {"service_norm": categories.service_feature(service.cast("string"))}
    for name, rule in (
        ("conn_state", categories.conn_state_norm),
        ("proto", categories.proto_norm),
        ("flow_dir", categories.direction_feature),
    ):
        if name in df.columns:
            columns[name] = rule(name)
    return df.withColumns(columns)


def with_metrics(df: DataFrame) -> DataFrame:
    """Volume, ratio and rate metrics; a missing or bad number counts as 0."""
    sent, received = _number(df, "orig_bytes"), _number(df, "resp_bytes")
    size = sent + received
    packets = _number(df, "orig_pkts") + _number(df, "resp_pkts")
    seconds = _number(df, "duration") + EPSILON
    return df.withColumns(
        {
            "bytes_total": size,
            "pkts_total": packets,
            "bytes_ratio": sent / F.when(received == 0, 1.0).otherwise(received),
            # A duration of exactly -EPSILON has no rate.
            "bps": F.coalesce(F.try_divide(size * 8.0, seconds), F.lit(0.0)),
            "pps": F.coalesce(F.try_divide(packets, seconds), F.lit(0.0)),
        }
    )


def clip_bounds(
    df: DataFrame, staging: Staging, quantile: float = CLIP_QUANTILE, columns: Sequence[str] = METRICS
) -> dict[str, list[float]]:
    """Lower and upper clipping bound of every metric: two numbers per column."""
    table = exact_quantiles(df, columns, (1 - quantile, quantile), staging)
    bounds: dict[str, list[float]] = {}
    for row in table.groupBy("column_name").agg(
        F.min("value").alias("low"), F.max("value").alias("high")
    ).collect():
        bounds[row.column_name] = [row.low, row.high]
    return bounds


def approximate_clip_bounds(
    df: DataFrame, quantile: float = CLIP_QUANTILE, relative_error: float = 1e-4,
    columns: Sequence[str] = METRICS,
) -> dict[str, list[float]]:
    """Bounds from a quantile sketch: one pass, no shuffle of the values."""
    found = df.approxQuantile(list(columns), [1 - quantile, quantile], relative_error)
    return {c: list(pair) for c, pair in zip(columns, found) if pair}


def clip(df: DataFrame, bounds: dict[str, list[float]]) -> DataFrame:
    return df.withColumns(
        {
            c: F.least(F.greatest(F.col(c), F.lit(float(low))), F.lit(float(high)))
            for c, (low, high) in bounds.items()
        }
    )


def with_flags(df: DataFrame) -> DataFrame:
    """0/1 marks; 'zero bytes' looks at the metric after clipping."""
    port = _number(df, "resp_p")
    return df.withColumns(
        {
            "is_zero_bytes": (F.col("bytes_total") == 0).cast("tinyint"),
            "is_priv_port": (port < PRIVILEGED_BELOW).cast("tinyint"),
            "is_ephemeral": (port >= EPHEMERAL_FROM).cast("tinyint"),
        }
    )


def top_services(df: DataFrame, k: int = TOP_SERVICES) -> DataFrame:
    """The ``k`` most frequent services, ties by name."""
    counts = df.groupBy("service_norm").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("service_norm")).limit(k)


def keep_services(df: DataFrame, services: Sequence[str]) -> DataFrame:
    kept = F.col("service_norm").isin(*services) if services else F.lit(False)
    return df.withColumn("service_norm", F.when(kept, F.col("service_norm")).otherwise(RARE_SERVICE))


def safe_name(name: str) -> str:
    return re.sub(r"[^0-9A-Za-z_]", "_", name)


def one_hot_columns(levels: dict[str, Sequence[str]]) -> dict[str, Column]:
    """A 0/1 column per level; levels whose safe names collide share one column."""
    members: dict[str, tuple[str, list[str]]] = {}
    for category, values in levels.items():
        for value in values:
            members.setdefault(safe_name(f"{category}_{value}"), (category, []))[1].append(value)
    return {
        name: F.col(category).isin(*values).cast("tinyint")
        for name, (category, values) in members.items()
    }


def category_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Distinct values per category, sorted."""
    present = [c for c in columns if c in df.columns]
    pairs = (
        df.select(*present).unpivot([], present, "category", "value").distinct()
        .limit(MAX_LEVELS * max(len(present), 1) + 1).collect()
    )
    levels = {c: sorted(p.value for p in pairs if p.category == c) for c in present}
    crowded = [c for c, values in levels.items() if len(values) > MAX_LEVELS]
    if crowded:
        raise ValueError(f"more than {MAX_LEVELS} levels in {crowded}: too many for one-hot columns")
    return levels


def with_targets(df: DataFrame) -> DataFrame:
    """``y_bin`` and ``y_multi``; a missing label is normal, a missing attack type is none."""
    label = F.col("label") if "label" in df.columns else F.lit("normal")
    kind = text_or("attack_type", "none") if "attack_type" in df.columns else F.lit("none")
    return df.withColumns(
        {
            "y_bin": (F.lower(F.coalesce(label, F.lit("normal"))) == "attack").cast("int"),
            "y_multi": kind,
        }
    )


def align(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly the given columns in the given order: missing ones are 0, others are dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in columns])


@dataclass(frozen=True)
class FeatureModel:
    """Everything the transformation learns from the training flows."""

    bounds: dict = field(default_factory=dict)
    services: list = field(default_factory=list)
    levels: dict = field(default_factory=dict)

    @staticmethod
    def fit(
        flows: DataFrame,
        staging: Staging,
        k: int = TOP_SERVICES,
        quantile: float = CLIP_QUANTILE,
        exact: bool = True,
    ) -> FeatureModel:
        rows = with_metrics(with_category_features(flows))
        present = [c for c in CATEGORIES if c in rows.columns]
        rows = staging.table(rows.select(*present, *METRICS), "feature-fit")
        services = [r.service_norm for r in top_services(rows, k).collect()]
        levels = category_levels(keep_services(rows, services), present)
        # The states form a closed set: all of them get a column, seen or not.
        if "conn_state" in levels:
            levels["conn_state"] = sorted({*levels["conn_state"], *CONN_STATES})
        bounds = clip_bounds(rows, staging, quantile) if exact else approximate_clip_bounds(rows, quantile)
        return FeatureModel(bounds, services, levels)

    @property
    def columns(self) -> list[str]:
        return [*METRICS, *FLAGS, *one_hot_names(self.levels)]

    def transform(self, flows: DataFrame, keep: Sequence[str] = ("uid",)) -> DataFrame:
        """Feature columns beside the ``keep`` columns and the targets."""
        rows = with_metrics(with_category_features(flows))
        rows = keep_services(with_flags(clip(rows, self.bounds)), self.services)
        rows = with_targets(rows)
        return rows.select(
            *[c for c in keep if c in flows.columns],
            *[F.col(c).cast("float").alias(c) for c in METRICS],
            *FLAGS,
            *[c.alias(name) for name, c in one_hot_columns(self._known(rows)).items()],
            "y_bin",
            "y_multi",
        )

    def matrix(self, flows: DataFrame, keep: Sequence[str] = ("uid",)) -> DataFrame:
        """``transform`` with exactly the fitted feature columns, whatever the flows carry."""
        rows = self.transform(flows, keep)
        kept = [c for c in keep if c in flows.columns]
        return align(rows, [*kept, *self.columns, "y_bin", "y_multi"])

    def _known(self, rows: DataFrame) -> dict:
        return {c: values for c, values in self.levels.items() if c in rows.columns}

    def to_json(self) -> str:
        # The order of the categories is the order of the columns, so keys are not sorted.
        return json.dumps(asdict(self), ensure_ascii=False)

    @staticmethod
    def from_json(text: str) -> FeatureModel:
        return FeatureModel(**json.loads(text))


def one_hot_names(levels: dict[str, Sequence[str]]) -> list[str]:
    names = (safe_name(f"{category}_{value}") for category, values in levels.items() for value in values)
    return list(dict.fromkeys(names))
