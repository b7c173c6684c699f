"""Rule profiles, service map and thresholds from files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from flowvigil.config import (
    DEFAULT,
    FALLBACK_THRESHOLD,
    RULE_FILES,
    SERVICE_DEFAULT,
    RuleProfile,
    Thresholds,
    profile_from_json,
)
from flowvigil.sources.flow_logs import path_exists
from flowvigil.sources.sinks import read_text, write_text


def _whole_text(spark: SparkSession, path: str) -> str | None:
    """Text of one small settings file, None when it does not exist."""
    if not path_exists(spark, path):
        return None
    rows = spark.read.text(path, wholetext=True).collect()
    return rows[0].value if rows else ""


def load_profile(spark: SparkSession, folder: str, base: RuleProfile = DEFAULT) -> RuleProfile:
    """Profile from ``<folder>/<detector>.json``; absent files and keys keep ``base``."""
    texts = {name: _whole_text(spark, f"{folder}/{name}.json") for name in RULE_FILES}
    return profile_from_json({name: text for name, text in texts.items() if text}, base)


def load_service_map(spark: SparkSession, path: str | None) -> tuple[dict[str, str], str]:
    """Service mapping and default from a YAML file with ``map`` and ``default``."""
    text = _whole_text(spark, path) if path else None
    if text is None:
        return {}, SERVICE_DEFAULT
    values = _yaml(text)
    return dict(values.get("map", {})), values.get("default", SERVICE_DEFAULT)


def load_threshold(spark: SparkSession, path: str) -> float:
    """Decision threshold from a YAML file, 0.5 when there is none."""
    text = _whole_text(spark, path)
    values = _yaml(text) if text else {}
    return float(values.get("binary", {}).get("threshold", FALLBACK_THRESHOLD))


def thresholds_yaml(values: Thresholds) -> str:
    return (
        "binary:\n"
        f"  threshold: {values.threshold}\n"
        f"  precision_target: {values.precision_target}\n"
        f"  fpr_target: {values.fpr_target}\n"
    )


def save_thresholds(spark: SparkSession, values: Thresholds, path: str) -> None:
    """Threshold and targets as one YAML file in the folder ``path``."""
    write_text(spark, thresholds_yaml(values), path)


def load_thresholds(spark: SparkSession, path: str) -> Thresholds:
    """Threshold and the targets it was chosen for; what the file lacks keeps its default."""
    values = (_yaml(read_text(spark, path)) or {}).get("binary", {})
    known = ("threshold", "precision_target", "fpr_target")
    return Thresholds(**{key: float(values[key]) for key in known if key in values})


def _yaml(text: str) -> dict:
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading YAML settings needs the yaml package") from error
    return yaml.safe_load(text) or {}
