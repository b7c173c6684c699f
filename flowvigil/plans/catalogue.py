"""All registered queries and their SQL counterparts."""

from importlib import import_module

MODULES = (
    "stream_queries",
    "prepare_queries",
    "rule_queries",
    "alert_queries",
    "model_queries",
    "store_queries",
)


def _collect(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found.update(getattr(import_module(f"flowvigil.plans.{name}"), attribute))
    return found


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _collect("ORACLE")
