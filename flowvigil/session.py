"""Session settings the operators are written for."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Recording a Python call site for every column costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "flowvigil", master: str | None = None, **settings) -> SparkSession:
    """Session with UTC time and adaptive execution; ``settings`` are extra Spark options."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
