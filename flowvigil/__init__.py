"""Attack detection over network flow records on Apache Spark."""

__version__ = "0.1.0"
