"""Data profile of a flow table: size, time range, null rates and frequent values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

TOP_VALUE_COLUMNS = ("service_norm", "conn_state", "proto", "flow_dir")


def size_and_range(df: DataFrame, time_column: str = "event_time") -> DataFrame:
    """One row: rows, columns, first and last event time."""
    bounds = (
        [F.min(time_column).alias("time_min"), F.max(time_column).alias("time_max")]
        if time_column in df.columns
        else []
    )
    return df.agg(
        F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_cols"), *bounds
    )


def null_rates(df: DataFrame, limit: int = 30) -> DataFrame:
    """The columns with the most missing values, in one pass over the data."""
    rates = df.agg(
        *[
            F.round(F.avg(F.col(f"`{c}`").isNull().cast("int")), 4).alias(c.replace(".", "_"))
            for c in df.columns
        ]
    )
    return (
        rates.unpivot([], rates.columns, "column_name", "null_rate")
        .orderBy(F.desc("null_rate"), "column_name")
        .limit(limit)
    )


def top_values(
    df: DataFrame, columns: tuple[str, ...] = TOP_VALUE_COLUMNS, limit: int = 15
) -> DataFrame:
    """The most frequent values of each column, ties by value, in one pass over the data."""
    present = [c for c in columns if c in df.columns]
    values = df.select(*[F.col(c).cast("string") for c in present]).unpivot(
        [], present, "column_name", "value"
    )
    counts = values.where(F.col("value").isNotNull()).groupBy("column_name", "value").count()
    rank = F.row_number().over(
        Window.partitionBy("column_name").orderBy(F.desc("count"), F.asc("value"))
    )
    return (
        counts.withColumn("position", rank)
        .where(F.col("position") <= limit)
        .select("column_name", "position", "value", F.col("count").alias("n"))
    )


def frequencies(df: DataFrame, columns: list[str], limit: int | None = None) -> DataFrame:
    """Row counts per value combination, most frequent first."""
    counts = df.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *columns)
    return counts if limit is None else counts.limit(limit)
