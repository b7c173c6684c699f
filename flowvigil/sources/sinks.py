"""Append tables, versioned state, reports and model folders."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowvigil.functions.coercion import epoch_to_timestamp
from flowvigil.schema import BAN_STATE
from flowvigil.sources.flow_logs import path_exists

EVENT_DATE = T.StructField("event_date", T.DateType())
BATCH = T.StructField("batch", T.LongType())


def append_batch(
    df: DataFrame, path: str, batch: int, time_column: str, partition_by: Sequence[str] = ()
) -> None:
    """Append one numbered batch to a table with a folder per event date and batch.

    A batch that runs again, with other rows or other times too, replaces what it wrote before. Days come first, so
    a reader of recent rows lists the folders of recent days only.
    """
    for old in _folders(df.sparkSession, f"{path}/event_date=*/batch={batch}"):
        _delete(df.sparkSession, old)
    append_by_day(df, path, batch, time_column, partition_by)


def append_by_day(
    df: DataFrame, path: str, batch: int, time_column: str, partition_by: Sequence[str] = ()
) -> None:
    """Append one numbered batch to a large table with a folder per event date.

    A retried batch holds the same rows and replaces exactly the partitions it wrote before.
    """
    dated = df.withColumns(
        {
            "event_date": F.to_date(epoch_to_timestamp(time_column)),
            "batch": F.lit(batch).cast("bigint"),
        }
    )
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "event_date", "batch", *partition_by
    ).parquet(path)


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, since: float | None = None
) -> DataFrame:
    """Appended rows; filters on ``event_date`` and ``batch`` skip whole folders.

    With ``since`` the folders of earlier days are not even listed, where days come first.
    """
    full = T.StructType([*schema.fields, EVENT_DATE, BATCH])
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    reader = spark.read.schema(full).option("basePath", path)
    days = _folders(spark, f"{path}/event_date=*")
    if since is None or not days:
        return reader.parquet(path)
    first = f"event_date={datetime.fromtimestamp(since, timezone.utc):%Y-%m-%d}"
    recent = [day for day in days if day.rsplit("/", 1)[-1] >= first]
    return reader.parquet(*recent) if recent else spark.createDataFrame([], full)


def read_since(
    spark: SparkSession, path: str, schema: T.StructType, time_column: str, since: float
) -> DataFrame:
    """Appended rows from ``since`` on; older date folders are not read."""
    rows = read_batches(spark, path, schema, since)
    first_day = F.to_date(epoch_to_timestamp(F.lit(float(since))))
    return rows.where((F.col("event_date") >= first_day) & (F.col(time_column) >= since))


def _delete(spark: SparkSession, folder: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(status.getPath().toString() for status in files.globStatus(target) or [])


class BanState:
    """Last ban time per address as numbered versions; a reader sees only complete ones.

    The last ``KEEP`` versions stay, so a batch that runs again finds the state before it.
    """

    KEEP = 10

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def load(self, before: int | None = None) -> DataFrame:
        """The newest complete version, or the newest one before a given number."""
        complete = [p.rsplit("/", 2)[-2] for p in _folders(self.spark, f"{self.path}/version=*/_SUCCESS")]
        numbers = [int(name.removeprefix("version=")) for name in complete]
        usable = [n for n in numbers if before is None or n < before]
        if not usable:
            return self.spark.createDataFrame([], BAN_STATE)
        return self.spark.read.schema(BAN_STATE).parquet(f"{self.path}/version={max(usable)}")

    def save(self, state: DataFrame, version: int) -> None:
        state.select(*BAN_STATE.names).write.mode("overwrite").parquet(
            f"{self.path}/version={version}"
        )
        for old in _folders(self.spark, f"{self.path}/version=*"):
            if int(old.rsplit("=", 1)[1]) <= version - self.KEEP:
                _delete(self.spark, old)


def write_report(df: DataFrame, path: str) -> None:
    """Profile, metric and calibration reports as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """One small text as one file in the folder ``path``."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first().value


def save_models(models: Sequence[GBTClassificationModel], folder: str) -> None:
    for fold, model in enumerate(models):
        model.write().overwrite().save(f"{folder}/fold={fold:03d}")


def load_models(spark: SparkSession, folder: str) -> list[GBTClassificationModel]:
    """Fold models in fold order; it is an error when there are none."""
    paths = _folders(spark, f"{folder}/fold=*")
    if not paths:
        raise FileNotFoundError(f"no fold models under {folder}")
    return [GBTClassificationModel.load(path) for path in paths]
