"""Intermediate tables that are computed once and read many times.

A staged table is parquet in the shared folder named by ``spark.checkpoint.dir``. It cuts
lineage, survives the loss of executors, keeps column pruning and filter pushdown for its
readers, and gives the optimizer its true size: a join against it is broadcast only when
the files are below ``spark.sql.autoBroadcastJoinThreshold`` and is a shuffle join
otherwise. Use ``NoStaging`` to leave everything in one lazy plan.
"""

from __future__ import annotations

import functools
import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Seconds in which Spark's listeners have heard of a step that has ended.
PAUSE = 0.3


class NoStaging:
    def table(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        return df

    def drop(self) -> None:
        pass

    def release(self) -> None:
        pass


class Staging:
    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{folder or shared_folder(spark)}/flowvigil-{uuid.uuid4().hex}"
        self._tables = 0

    def path(self, name: str) -> str:
        self._tables += 1
        return f"{self.folder}/{self._tables:03d}-{name}"

    def table(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = self.path(name)
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def drop(self) -> None:
        """Delete every table staged here. Call it once their readers are done."""
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(self.folder)
        files = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(target, True)
        self.release()

    def release(self) -> None:
        """Let Spark delete the shuffle files of finished steps now; it does when the driver collects its garbage.

        Python may still hold the last step's frames, and Spark's listeners its plan for a moment: hence two rounds.
        """
        for pause in (PAUSE, 0):
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(pause)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        self.drop()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a scratch folder only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", ""
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_scratch()


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="flowvigil-")
