"""Readers for flow logs and alert logs, all with a fixed schema and no inference."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from flowvigil.functions.coercion import number_or_null, strip
from flowvigil.operators.prepare import ENDPOINT_ALIASES
from flowvigil.schema import FLOW, FLOW_OPTIONAL, SCORED_FLOW

_DOTTED = {plain: dotted for dotted, plain in ENDPOINT_ALIASES.items()}
_RECORD = T.StructType(FLOW.fields + FLOW_OPTIONAL.fields)

# Columns of the tab-separated flow log, in file order.
TSV_COLUMNS = (
    "ts", "uid", "orig_h", "orig_p", "resp_h", "resp_p", "proto", "service", "duration",
    "orig_bytes", "resp_bytes", "conn_state", "missed_bytes", "history", "orig_pkts", "resp_pkts",
)


def log_schema(schema: T.StructType = _RECORD) -> T.StructType:
    """The schema under the dotted endpoint names that log files use."""
    return T.StructType([T.StructField(_DOTTED.get(f.name, f.name), f.dataType) for f in schema.fields])


def _plain_names(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(ENDPOINT_ALIASES.get(c, c)) for c in df.columns])


def _with_time(df: DataFrame) -> DataFrame:
    """Rows without a time are not flows: header text, comments, broken lines."""
    return df.where(F.col("ts").isNotNull())


def read_flow_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One JSON object per line; absent fields are NULL."""
    return _with_time(_plain_names(spark.read.schema(log_schema()).json(path)))


def read_flow_json_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The same log as a stream of newly landed files."""
    reader = spark.readStream.schema(log_schema())
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_time(_plain_names(reader.json(folder)))


def read_flow_tsv(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] = TSV_COLUMNS
) -> DataFrame:
    """Tab-separated log with '#' header lines and '-' for an unset field."""
    types = {f.name: f for f in _RECORD.fields}
    reader = spark.read.schema(T.StructType([types[c] for c in columns]))
    rows = reader.option("sep", "\t").option("comment", "#").option("nullValue", "-").option(
        "quote", ""
    ).csv(path)
    return _with_time(rows.select(*[_present(f, columns) for f in _RECORD.fields]))


def _present(field: T.StructField, columns: Sequence[str]) -> Column:
    value = F.col(field.name) if field.name in columns else F.lit(None).cast(field.dataType)
    return value.alias(field.name)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Comma-separated file with a header; columns are matched by name.

    Columns named in ``schema`` are converted, bad text becoming NULL; others stay text.
    """
    rows = _plain_names(spark.read.option("header", True).csv(path))
    return typed(rows, schema or _RECORD)


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns converted to the types of ``schema``; bad text becomes NULL."""
    types = {f.name: f.dataType for f in schema.fields}
    return rows.withColumns(
        {
            c: number_or_null(c).try_cast(types[c])
            for c in rows.columns
            if isinstance(types.get(c), T.NumericType)
        }
    )


def read_csv_without_header(
    spark: SparkSession, path: str | list[str], schema: T.StructType = SCORED_FLOW
) -> DataFrame:
    """Comma-separated file with forced names: long lines are skipped, short ones are padded."""
    lines = spark.read.text(path).where(strip("value") != "")
    # Separators inside quotes do not count towards the width of a line.
    bare = F.regexp_replace("value", '"(?:[^"]|"")*"', "")
    fitting = lines.where(F.size(F.split(bare, ",")) <= len(schema.fields))
    fields = F.from_csv("value", ", ".join(f"{name} string" for name in schema.names), {"mode": "PERMISSIVE"})
    return typed(fitting.select(fields.alias("f")).select("f.*"), schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.globStatus(target))


def scan_or_empty(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    read: Callable[[SparkSession, str], DataFrame] | None = None,
    skip_corrupt: bool = False,
) -> DataFrame:
    """The table at ``path``, or no rows when there is nothing there yet.

    The default reader is parquet. An unreadable file is an error; with ``skip_corrupt`` it is
    passed over, and ``skipped_files`` tells which files were.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    if read is not None:
        return read(spark, path)
    return spark.read.schema(schema).option("ignoreCorruptFiles", skip_corrupt).parquet(path)


def skipped_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The files (column ``file``) that ``skip_corrupt`` passes over: those that give no row.

    A file without rows is listed too. One row per file, so this stays small next to the table.
    """
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(
        F.col("path").alias("file")
    )
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(path)
    read = rows.select(F.col("_metadata.file_path").alias("file")).distinct()
    plain = F.regexp_replace("file", "^file:/+", "/")
    return there.select(plain.alias("file")).join(read.select(plain.alias("file")), "file", "left_anti")
