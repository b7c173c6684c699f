"""Global row numbers, running totals and exact quantiles without a single-task window.

The rows are range-partitioned into ordered chunks and staged with their chunk number. The
running value inside a chunk is an ordinary window over that chunk; what precedes the chunk
is a table with one row per chunk, small by construction, and is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowvigil.staging import Staging


def ordered_chunks(df: DataFrame, order: Sequence[Column], staging: Staging, label: str) -> DataFrame:
    """Rows with column ``chunk``; all rows of a lower chunk precede those of a higher one.

    The chunk borders are sampled, so the result has to be fixed before it is read twice.
    """
    ranged = df.repartitionByRange(*order).withColumn("chunk", F.spark_partition_id())
    return staging.table(ranged, label)


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: dict[str, str],
    staging: Staging,
    label: str = "running-totals",
) -> DataFrame:
    """Add, for each output name, the sum of a column over this row and all rows before it.

    ``order`` must not have ties; aggregate equal rows first.
    """
    chunked = ordered_chunks(df, order, staging, label)
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunked.groupBy("chunk").agg(
        *[F.sum(source).alias(f"_{name}") for name, source in totals.items()]
    )
    offsets = offsets.select(
        "chunk",
        *[F.coalesce(F.sum(f"_{name}").over(before), F.lit(0)).alias(f"_{name}") for name in totals],
    )
    inside = (
        Window.partitionBy("chunk")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # One row per chunk, and there are no more chunks than shuffle partitions.
    joined = chunked.join(F.broadcast(offsets), "chunk")
    return joined.select(
        *df.columns,
        *[
            (F.sum(source).over(inside) + F.col(f"_{name}")).alias(name)
            for name, source in totals.items()
        ],
    )


def with_row_number(
    df: DataFrame, order: Sequence[Column], staging: Staging, name: str = "row_number"
) -> DataFrame:
    """Global one-based row number under a total order."""
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running_totals(counted, order, {name: "_one"}, staging, "row-number").drop("_one")


def newest(df: DataFrame, time: Column, ties: Sequence[Column], n: int) -> DataFrame:
    """The ``n`` rows of the latest ``time`` (seconds); rows without one come last, and ``ties`` decide among equals.

    Counts per day, then per second of one day, tell the second in which the n-th row lies. All later rows are kept
    where they are; only that second is sorted, so no task holds more rows than a second has.
    """
    rows = df.withColumn("_time", time).withColumn("_second", F.floor("_time"))
    left, low, high = n, None, None
    for unit in (86_400, 1):
        inside = rows if low is None else rows.where((F.col("_second") >= low) & (F.col("_second") < high))
        counts = inside.where(F.col("_second").isNotNull()).groupBy(F.floor(F.col("_second") / unit).alias("at")).agg(F.count("*").alias("n"))
        # One row per day, or per second of a day.
        upto = Window.orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cut = counts.withColumn("upto", F.sum("n").over(upto)).where(F.col("upto") >= left).orderBy(F.desc("at")).first()
        if cut is None:
            dated = rows.where(F.col("_second").isNotNull())
            held = dated.count()
            undated = rows.where(F.col("_second").isNull()).orderBy(*ties).limit(n - held)
            return dated.unionByName(undated).drop("_time", "_second")
        left -= cut["upto"] - cut["n"]
        low, high = cut["at"] * unit, (cut["at"] + 1) * unit
    last = rows.where(F.col("_second") == low).orderBy(F.desc("_time"), *ties).limit(left)
    return rows.where(F.col("_second") > low).unionByName(last).drop("_time", "_second")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], staging: Staging
) -> DataFrame:
    """Linearly interpolated quantiles, one row per (column_name, probability).

    Equal values are counted before the shuffle; no value list is held in memory.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    counts = (
        values.where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
    )
    ranked = running_totals(
        counts, [F.col("column_name"), F.col("value")], {"upto": "n"}, staging, "value-counts"
    ).withColumn("first", F.col("upto") - F.col("n"))
    spans = ranked.groupBy("column_name").agg(
        F.min("first").alias("start"), F.sum("n").alias("size")
    )
    targets = spans.withColumn(
        "probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    ).withColumn("offset", F.col("probability") * (F.col("size") - 1))
    targets = targets.select(
        F.col("column_name"),
        "probability",
        (F.col("start") + F.floor("offset")).alias("low"),
        (F.col("start") + F.ceil("offset")).alias("high"),
        (F.col("offset") - F.floor("offset")).alias("part"),
    )

    def holds(position: str) -> Column:
        return (F.col("first") <= F.col(position)) & (F.col(position) < F.col("upto"))

    # One row per column and probability.
    found = ranked.join(F.broadcast(targets), "column_name").where(holds("low") | holds("high"))
    low = F.max(F.when(holds("low"), F.col("value")))
    high = F.max(F.when(holds("high"), F.col("value")))
    return found.groupBy("column_name", "probability").agg(
        (low + (high - low) * F.max("part")).alias("value")
    )
