"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowvigil.staging import Staging


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of an Arrow batch; texts may be long, and Spark's default of 10,000 fills a worker's memory.
BATCH_ROWS = 500


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session set to hand texts to Python in batches of a few MB."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df


def id_and_bytes(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns ``doc_id`` and ``text``, the text as UTF-8 bytes and empty where it is null."""
    return small_batches(df).select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], dict[str, object]], schema: str, arrow: pa.Schema
) -> DataFrame:
    """Apply ``function`` to every Arrow batch; it returns one list or array per output column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = function(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[field.name], field.type, from_pandas=True) for field in arrow], schema=arrow
                )

    return small_batches(df).mapInArrow(run, schema)


def lots(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows in tables of about ``size`` bytes of ``text``; a longer text is a lot of its own."""
    held, filled = [], 0
    for batch in batches:
        lengths, start = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), 0
        for at in range(batch.num_rows):
            if filled and filled + lengths[at] > size:
                yield pa.Table.from_batches([*held, batch.slice(start, at - start)])
                held, filled, start = [], 0, at
            filled += int(lengths[at])
        held.append(batch.slice(start))
    if sum(x.num_rows for x in held):
        yield pa.Table.from_batches(held)


def text_bytes(texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes side by side, and where each text starts and the last one ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets.astype(np.int64) - offsets[0]


ASCII_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Bytes with A-Z lower-cased.
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 0x20


def split_words(texts: pa.BinaryArray, apart: np.ndarray = ASCII_SPACE, cuts: np.ndarray | None = None) -> tuple[pa.BinaryArray, np.ndarray]:
    """Words of all texts in order, A-Z lower-cased, and how many each text has.

    ``apart`` marks the bytes that stand between words; ``cuts`` the pairs of bytes between which a word ends too.
    """
    data, bounds = text_bytes(texts)
    inside = ~apart[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = bounds[:-1][np.diff(bounds) > 0]
    begins[first] = inside[first]
    if cuts is not None:
        begins[1:] |= cuts[data[:-1], data[1:]]
    at = np.flatnonzero(begins)
    # Without the bytes between them, each word ends where the next one starts.
    kept = np.concatenate([[0], np.cumsum(inside)])
    ends = np.append(kept[at], kept[-1]).astype(np.int32)
    own = LOWERED[data[inside]]
    words = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(own.tobytes())])
    return words, np.diff(np.searchsorted(at, bounds))


def int_lists(parts: list[bytes]) -> pa.ListArray:
    """Lists of 32-bit numbers from their bytes."""
    sizes = np.array([len(x) // 4 for x in parts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def cogrouped(left: DataFrame, right: DataFrame, keys: list[str]):
    """Cogroups of two tables that may come from the same one; columns get identities of their own."""
    return left.toDF(*left.columns).groupBy(*keys).cogroup(right.toDF(*right.columns).groupBy(*keys))


_REMEMBERING: dict[str, Callable[[], object]] = {}


def remembering(owner: str, forget: Callable[[], object]) -> None:
    """Tell that this Python worker now remembers words for ``owner``, and how to drop them.

    Workers outlive tasks. What another operator has left in one is dropped, so a pipeline of
    several operators needs no more memory than the largest of them.
    """
    if owner not in _REMEMBERING:
        for drop in _REMEMBERING.values():
            drop()
        _REMEMBERING.clear()
        _REMEMBERING[owner] = forget


def connected_components(edges: DataFrame, staging: Staging) -> DataFrame:
    """Smallest reachable node of every node: columns ``node`` and ``root``.

    ``edges`` has bigint columns ``u`` and ``v``. Rounds of large-star and small-star hooking
    shrink the graph to stars in a logarithmic number of rounds; a round's edges are a staged
    table, so lineage stays short and a lost executor costs no more than one round. A node with
    very many edges is only ever read through a minimum (combined before the shuffle) and a
    sort-merge join, whose large partitions adaptive execution splits.
    """

    def hook(pairs: DataFrame, smaller_only: bool) -> DataFrame:
        lowest = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        joined = pairs.join(lowest, "u")
        if smaller_only:
            linked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                lowest.select("u", F.col("m").alias("v"))
            )
        else:
            linked = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return linked.where(F.col("u") != F.col("v")).distinct()

    down = edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    current = staging.table(down.distinct(), "edges")
    before = None
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = staging.table(hook(both, False), "large-star")
        current = staging.table(hook(large, True), "small-star")
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
