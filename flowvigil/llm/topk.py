"""Exact top-k inner-product search with buckets of vectors of like length.

Vectors are bucketed by length and each bucket is packed into blocks. A query starts with a bound on
its k-th score, from one block of the longest vectors. For a block, the bound divided by the lengths of
query and longest vector is the cosine that a vector there has to reach. Above 1 the block is skipped. A
high cosine prunes by coordinates: those of the direction must lie near the query's. A low one prunes by
length alone. Products of what remains are exact integers and decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowvigil.llm.shared import shuffle_width
from flowvigil.staging import Staging

SCALE = 256
BUCKETS = 16
#: Vectors in a block, about; queries in a block, about.
BLOCK = 4096
QUERY_BLOCK = 512
#: Local cosine from which coordinates are compared, and the coordinates compared.
BY_COORDINATE = 0.6
COORDINATES = 4
#: Rounding allowance of the bounds; products are exact.
SLACK = 1e-9


def quantized(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, v (whole numbers), length and dim of every vector that is complete and finite."""
    given = F.col(vector_column).cast("array<double>")
    bad = F.exists(given, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (
        df.where(given.isNotNull() & ~bad & F.col(id_column).isNotNull())
        .select(F.col(id_column).cast("bigint").alias("vec_id"), F.transform(given, lambda x: F.floor(x * scale)).alias("v"))
        .withColumn(
            "length",
            F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))),
        )
        .withColumn("dim", F.size("v"))
    )


def narrowed(vectors: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type that holds them; blocks travel once for each block they meet."""
    low, high = vectors.min(initial=0), vectors.max(initial=0)
    return vectors.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _packed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: its ids, vectors (longest first) and largest length. Groups are blocks, so bounded."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "vec_id"], ascending=[False, True])
        vectors = np.stack([np.asarray(v, dtype=np.int64) for v in group["v"]])
        out = {k: [group[k].iloc[0]] for k in keys}
        out |= {"ids": [group["vec_id"].to_numpy(np.int64).tobytes()], "vectors": [narrowed(vectors).tobytes()]}
        return pd.DataFrame(out | {"longest": [float(group["length"].iloc[0])]})

    types = dict(rows.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", ids binary, vectors binary, longest double"
    return rows.select(*keys, "vec_id", "v", "length").groupBy(*keys).applyInPandas(pack, schema)


class Block:
    """Vectors of a packed row, as floats where all products are then exact."""

    def __init__(self, ids: bytes, vectors: bytes, dim: int):
        self.ids = np.frombuffer(ids, dtype=np.int64)
        width = len(vectors) // max(1, len(self.ids) * dim)
        self.whole = np.frombuffer(vectors, dtype=f"i{width or 8}").reshape(len(self.ids), dim).astype(np.int64)
        self.values = self.whole.astype(np.float64)
        self.lengths = np.sqrt((self.values**2).sum(axis=1))
        self.most = float(np.abs(self.values).max(initial=0))
        self._directions: np.ndarray | None = None

    @property
    def directions(self) -> np.ndarray:
        if self._directions is None:
            self._directions = self.values / np.maximum(self.lengths, 1e-300)[:, None]
        return self._directions


def best(query: np.ndarray, whole: np.ndarray, own: int, block: Block, bound: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the block's best k for a query, of those that reach ``bound``; ties to smaller ids."""
    length = float(np.sqrt((query**2).sum()))
    end = len(block.ids)
    if bound > 0:
        if length == 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        least = bound / length * (1 - SLACK)
        # Length pruning: the block is sorted by length, longest first.
        end = int(np.searchsorted(-block.lengths, -least, side="right"))
    if not end:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    held = np.arange(end)
    if bound > 0:
        local = bound / (length * block.lengths[0]) * (1 - SLACK)
        if local >= BY_COORDINATE:
            direction = query / length
            reach = min(1.0, local)
            for f in np.argsort(-np.abs(direction))[:COORDINATES]:
                middle = direction[f] * reach
                spread = np.sqrt(max(0.0, (1 - direction[f] ** 2) * (1 - reach**2))) + 1e-7
                # The bounds of a cosine of at least ``reach`` on one coordinate of a direction.
                low = middle - spread if direction[f] > -reach else -1.0
                high = middle + spread if direction[f] < reach else 1.0
                x = block.directions[held, f]
                held = held[(x >= low - 1e-7) & (x <= high + 1e-7)]
    if block.most * float(np.abs(query).max(initial=0)) * len(query) < 2**53:
        scores = (block.values[held] @ query).astype(np.int64)
    else:
        scores = block.whole[held] @ whole
    ids = block.ids[held]
    good = (ids != own) & (scores >= bound)
    ids, scores = ids[good], scores[good]
    if len(ids) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        good = scores >= least
        ids, scores = ids[good], scores[good]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def first_blocks(blocks: DataFrame, dims: list[int]) -> DataFrame:
    """The packed row of the lowest part of the bucket of the longest vectors, for each of ``dims``: a row per dimension.

    Places come first, without vectors, and only the blocks that stand there are read to the driver.
    """
    places = blocks.where(F.col("dim").isin(dims)).groupBy("dim").agg(F.min(F.struct("bucket", "part")).alias("at")).collect()
    name = F.concat_ws("/", "dim", "bucket", "part")
    return blocks.where(name.isin([f"{r.dim}/{r['at'].bucket}/{r['at'].part}" for r in places]))


def top_k(
    df: DataFrame,
    staging: Staging,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for every row that ``is_query`` (over vec_id) names.

    Candidates are all rows of the same dimension but those with the query's own vec_id. Rows with a null id,
    a null vector or null or non-finite components take no part. A repeated row is a candidate, and a
    query, of its own. With fewer candidates than k all are returned; an empty table gives an empty result.
    """
    spark = df.sparkSession
    vectors = quantized(df, id_column, vector_column, scale).withColumn("row", F.monotonically_increasing_id())
    vectors = staging.table(vectors, "vectors")
    # A fixed number of borders, longest bucket first.
    borders = vectors.agg(
        F.percentile_approx("length", [i / BUCKETS for i in range(1, BUCKETS)], 10_000)
    ).first()[0]
    inner = F.array(*map(F.lit, sorted(set(borders or [])))).cast("array<double>")
    bucket = F.size(F.filter(inner, lambda b: b > F.col("length"))).cast("int")
    bucketed = vectors.withColumn("bucket", bucket)
    # Bounded: a row per bucket and dimension.
    counts = bucketed.groupBy("dim", "bucket").agg(F.count("*").alias("n"), F.max("length").alias("longest"))
    parts = {(r.dim, r.bucket): (-(-r.n // BLOCK), r.longest) for r in counts.collect()}
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    spread = F.create_map(
        *[x for (d, b), (n, _) in parts.items() for x in (F.lit(f"{d}/{b}"), F.lit(n).cast("int"))]
    )
    name = F.concat_ws("/", F.col("dim"), F.col("bucket"))
    part = F.pmod(F.xxhash64("row"), F.try_element_at(spread, name)).cast("int")
    blocks = staging.table(_packed(bucketed.withColumn("part", part), ["dim", "bucket", "part"]), "blocks")
    asked = vectors.where(is_query)
    query_counts = {r.dim: -(-r.n // QUERY_BLOCK) for r in asked.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    if not query_counts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    lots = F.create_map(*[x for d, n in query_counts.items() for x in (F.lit(d), F.lit(n).cast("int"))])
    lot = F.pmod(F.xxhash64("row"), F.try_element_at(lots, F.col("dim"))).cast("int")
    queries = _packed(asked.withColumn("lot", lot), ["dim", "lot"])
    # One block of the longest vectors of every dimension; a block has a bounded size.
    starts = {r.dim: (bytes(r["ids"]), bytes(r["vectors"])) for r in first_blocks(blocks, list(query_counts)).collect()}

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, least = [], []
            for dim, ids, packed in zip(*(batch.column(c).to_pylist() for c in ("dim", "ids", "vectors"))):
                held, block = Block(ids, packed, dim), Block(*starts[dim], dim)
                found = [
                    best(q, w, own, block, -np.inf, k)[1]
                    for q, w, own in zip(held.values, held.whole, held.ids.tolist())
                ]
                limits = np.array([s[k - 1] if len(s) == k else -np.inf for s in found], dtype=np.float64)
                out.append(limits.tobytes())
                least.append(float(limits.min()))
            columns = [*batch.columns, pa.array(out, pa.binary()), pa.array(least, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "bounds", "least"])

    types = ", ".join(f"{c} {t}" for c, t in queries.dtypes)
    bounded = staging.table(queries.mapInArrow(bounds, f"{types}, bounds binary, least double"), "queries")
    buckets = F.array(
        *[
            F.struct(F.lit(d).alias("d"), F.lit(b).alias("bucket"), F.lit(n).alias("n"), F.lit(far).alias("far"))
            for (d, b), (n, far) in sorted(parts.items())
        ]
    )
    # A bucket whose longest vector can't lift any of the queries to its bound is left out.
    reached = F.col("least") <= F.col("longest") * F.col("of.far") * (1 + SLACK)
    pairs = bounded.select("*", F.explode(buckets).alias("of")).where((F.col("dim") == F.col("of.d")) & reached)
    pairs = pairs.select(
        "dim",
        "lot",
        F.col("ids").alias("query_ids"),
        F.col("vectors").alias("queries"),
        "bounds",
        "of.bucket",
        F.explode(F.sequence(F.lit(0), F.col("of.n") - 1)).alias("part"),
    )
    # Queries in blocks against all rows in blocks: each pair of blocks is one row. Spark's estimate of the pairs leaves
    # out that a query block is there once for each block, so neither side may go through the driver as a broadcast.
    place = ["dim", "bucket", "part"]
    met = pairs.hint("merge").repartition(shuffle_width(spark), *place).join(
        blocks.drop("longest").repartition(shuffle_width(spark), *place), place
    )

    names = ["lot", "position", "query_id", "vec_id", "score"]
    arrow = pa.schema([(n, pa.int64()) for n in names])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ("dim", "lot", "query_ids", "queries", "bounds", "ids", "vectors")
        for batch in batches:
            for dim, lot, query_ids, packed, limits, ids, vectors in zip(*(batch.column(c).to_pylist() for c in columns)):
                asked, block, out = Block(query_ids, packed, dim), Block(ids, vectors, dim), []
                for at, bound in enumerate(np.frombuffer(limits, dtype=np.float64)):
                    own = int(asked.ids[at])
                    found, scores = best(asked.values[at], asked.whole[at], own, block, bound, k)
                    out += [(lot, at, own, i, s) for i, s in zip(found.tolist(), scores.tolist())]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=arrow)

    hits = met.mapInArrow(search, ", ".join(f"{n} bigint" for n in names))
    order = Window.partitionBy("lot", "position", "query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
