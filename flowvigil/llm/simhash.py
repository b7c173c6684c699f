"""Near-duplicate documents by SimHash fingerprints and vantage-point trees.

A vantage-point tree over Hamming distance deals the distinct fingerprints to shards. A node
with point ``p`` and bound ``m`` sends what lies within ``m + radius`` of ``p`` to one side and
what lies beyond ``m`` to the other. By the triangle inequality two fingerprints within
``radius`` of each other always meet on a side, so only the ring between ``m`` and
``m + radius`` is held twice and the pairs found are exact. The top of the tree is fitted on a
bounded sample; every shard goes on splitting inside its own task.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from flowvigil.llm.shared import connected_components, id_and_bytes, map_batches
from flowvigil.staging import Staging

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Fingerprints that the top of the tree is fitted on, and its levels.
SAMPLE = 4096
LEVELS = 8
#: Fingerprints compared directly, all with all.
LEAF = 512
#: Fingerprint bits are counted for so many shingles at a time.
BLOCK = 1 << 16


def fingerprint(text: bytes) -> int:
    """64-bit SimHash of the text's word shingles, repeats included; 0 without words."""
    words = text.lower().split()  # of bytes: only A-Z and only \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        starts = list(accumulate((len(w) + 1 for w in words), initial=0))
        ends = starts[SHINGLE:]
        hashes = [xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, ends)]
    values = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), BLOCK):
        octets = values[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(values)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id and its fingerprint as the bigint with the same 64 bits.

    A null or empty text has fingerprint 0.
    """
    arrow = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batch: pa.RecordBatch) -> dict:
        prints = np.array([fingerprint(x) for x in batch.column("text").to_pylist()], dtype=np.uint64)
        return {"doc_id": batch.column("doc_id"), "fp": prints.view(np.int64)}

    return map_batches(id_and_bytes(df, id_column, text_column), run, "doc_id bigint, fp bigint", arrow)


def distance(values: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ point)


def split_point(values: np.ndarray, radius: int) -> tuple[np.uint64, int, int] | None:
    """Vantage point and bound with the smallest larger side, and that side's size.

    None if no split makes both sides smaller than the whole.
    """
    best = None
    for point in values[:: max(1, len(values) // 5)][:5]:
        counts = np.cumsum(np.bincount(distance(values, point), minlength=65 + radius))
        for bound in range(64):
            near, far = counts[bound + radius], len(values) - counts[bound]
            if far and (best is None or max(near, far) < best[2]):
                best = (point, bound, int(max(near, far)))
    return best if best and best[2] < len(values) else None


def fit_tree(sample: np.ndarray, radius: int = RADIUS, levels: int = LEVELS) -> tuple | None:
    """Nested (point, bound, near, far); None where the sample ends or can't be split."""
    found = split_point(sample, radius) if levels and len(sample) > 1 else None
    if found is None:
        return None
    point, bound, _ = found
    away = distance(sample, point)
    return (
        point,
        bound,
        fit_tree(sample[away <= bound + radius], radius, levels - 1),
        fit_tree(sample[away > bound], radius, levels - 1),
    )


def route(tree: tuple | None, values: np.ndarray, radius: int = RADIUS) -> list[tuple[str, np.ndarray]]:
    """(shard, positions in ``values``) for every shard that gets some."""
    shards, todo = [], [("", tree, np.arange(len(values)))]
    while todo:
        name, node, held = todo.pop()
        if node is None:
            shards.append((name, held))
            continue
        point, bound, near, far = node
        away = distance(values[held], point)
        todo.append((name + "n", near, held[away <= bound + radius]))
        todo.append((name + "f", far, held[away > bound]))
    return [(name, held) for name, held in shards if len(held)]


def star_links(values: np.ndarray, radius: int) -> np.ndarray:
    """(position, smallest position of its component) among values compared all with all, in blocks."""
    n = len(values)
    labels = np.arange(n)
    while True:
        before = labels.copy()
        for a in range(0, n, LEAF):
            rows = values[a : a + LEAF, None]
            for b in range(0, n, LEAF):
                close = np.bitwise_count(rows ^ values[None, b : b + LEAF]) <= radius
                if close.sum() > (min(n, a + LEAF) - a if a == b else 0):
                    lowest = np.where(close, labels[None, b : b + LEAF], n).min(axis=1)
                    labels[a : a + LEAF] = np.minimum(labels[a : a + LEAF], lowest)
        labels = labels[labels]
        if (labels == before).all():
            break
    linked = np.flatnonzero(labels != np.arange(n))
    return np.stack([linked, labels[linked]], axis=1)


def shard_links(values: np.ndarray, radius: int) -> np.ndarray:
    """Links that connect the fingerprints of a shard just as all pairs within ``radius`` do."""
    found, todo = [], [np.sort(values)]
    while todo:
        held = todo.pop()
        split = split_point(held, radius) if len(held) > LEAF else None
        # Sides of nearly the whole size are a dense cluster, which no bound takes apart.
        if split is None or split[2] > 0.95 * len(held):
            links = star_links(held, radius)
            if len(links):
                found.append(held[links])
            continue
        away = distance(held, split[0])
        todo.append(held[away <= split[1] + radius])
        todo.append(held[away > split[1]])
    return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.uint64)


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``u``, ``v`` between distinct fingerprints (column ``fp``) that span every component."""
    rows = prints.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    tree = fit_tree(np.array(sorted(r.fp for r in rows), dtype=np.int64).view(np.uint64), radius)
    arrow = pa.schema([("shard", pa.string()), ("fp", pa.int64())])

    def deal(batch: pa.RecordBatch) -> dict:
        values = batch.column("fp").to_numpy()
        dealt = route(tree, values.view(np.uint64), radius)
        return {
            "shard": [name for name, held in dealt for _ in range(len(held))],
            "fp": np.concatenate([values[held] for _, held in dealt]),
        }

    def join(group: pd.DataFrame) -> pd.DataFrame:
        pairs = shard_links(group["fp"].to_numpy().astype(np.int64).view(np.uint64), radius).view(np.int64)
        return pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})

    dealt = map_batches(prints.select("fp"), deal, "shard string, fp bigint", arrow)
    return dealt.groupBy("shard").applyInPandas(join, "u bigint, v bigint")


def near_duplicates(
    df: DataFrame, staging: Staging, radius: int = RADIUS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row.

    Fingerprints that differ in at most ``radius`` bits link; the component is named by its
    smallest doc_id. Equal texts share a fingerprint and are one node, however many there are.
    Null and empty texts have fingerprint zero. A row with a null doc_id gets the component's
    smallest doc_id that is not null. An empty table gives an empty result.
    """
    docs = staging.table(fingerprints(df, id_column, text_column), "fingerprints")
    prints = docs.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    prints = staging.table(prints, "distinct-fingerprints")
    found = connected_components(links(prints, radius), staging)
    rooted = prints.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    # A component has at most as many fingerprints as it has different texts; min combines before the shuffle.
    heads = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(heads, "root").select("fp", "component_id")
    return docs.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
