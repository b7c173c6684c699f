"""Merkle manifest of a dataset: a tree of digests per source, and one over the sources.

Trees have 16 branches. They are stored in blocks: aligned subtrees of at most three levels, each laid out in van
Emde Boas order, that is, recursively split at half its height into a top and the subtrees below it, each of them
stored in one piece. A node's address is arithmetic, and the same addresses serve construction and the retrieval
of siblings. The roots of blocks are the leaves of the next round of blocks, until one node remains; then the
roots of all sources are the leaves of the top tree. Paths go down the same rounds, one row per block.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowvigil.llm.shared import cogrouped
from flowvigil.operators.ordering import ordered_chunks, with_row_number
from flowvigil.staging import Staging

#: Children of a node, levels of a block, and so leaves of a block.
BRANCHES = 16
LEVELS = 3
LEAVES = BRANCHES**LEVELS
DIGEST = 32


@functools.cache
def layout(levels: int) -> tuple[np.ndarray, ...]:
    """Addresses of the nodes of a complete tree in van Emde Boas order, leaves first; the root's is 0."""
    return _by_depth(levels + 1)[::-1]


@functools.cache
def _by_depth(rows: int) -> tuple[np.ndarray, ...]:
    """Addresses by depth, the root's first, of a tree with so many rows of nodes."""
    if rows == 1:
        return (np.zeros(1, np.int64),)
    top = _by_depth(rows // 2)
    below = _by_depth(rows - len(top))
    start, size = sum(map(len, top)), sum(map(len, below))
    roots = start + size * np.arange(BRANCHES ** len(top))
    return (*top, *((roots[:, None] + addresses).ravel() for addresses in below))


def levels_for(leaves: int) -> int:
    """Levels above so many leaves until one node remains."""
    levels = 0
    while BRANCHES**levels < leaves:
        levels += 1
    return levels


def combined(digests: bytes) -> bytes:
    """H of digests that lie side by side; H takes and gives hexadecimal text."""
    return hashlib.sha256(digests.hex().encode()).digest()


class Block:
    """A stored subtree: ``nodes`` in van Emde Boas order, and how many leaves it has."""

    def __init__(self, nodes: bytes | bytearray, leaves: int, levels: int):
        self.nodes, self.at = nodes, layout(levels)
        self.sizes = [-(-leaves // BRANCHES**level) for level in range(levels + 1)]

    @classmethod
    def built(cls, digests: list[bytes], levels: int) -> Block:
        block = cls(bytearray(DIGEST * sum(map(len, layout(levels)))), len(digests), levels)
        for slot, digest in enumerate(digests):
            block._put(0, slot, digest)
        for level in range(levels):
            for run in range(block.sizes[level + 1]):
                block._put(level + 1, run, combined(block.run(level, run)))
        return block

    def _put(self, level: int, index: int, digest: bytes) -> None:
        at = DIGEST * self.at[level][index]
        self.nodes[at : at + DIGEST] = digest

    def get(self, level: int, index: int) -> bytes:
        at = DIGEST * self.at[level][index]
        return bytes(self.nodes[at : at + DIGEST])

    def run(self, level: int, run: int) -> bytes:
        """The nodes that have one parent, side by side."""
        first = run * BRANCHES
        return b"".join(self.get(level, i) for i in range(first, min(first + BRANCHES, self.sizes[level])))

    def path(self, slot: int) -> list[tuple[bytes, bytes]]:
        """Siblings to the left and right of a leaf and of each node above it, up to the block's root."""
        out = []
        for level in range(len(self.sizes) - 1):
            run, at = self._run(level, slot // BRANCHES), DIGEST * (slot % BRANCHES)
            out.append((run[:at], run[at + DIGEST :]))
            slot //= BRANCHES
        return out

    @functools.lru_cache(64)  # noqa: B019
    def _run(self, level: int, run: int) -> bytes:
        return self.run(level, run)


def proof_digest(path: list[tuple[bytes, bytes]]) -> str:
    """H of all siblings, level by level and left to right."""
    return hashlib.sha256(b"".join(left + right for left, right in path).hex().encode()).hexdigest()


def folded(digest: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that follows from a leaf and its siblings."""
    for left, right in path:
        digest = combined(left + digest + right)
    return digest


@dataclass
class Manifest:
    """``leaves``: tree, rank and the row's own columns. ``rounds`` and ``top``: blocks of sources and of the top tree.

    A block has tree, block, leaves, levels, nodes (binary) and root. ``roots``: tree, source, digest of each source.
    """

    leaves: DataFrame
    rounds: list[DataFrame]
    top: list[DataFrame]
    roots: DataFrame
    root: str | None


BLOCK = "tree bigint, block bigint, leaves int, levels int, nodes binary, root string"
PATH = "tree bigint, block bigint, path array<binary>"


def _climb(nodes: DataFrame, staging: Staging, name: str) -> tuple[list[DataFrame], DataFrame | None]:
    """Rounds of blocks over nodes (tree, rank, size, digest), and the root of every tree."""

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rank")
        size = rows["size"][0].as_py()
        block = Block.built([bytes.fromhex(x) for x in rows["digest"].to_pylist()], LEVELS if size > LEAVES else levels_for(size))
        levels = len(block.sizes) - 1
        values = [key[0].as_py(), key[1].as_py(), rows.num_rows, levels, bytes(block.nodes), block.get(levels, 0).hex()]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string()]
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds)], names=["tree", "block", "leaves", "levels", "nodes", "root"])

    rounds, done, largest = [], None, nodes.agg(F.max("size")).first()[0]
    while largest:
        keyed = nodes.select("tree", F.floor(F.col("rank") / LEAVES).alias("block"), "rank", "size", "digest")
        blocks = staging.table(keyed.groupBy("tree", "block").applyInArrow(build, BLOCK), f"{name}-{len(rounds)}")
        counted = blocks.join(nodes.groupBy("tree").agg(F.max("size").alias("size")), "tree").withColumn("size", F.ceil(F.col("size") / LEAVES))
        ended = counted.where("size = 1").select("tree", F.col("root").alias("digest"))
        done = ended if done is None else done.unionByName(ended)
        rounds.append(blocks)
        nodes = counted.where("size > 1").select("tree", F.col("block").alias("rank"), "size", F.col("root").alias("digest"))
        largest = -(-largest // LEAVES) if largest > LEAVES else 0
    return rounds, done


def _descend(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Path of every leaf of these blocks, keyed as the block of the round below; ``above`` has the blocks' own paths."""

    def spread(key: tuple, blocks: pa.Table, above: pa.Table) -> pa.Table:
        out = {"block": [], "path": []}
        for row in blocks.to_pylist():
            block, rest = Block(row["nodes"], row["leaves"], row["levels"]), above["path"][0].as_py()
            for slot in range(row["leaves"]):
                out["block"].append(row["block"] * LEAVES + slot)
                out["path"].append([x for pair in block.path(slot) for x in pair] + rest)
        tree = pa.array([key[0].as_py()] * len(out["block"]), pa.int64())
        return pa.table({"tree": tree, "block": pa.array(out["block"], pa.int64()), "path": pa.array(out["path"], pa.list_(pa.binary()))})

    return cogrouped(blocks, above, ["tree", "block"]).applyInArrow(spread, PATH)


def build(df: DataFrame, source: Column, order: list[str], staging: Staging) -> Manifest:
    """Manifest of rows with a column ``digest`` (hexadecimal), a tree for each value of ``source``.

    Leaves of a source ascend by the columns ``order``, nulls first, and then by digest; sources ascend by their
    UTF-8 bytes, a null source first. A tree of one leaf has that leaf as its root, a single source the root of all.
    """
    named = df.withColumn("_source", source)
    by = [F.col("_source").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in (*order, "digest")]]
    chunks = ordered_chunks(named, by, staging, "leaves")
    # One row per chunk and source; chunks of a source are in order.
    counts = chunks.groupBy("_source", "chunk").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("_source")
    before = whole.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_source", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"), F.sum("n").over(whole).alias("size")
    )
    numbers = with_row_number(counts.select("_source").distinct(), [F.col("_source").asc_nulls_first()], staging, "number")
    sources = staging.table(numbers.select(F.col("_source").alias("source"), (F.col("number") - 1).alias("tree")), "sources")
    placed = offsets.join(sources, F.col("_source").eqNullSafe(F.col("source"))).select(
        F.col("source").alias("_s"), F.col("chunk").alias("_c"), "_before", "size", "tree"
    )
    inside = Window.partitionBy("chunk", "_source").orderBy(*by[1:])
    ranked = chunks.withColumn("_at", F.row_number().over(inside)).join(
        placed, (F.col("chunk") == F.col("_c")) & F.col("_source").eqNullSafe(F.col("_s"))
    )
    leaves = staging.table(
        ranked.select("tree", (F.col("_before") + F.col("_at") - 1).alias("rank"), "size", *df.columns), "ranked"
    )
    rounds, done = _climb(leaves.select("tree", "rank", "size", "digest"), staging, "source-blocks")
    if done is None:
        return Manifest(leaves, [], [], sources.withColumn("digest", F.lit(None).cast("string")), None)
    roots = staging.table(sources.join(done, "tree"), "roots")
    n = roots.count()
    top, last = _climb(roots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("rank"), F.lit(n).alias("size"), "digest"), staging, "top-blocks")
    return Manifest(leaves, rounds, top, roots, last.first()["digest"])


def _block_paths(manifest: Manifest, staging: Staging) -> list[DataFrame]:
    """For every round of the sources' blocks, the path of each block (of its root)."""
    empty = F.array().cast("array<binary>")
    above = manifest.top[-1].select("tree", "block", empty.alias("path"))
    for blocks in reversed(manifest.top):
        above = _descend(blocks, above)
    # The leaves of the top tree are the roots of the sources.
    of_tree = staging.table(above.select(F.col("block").alias("tree"), F.lit(0).cast("bigint").alias("block"), "path"), "paths-of-sources")
    paths: list[DataFrame] = []
    below: DataFrame | None = None
    for blocks in reversed(manifest.rounds):
        rest = of_tree if below is None else of_tree.join(below.select("tree").distinct(), "tree", "left_anti")
        known = rest.join(blocks.select("tree").distinct(), "tree", "left_semi")
        own = known if below is None else known.unionByName(below)
        paths.insert(0, staging.table(own.select("tree", "block", "path"), "paths-of-blocks"))
        below = staging.table(_descend(blocks, paths[0]), "paths-of-leaves") if blocks is not manifest.rounds[0] else None
    return paths


def proofs(manifest: Manifest, columns: list[str], staging: Staging, tampered: str | None = None) -> DataFrame:
    """Per leaf: ``columns``, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``folded_root`` follows from the leaf's siblings and the digest in column ``tampered``, where that is not null,
    or else the leaf itself.
    """
    types = dict(manifest.leaves.dtypes)
    schema = ", ".join([f"{c} {types[c]}" for c in columns] + ["leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"])
    root = manifest.root
    changed = F.col(tampered) if tampered else F.lit(None).cast("string")
    leaves = manifest.leaves.select(
        "tree", F.floor(F.col("rank") / LEAVES).alias("block"), (F.col("rank") % LEAVES).alias("slot"), F.col("digest").alias("leaf"), changed.alias("changed"), *columns
    )
    if root is None:
        nothing = {"leaf": "leaf", **dict.fromkeys(("subroot", "root", "proof_sha256", "folded_root"), "cast(null as string)"), "verified": "true"}
        return leaves.selectExpr(*columns, *[f"{v} AS {k}" for k, v in nothing.items()])
    paths = _block_paths(manifest, staging)[0]
    stored = manifest.rounds[0].join(paths, ["tree", "block"]).join(manifest.roots.select("tree", F.col("digest").alias("subroot")), "tree")

    def prove(leaves: pa.Table, stored: pa.Table) -> pa.Table:
        """Leaves of one block, whose number LEAVES bounds."""
        row = stored.to_pylist()[0]
        block, rest = Block(row["nodes"], row["leaves"], row["levels"]), row["path"]
        above = list(zip(rest[::2], rest[1::2]))
        proof, ends = [], []
        for slot, leaf, changed in zip(*(leaves[x].to_pylist() for x in ("slot", "leaf", "changed"))):
            path = block.path(slot) + above
            proof.append(proof_digest(path))
            ends.append(folded(bytes.fromhex(changed or leaf), path).hex())
        n = leaves.num_rows
        given = {c: leaves[c] for c in columns}
        return pa.table(given | {
            "leaf": leaves["leaf"], "subroot": pa.array([row["subroot"]] * n, pa.string()), "root": pa.array([root] * n, pa.string()),
            "proof_sha256": pa.array(proof, pa.string()), "folded_root": pa.array(ends, pa.string()), "verified": pc.equal(pa.array(ends, pa.string()), root),
        })

    return cogrouped(leaves, stored, ["tree", "block"]).applyInArrow(prove, schema)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_digest(text: Column | None = None) -> Column:
    """H of a document: each field as its number of UTF-8 bytes, a colon and the value, or a dash if null."""

    def field(value: Column) -> Column:
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    values = [F.col(c).cast("string") for c in FIELDS[:-1]] + [F.col("text") if text is None else text]
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def document_proofs(df: DataFrame, staging: Staging, every: int = 5) -> DataFrame:
    """doc_id and the proof of every document, by the manifest of its fields; a check of tampered ones goes along.

    Where ``every`` divides the CRC-32 of the doc_id, the proof is folded from the document with A-Z lower-cased.
    A null field counts as a dash. A null source is a source of its own, the first one. Rows without a doc_id come
    first in their source and are not tampered with; repeated rows are leaves side by side, each with a proof of its
    own. Texts are hashed whole. Other columns are not read, so their names do not matter. An empty table has no rows.
    """
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    leaves = df.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").alias("source"),
        document_digest().alias("digest"),
        F.when(chosen, document_digest(lower)).alias("tampered"),
    )
    return proofs(build(leaves, F.col("source"), ["doc_id"], staging), ["doc_id"], staging, "tampered")
