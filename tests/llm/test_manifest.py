import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from cases import no_documents, odd_documents
from flowvigil.llm import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def fields(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        out.append(nodes)
    return out


def siblings(tree, at):
    for nodes in tree[:-1]:
        first = at // 16 * 16
        yield nodes[first:at], nodes[at + 1 : first + 16]
        at //= 16


def brute(rows):
    leaves = [(r, fields(r, r.text)) for r in rows]
    sources = sorted({r.source for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    order = {s: sorted([x for x in leaves if x[0].source == s], key=lambda x: (x[0].doc_id is not None, x[0].doc_id or 0, x[1])) for s in sources}
    trees = {s: levels([d for _, d in order[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for at, s in enumerate(sources):
        for rank, (row, leaf) in enumerate(order[s]):
            path = [*siblings(trees[s], rank), *siblings(top, at)]
            chosen = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0
            root = fields(row, lowered(row.text)) if chosen else leaf
            for left, right in path:
                root = h(*left, root, *right)
            proof = h(*(x for left, right in path for x in (*left, *right)))
            out.append((row.doc_id, leaf, trees[s][-1][0], top[-1][0], proof, root, root == top[-1][0]))
    return out


def by_text(rows):
    return sorted(map(tuple, rows), key=repr)


def test_layout_is_a_permutation_that_keeps_subtrees_together():
    for height in range(5):
        at = manifest.layout(height)
        assert sorted(x for level in at for x in level) == list(range(sum(16**i for i in range(height + 1))))
        assert at[-1][0] == 0
    # Three levels of edges: a top of two rows of nodes, then 256 subtrees of 17 nodes each.
    leaves, above = manifest.layout(3)[0], manifest.layout(3)[1]
    assert all(set(leaves[16 * i : 16 * i + 16]) == set(range(above[i] + 1, above[i] + 17)) for i in range(256))


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 300])
def test_block_against_plain_levels(n):
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    block = manifest.Block.built(digests, manifest.levels_for(n))
    tree = levels([d.hex() for d in digests])
    assert block.get(len(tree) - 1, 0).hex() == tree[-1][0]
    for slot in {0, n // 2, n - 1}:
        wanted = [("".join(a), "".join(b)) for a, b in siblings(tree, slot)]
        assert [(a.hex(), b.hex()) for a, b in block.path(slot)] == wanted
        assert manifest.folded(digests[slot], block.path(slot)).hex() == tree[-1][0]


def test_odd_documents(spark, staging):
    docs = odd_documents(spark).withColumns({c: F.lit(1) for c in ("tree", "rank", "digest", "chunk", "_source", "leaf", "tampered")})
    got = manifest.document_proofs(docs, staging).collect()
    assert by_text(got) == by_text(brute(docs.collect()))
    assert not all(r.verified for r in got) or all(lowered(r.text) == r.text for r in docs.collect())


def test_several_rounds_of_blocks(spark, staging):
    """A source of two blocks and many sources, so both trees have a second round of runs."""
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") < 700, F.concat(F.lit("é"), F.col("id"))).alias("source"),
        F.lit("en").alias("lang"), F.col("id").alias("n_chars"), F.concat(F.lit("Text "), F.col("id")).alias("text"),
    )
    got = manifest.document_proofs(docs, staging).collect()
    assert by_text(got) == by_text(brute(docs.collect()))
    chosen = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert chosen and not any(r.verified for r in chosen) and sum(r.verified for r in got) == len(got) - len(chosen)


def test_one_document_and_none(spark, staging):
    one = odd_documents(spark).where("doc_id = 3")
    row = manifest.document_proofs(one, staging).first()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == h("")
    assert manifest.document_proofs(no_documents(spark), staging).count() == 0
