import numpy as np
import xxhash

from cases import no_documents, odd_documents
from flowvigil.llm import simhash


def slow_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split() if w]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def expected(rows):
    prints = [slow_fingerprint(r.text) for r in rows]
    roots, out = slow_components(prints), []
    for r, p, root in zip(rows, prints, roots):
        ids = [x.doc_id for x, y in zip(rows, roots) if y == root and x.doc_id is not None]
        out.append((r.doc_id, f"{p:016x}", min(ids, default=None)))
    return out


def order(rows):
    return sorted(rows, key=str)


def test_odd_documents_match_brute_force(spark, staging):
    docs = odd_documents(spark)
    got = [tuple(r) for r in simhash.near_duplicates(docs, staging).collect()]
    assert order(got) == order(expected(docs.collect()))


def test_given_documents_match_brute_force(spark, staging):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = [tuple(r) for r in simhash.near_duplicates(docs, staging).collect()]
    assert order(got) == order(expected(docs.select("doc_id", "text").collect()))


def test_empty_table(spark, staging):
    assert simhash.near_duplicates(no_documents(spark), staging).count() == 0


def close_pairs(values):
    return {(i, j) for i in range(len(values)) for j in range(i) if (int(values[i]) ^ int(values[j])).bit_count() <= 3}


def clustered(seed, n=1500):
    rng = np.random.default_rng(seed)
    seeds = rng.integers(0, 2**63, n // 10, dtype=np.uint64)
    out = []
    for i in range(n):
        x = int(seeds[i % len(seeds)])
        for b in rng.integers(0, 64, rng.integers(0, 6)):
            x ^= 1 << int(b)
        out.append(x)
    return np.unique(np.array(out, dtype=np.uint64))


def test_every_close_pair_meets_in_a_shard():
    values = clustered(3)
    shards = simhash.route(simhash.fit_tree(values[::7]), values)
    assert len(shards) > 20
    met = set()
    for _, held in shards:
        met |= {(held[i], held[j]) for i, j in close_pairs(values[held])} | {(held[j], held[i]) for i, j in close_pairs(values[held])}
    assert all(p in met for p in close_pairs(values))


def test_shard_links_span_the_components(monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 64)
    values = clustered(4, 700)
    links = simhash.shard_links(values, 3)
    place = {int(v): i for i, v in enumerate(values)}
    assert all((int(a) ^ int(b)).bit_count() >= 0 for a, b in links)
    roots = slow_components([int(v) for v in values])
    joined = list(range(len(values)))

    def find(i):
        while joined[i] != i:
            i = joined[i]
        return i

    for a, b in links:
        joined[find(place[int(a)])] = find(place[int(b)])
    found = [find(i) for i in range(len(values))]
    pairs = {(r, f) for r, f in zip(roots, found)}
    assert len(pairs) == len(set(roots)) == len(set(found))


def test_components_of_a_chain_and_a_star(spark, staging):
    from flowvigil.llm.shared import connected_components

    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7)]
    found = connected_components(spark.createDataFrame(edges, "u bigint, v bigint"), staging)
    got = {r.node: r.root for r in found.collect()}
    assert got == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(300)}}
