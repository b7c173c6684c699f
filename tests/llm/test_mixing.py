from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import no_documents, odd_documents
from compare import differences, duckdb_over
from flowvigil.llm import mixing, queries

FOLDER = "/root/testdata/sf0.001"


def test_matches_sql(spark):
    got = queries.op7_source_mixing(spark, FOLDER).toPandas()
    assert differences(got, duckdb_over(FOLDER).execute(queries.ORACLE["op7_source_mixing"]).df()) == ""


def water_line(sizes, weights, total, most):
    """Targets by sharing again and again what full sources leave over."""
    open_, target, left = set(sizes), dict.fromkeys(sizes, 0.0), total
    while open_ and left > 1e-9:
        unit = left / sum(weights[s] for s in open_)
        left = 0.0
        for s in list(open_):
            target[s] += unit * weights[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def test_odd_documents(spark, staging):
    docs = odd_documents(spark)
    got = mixing.mix(docs, staging, block=16).collect()
    words = lambda t: len((t or "").encode().split())
    assert sorted(map(str, ((r.doc_id, r.source, r.size) for r in got))) == sorted(
        map(str, ((r.doc_id, r.source, words(r.text)) for r in docs.collect()))
    )
    sizes = Counter()
    for r in got:
        sizes[r.source] += r.size
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weights = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    wanted = water_line(sizes, weights, 1.5 * sum(sizes.values()), 2)
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])
    assert all(abs(taken[s] - wanted[s]) <= 1 for s in sizes)


def test_every_slot_is_placed_once(spark, staging):
    placed, slots, wanted = mixing.mixture(odd_documents(spark), staging, block=16)
    drawn = {r["rank"]: r.n for r in slots.groupBy("rank").count().withColumnRenamed("count", "n").collect()}
    quota = {r["rank"]: r.slots for r in mixing.quotas(wanted, 16).collect()}
    assert drawn == {k: v for k, v in quota.items() if v}
    repeated = slots.groupBy("rank", "turn", "block").count().where("count > 1").count()
    assert repeated == 0


def slow_scrambled(x):
    x %= mixing.RANGE
    for n in mixing.SHIFTS:
        x = (x ^ x >> n) * mixing.FACTOR % mixing.RANGE
    return x


def slow_permuted(index, key, size):
    width = int(np.ceil(np.sqrt(size)))
    height = -(-size // width)
    while True:
        left, right = index % width, index // width
        for n in range(mixing.ROUNDS):
            if n % 2 == 0:
                left = (left + slow_scrambled(key + n * mixing.ROUND_KEY + right)) % width
            else:
                right = (right + slow_scrambled(key + n * mixing.ROUND_KEY + left)) % height
        index = right * width + left
        if index < size:
            return index


def test_permutation_is_keyed_and_visits_every_block(spark):
    for n in (1, 2, 3, 7, 30, 1000):
        seen = []
        for key in (5, 6, 7):
            rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(key), F.lit(n).cast("bigint")).alias("b"))
            seen.append([r.b for r in rows.collect()])
            assert sorted(seen[-1]) == list(range(n))
            assert seen[-1] == [slow_permuted(i, key, n) for i in range(n)]
        # No stride: neighbours are not a fixed step apart, and keys differ.
        if n >= 30:
            assert seen[0] != seen[1] != seen[2]
            assert all(len({(b - a) % n for a, b in zip(x, x[1:])}) > n // 4 for x in seen)


def test_shards_draw_multinomial_counts_and_targets_hold(spark, staging):
    """A slow version of the draw: every slot of a shard by its number, then surplus places in order of shards."""
    given = [(0, 700), (1, 90), (2, 0), (3, 2210)]
    starts = [0, 700, 790, 790]
    quota = staging.table(spark.createDataFrame([(r, n, s) for (r, n), s in zip(given, starts)], "rank bigint, slots bigint, first_slot bigint"), "quota")
    for seed in (42, 43):
        counts = {(r.shard, r["rank"]): r.n for r in mixing.counts_of_shards(quota, staging, 128, seed).collect()}
        drawn = Counter()
        for i in range(3000):
            high = slow_scrambled(slow_scrambled(seed) + i)
            place = (high * mixing.RANGE + slow_scrambled(high + i)) % 3000
            drawn[i // 128, max(r for (r, n), s in zip(given, starts) if n and s <= place)] += 1
        wanted, free, lacks = Counter(), [], []
        for rank, slots in given:
            for shard in range(24):
                kept = min(drawn[shard, rank], slots)
                slots -= kept
                wanted[shard, rank] += kept
                free += [shard] * (drawn[shard, rank] - kept)
            lacks += [rank] * slots
        assert free  # else nothing is corrected
        wanted.update(zip(sorted(free), lacks))
        assert counts == {k: n for k, n in wanted.items() if n}
        for rank, slots in given:
            assert sum(n for (_, r), n in counts.items() if r == rank) == slots
        # As multinomial counts do, they spread about their mean.
        spread = np.std([counts.get((shard, 0), 0) for shard in range(23)])
        assert 3 < spread < 8


def test_another_seed_gives_another_mix(spark, staging):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    taken = lambda seed: {(r.doc_id, r.taken, r.n_shards) for r in mixing.mix(docs, staging, seed=seed, shard_slots=64).collect()}
    first = taken(1)
    assert first == taken(1) and len(first - taken(2)) > 20


def test_columns_named_like_the_stages_own(spark, staging):
    names = ["turn", "_spans", "_row", "_words", "_size", "spans", "row", "words", "size", "given", "made", "taken", "rank", "shard", "block", "id", "start"]
    docs = odd_documents(spark).drop("start", "size").withColumns({c: F.concat(F.lit(c), F.coalesce("doc_id", F.lit(0))) for c in names})
    values = {r.doc_id or 0: [r[c] for c in names] for r in docs.collect()}
    from flowvigil.llm import stages

    for stage in (stages.near_duplicates, stages.repeated_passages, stages.source_mix):
        made = stage(spark, docs, FOLDER)
        assert made.columns == docs.columns
        rows = made.collect()
        assert rows and all([r[c] for c in names] == values[r.doc_id or 0] for r in rows)


def test_mixed_documents_hold_the_words_taken(spark, staging):
    docs = odd_documents(spark)
    made = mixing.mixed_documents(docs, staging, block=16)
    assert made.columns == docs.columns
    total = sum(len(r.text.encode().split()) for r in made.collect())
    asked = sum(r.taken for r in mixing.mix(docs.withColumnRenamed("doc_id", "id"), staging, block=16, id_column="id").collect())
    assert total == asked
    texts: dict = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append((r.text or "").split())
    for r in made.collect():
        # In order, and nothing that isn't in a document of that id.
        assert any(in_order(r.text.split(), words) for words in texts[r.doc_id])


def in_order(some, words):
    rest = iter(words)
    return all(w in rest for w in some)


def test_empty_tables(spark, staging):
    assert mixing.mix(no_documents(spark), staging).count() == 0
    assert mixing.mixed_documents(no_documents(spark), staging).count() == 0


def test_documents_without_words(spark, staging):
    docs = odd_documents(spark).where("doc_id in (100, 101, 102)")
    assert [r.taken for r in mixing.mix(docs, staging).collect()] == [0, 0, 0]
