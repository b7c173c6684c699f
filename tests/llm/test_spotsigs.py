import base64
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import no_documents, odd_documents
from flowvigil.llm import spotsigs


def slow_rows(rows):
    """The same results from one list in id order."""
    rows = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    out = []
    for r, following in zip(rows, rows[1:] + rows[:1]):
        text, other = r.text or "", following.text or ""
        half = len(text) // 2
        new = text[: len(text) - half] + other[:half]
        a, b, c = (set(spotsigs.signature_set(x).tolist()) for x in (text, new, other))
        write = lambda s: base64.b64encode(np.array(sorted(s), "<u4").tobytes()).decode()
        digest = hashlib.sha256(new.encode()).hexdigest()
        out.append((r.doc_id, len(text), digest, write(a), write(b), len(a & b) / len(a | b), len(a & c) / len(a | c)))
    return out


@pytest.mark.parametrize("width", [1, 4, 50])
def test_odd_documents_match_one_list(spark, width):
    docs = odd_documents(spark)
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        got = [tuple(r) for r in spotsigs.with_next(docs).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert sorted(got, key=str) == sorted(slow_rows(docs.collect()), key=str)


def test_given_documents_match_one_list(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = [tuple(r) for r in spotsigs.with_next(docs).collect()]
    assert sorted(got) == sorted(slow_rows(docs.select("doc_id", "text").collect()))


def test_chains_by_hand():
    one = spotsigs.signature_set("The quick fox and the lazy dog sleeps")
    # the>quick fox, and>lazy dog, the>lazy dog
    assert len(one) == 3
    same = spotsigs.signature_set("the QUICK fox, and (the) lazy dog! ")
    assert set(same) == set(one)
    assert len(spotsigs.signature_set("")) == len(spotsigs.signature_set("nothing common here")) == 1
    assert spotsigs.likeness(spotsigs.signature_set(""), spotsigs.signature_set(" ")) == 0.0
    assert spotsigs.likeness(one, one) == 1.0


def test_one_row_and_no_rows(spark):
    docs = odd_documents(spark)
    row = spotsigs.with_next(docs.where("doc_id = 3")).first()
    assert row.near_next == 1.0
    assert spotsigs.with_next(no_documents(spark)).count() == 0


def test_fingerprints_hold_the_sets(spark):
    docs = odd_documents(spark)
    got = spotsigs.fingerprints(docs).where("doc_id = 3").first()
    text = docs.where("doc_id = 3").first().text
    assert got.signatures == spotsigs.signature_set(text).tolist() and got.n_signatures == len(got.signatures)


@pytest.mark.parametrize("least", [0.8, 0.5])
def test_similar_sets_match_all_pairs(spark, staging, least):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(odd_documents(spark).select(
        "doc_id", "text", "lang", "source", "n_chars").withColumn("doc_id", F.col("doc_id") + 1000))
    members, pairs = spotsigs.similar_sets(docs, staging, least)
    sets, classes = {}, {}
    for r in docs.orderBy("doc_id").collect():
        if r.doc_id is not None:
            key = tuple(spotsigs.signature_set(r.text or "").tolist())
            classes[r.doc_id] = sets.setdefault(key, r.doc_id)
    assert {r.doc_id: r.class_id for r in members.collect()} == classes
    named = [(c, set(k)) for k, c in sets.items()]
    want = {
        (min(a, b), max(a, b)): len(x & y) / len(x | y)
        for i, (a, x) in enumerate(named) for b, y in named[:i] if len(x & y) >= least * len(x | y)
    }
    assert {(r.class_id, r.other_id): r.likeness for r in pairs.collect()} == want and want
    assert all(df.count() == 0 for df in spotsigs.similar_sets(no_documents(spark), staging))
