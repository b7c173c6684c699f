import hashlib
import random
import re

from pyspark.sql import functions as F

from cases import no_documents, odd_documents
from flowvigil.llm import decontamination

ITEMS = "item_id bigint, text string, words int, phrase string"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, size):
    windows = {}
    for item, text in items:
        own = words(text)
        if item is not None and own:
            for i in range(max(1, len(own) - size + 1)):
                windows.setdefault(tuple(own[i : i + size]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for window, ids in windows.items():
            for i in range(len(own) - len(window) + 1):
                if tuple(own[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def test_odd_documents(spark, staging):
    docs = odd_documents(spark).withColumns({c: F.lit(1) for c in ("word", "segment", "row", "places", "n", "item_id")})
    texts = [r.text for r in docs.collect()]
    rng, given = random.Random(4), []
    for i, text in enumerate(texts[:20]):
        own = words(text)
        at = rng.randrange(len(own))
        given.append((i, " ".join(own[at : at + rng.randint(1, 25)]).upper(), 1, "x"))
    given += [(900, None, 1, "x"), (901, "", 1, "x"), (902, "-- !", 1, "x"), (None, texts[0], 1, "x"), (903, "THE", 1, "x"), (904, "the", 1, "x"),
              (0, "w1 w2", 1, "x"), (905, "word1 and word2 and word3 and word4 and word5 and word6", 1, "x"), (906, "é日本 ß", 1, "x"), (907, "nowhere at all", 1, "x")]
    items = spark.createDataFrame(given, ITEMS)
    for size in (10, 3):
        got = decontamination.contamination(docs, items, staging, size=size).collect()
        assert sorted(map(tuple, got), key=repr) == brute([(r.doc_id, r.text) for r in docs.collect()], [x[:2] for x in given], size)


def test_matches_do_not_cross_documents_or_segments(spark, staging):
    docs = spark.createDataFrame([(i, "a b c d" if i % 2 else "e f g h") for i in range(40)], "doc_id bigint, text string").coalesce(1)
    items = spark.createDataFrame([(1, "d e"), (2, "h a"), (3, "b c")], "item_id bigint, text string")
    got = decontamination.contamination(docs, items, staging).collect()
    assert all((r.n_hit, r.n_items) == ((2, 1) if r.doc_id % 2 else (0, 0)) for r in got)


def near_brute(own, phrase, slop):
    """Tightest occurrences, in order, around each place of every word, within the slop."""
    found = set()
    for start in range(len(own)):
        if own[start] == phrase[0]:
            at = start
            for w in phrase[1:]:
                at = next((i for i in range(at + 1, len(own)) if own[i] == w), None)
                if at is None:
                    break
            if at is not None and at - start + 1 - len(phrase) <= slop:
                found.add(at)
    return found


def test_proximity(spark, staging):
    rng = random.Random(8)
    texts = [" ".join(rng.choices("abcdefgh", k=60)) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    phrases = [(i, rng.sample("abcdefgh", 3)) for i in range(12)]
    postings = decontamination.index(docs, staging)
    found = decontamination.search(postings, spark.createDataFrame(phrases, "phrase bigint, words array<string>"), staging, slop=2)
    ids = {(r.segment, r.row): r.doc_id for r in postings.where("word is null").collect()}
    got = {(ids[r.segment, r.row], r.phrase) for r in found.collect()}
    assert got == {(d, p) for d, t in enumerate(texts) for p, w in phrases if near_brute(t.split(), w, 2)}
    for r in found.collect():
        own, phrase = texts[ids[r.segment, r.row]].split(), dict(phrases)[r.phrase]
        for a, b in zip(r["first"], r["last"]):
            assert own[a] == phrase[0] and own[b] == phrase[-1] and b - a + 1 - 3 <= 2


def test_empty_tables(spark, staging):
    items = spark.createDataFrame([(1, "a b", 1, "x")], ITEMS)
    assert decontamination.contamination(no_documents(spark), items, staging).count() == 0
    got = decontamination.contamination(odd_documents(spark), items.limit(0), staging).collect()
    assert len(got) == odd_documents(spark).count() and not any(r.contaminated for r in got)
    assert {r.items_sha256 for r in got} == {hashlib.sha256(b"").hexdigest()}
