import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cases import no_documents, odd_documents
from flowvigil.llm import alignment

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SIGNS = [
    "a", "b", "th", "er", " ", "  ", "\n", "▁", "é", "ß", "日", "本", "🙂", "<s>", "##", "...", "\x00", "ing", "http://", "23", "\t", "\r", " ",
    "　", "\x85", " ", "'s", "'ll", "́", "<|endoftext|>", "ё", "\x1c", "\x0b", ";\r", "<0x0A>", "don't", "e.g.", "U.S.",
]


class Plain:
    """Both libraries on whole texts, and overlaps byte range by byte range."""

    def __init__(self):
        self.own = alignment.TwoTokenizers(*FILES)
        self.a, self.b = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
        self.a.encode_special_tokens = True

    def __call__(self, text):
        if not text:
            return 0, 0, 0, [], ""
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        bytes_a, bytes_b = [self.own.bytes_a[i] for i in a], [self.own.bytes_b[i] for i in b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return 0, 0, 0, [], ""
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        links = []
        for i, x in enumerate(a):
            low = ends_a[i] - len(bytes_a[i])
            for j in range(np.searchsorted(ends_b, low, "right"), len(b)):
                if ends_b[j] - len(bytes_b[j]) >= ends_a[i]:
                    break
                links.append((x, b[j]))
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            i_end, j_end = np.searchsorted(ends_a, cut, "right"), np.searchsorted(ends_b, cut, "right")
            groups.append(",".join(map(str, a[i:i_end])) + "|" + ",".join(map(str, b[j:j_end])))
            i, j = i_end, j_end
        return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


@pytest.fixture(scope="module")
def plain():
    return Plain()


def checked(plain, texts):
    counts, digests, tables = alignment.align(plain.own, pa.array([b" " + t.encode() if t else b"" for t in texts], pa.binary()))
    links = Counter((r["row"], r["pair"]) for t in tables for r in t.to_pylist())
    width, wanted = len(plain.own.length_b), Counter()
    for i, text in enumerate(texts):
        n_a, n_b, n_groups, pairs, digest = plain(text)
        assert (n_a, n_b, n_groups, len(pairs), digest) == (*(int(counts[x][i]) for x in ("n_a", "n_b", "n_groups", "n_links")), digests[i]), text
        wanted.update((i, a * width + b) for a, b in pairs)
    assert links == wanted


def test_segments_give_what_whole_texts_give(plain):
    rng = random.Random(5)
    checked(plain, ["".join(rng.choices(SIGNS, k=rng.randint(0, 25))) for _ in range(1500)])


def test_slices_and_forgetting_change_nothing(plain, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", 3)
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    plain.own.known.clear()
    checked(plain, ["some words of a text, and some more words", "", "x", "the same words again, again"])


def test_odd_documents(spark, staging, plain):
    docs = odd_documents(spark).withColumns({c: F.lit(1) for c in ("block", "row", "pair", "links", "place", "count", "best", "n_a")})
    rows = docs.collect()
    made = [plain(r.text) for r in rows]
    total = Counter(x for m in made for x in m[3])
    best = {}
    for (_, b), n in total.items():
        best[b] = max(best.get(b, 0), n)
    wanted = [
        (r.doc_id, m[0], m[1], m[2], len(m[3]), sum(total[x] == best[x[1]] for x in m[3]), sum(total[x] for x in m[3]), m[4])
        for r, m in zip(rows, made)
    ]
    found, pairs = alignment.aligned(docs, staging, *FILES)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)
    assert {(r.a, r.b): (r["count"], r.best) for r in pairs.collect()} == {x: (n, n == best[x[1]]) for x, n in total.items()}


def test_blocks_are_put_together(spark, staging, plain, monkeypatch):
    texts = [f"text number {i} of {i % 7}, again" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(6)
    found, _ = alignment.aligned(docs, staging, *FILES)
    total = Counter(x for t in texts for x in plain(t)[3])
    assert {r.doc_id: r.count_sum for r in found.collect()} == {i: sum(total[x] for x in plain(t)[3]) for i, t in enumerate(texts)}


def test_empty_table(spark, staging):
    found, pairs = alignment.aligned(no_documents(spark), staging, *FILES)
    assert found.count() == 0 and pairs.count() == 0
