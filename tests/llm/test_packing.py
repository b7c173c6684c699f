import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from cases import no_documents, odd_documents
from flowvigil.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")
SIGNS = ["a", "The", "th", "er", " ", "\n", "é", "é", "́", "ß", "É", "日", "🙂", "<|endoftext|>", "<|end", "##", "...", "'s", "'", "ing", "1", "²", "µ", "\x85", "İ", "ŉ", "x-y"]


@pytest.fixture(scope="module")
def encoder():
    return packing.ChunkEncoder(FILE, 2)


def test_chunks_encode_as_the_library_encodes_texts(encoder):
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choices(SIGNS, k=rng.randint(0, 14)))
        got = np.frombuffer(encoder(text.encode()), "<u4").tolist()
        assert got == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2], text


def test_texts_together_encode_as_each_alone(encoder):
    rng = random.Random(6)
    texts = ["".join(rng.choices(SIGNS, k=rng.randint(0, 14))) for _ in range(3000)]
    got = list(encoder.encoded(pa.array([t.encode() for t in texts], pa.binary())))
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2], text


def test_memory_limits_do_not_change_ids(encoder, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 4)
    own = packing.ChunkEncoder(FILE, 2)
    for text in (b"some words of a text, and some more", b"the same words " + b"z" * 500 + b" again", b""):
        assert own(text) == encoder(text)


def check_packing(rows, lengths):
    """Every id once, sequences gapless and within the capacity; the share of padding."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for key, start, length, tokens, sequence, offset in rows:
        sequences[sequence].append((offset, length))
        documents[key].append((start, length))
        assert tokens == lengths[key] and length > 0
    padding = 0
    for pieces in sequences.values():
        total = 0
        for offset, length in sorted(pieces):
            assert offset == total
            total += length
        assert total <= packing.CAPACITY
        padding += 0 if total & (total - 1) == 0 else packing.CAPACITY - total
    for key, length in lengths.items():
        at = 0
        for start, n in sorted(documents[key]):
            assert start == at
            at += n
        assert at == length
    return padding / max(1, sum(lengths.values()))


@pytest.mark.parametrize("seed", range(4))
def test_packer_keeps_every_id_and_pads_little(seed):
    rng = random.Random(seed)
    lengths = {i: rng.choice([1, 2, rng.randint(1, 300), rng.randint(1, 9000), 4096, 4097]) for i in range(400)}
    packer, rows = packing.Packer(0), []
    for key, n in lengths.items():
        rows += packer.add(key, np.arange(n, dtype="<u4").tobytes())
    rows += packer.rest()
    assert check_packing([(r[0], r[1], r[2], r[4], r[5], r[6]) for r in rows], lengths) < 0.01


def test_bins_of_a_class_hold_its_number_of_pieces():
    packer = packing.Packer(0)
    rows = [r for i in range(200) for r in packer.add(i, bytes(4 * 60))]  # class 4096 // 60 = 68
    assert len(rows) == 136 and {r[5] for r in rows} == {0, 1}


def test_odd_documents_round_trip(spark, encoder):
    docs = odd_documents(spark).where("doc_id is not null and doc_id <> 104")
    got = packing.pack(docs, FILE, 2, keep_ids=True).collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)
    texts = {r.doc_id: encoder((r.text or "").encode()) for r in docs.collect()}
    check_packing(
        [(r.doc_id, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset) for r in got],
        {k: len(v) // 4 for k, v in texts.items()},
    )
    for key, ids in texts.items():
        assert b"".join(bytes(r.ids) for r in sorted(got, key=lambda r: r.start) if r.doc_id == key) == ids


def test_null_ids_and_repeated_rows_stay(spark):
    got = packing.pack(odd_documents(spark), FILE, 2).groupBy("doc_id").sum("length").collect()
    sizes = {r.doc_id: r["sum(length)"] for r in got}
    assert None in sizes and sizes[104] == 3 * sizes[0] and sizes[100] == 1


def test_empty_table(spark):
    assert packing.pack(no_documents(spark), FILE, 2).count() == 0
