import random

import public_tokenizers
import pytest

from cases import no_documents, odd_documents
from flowvigil.llm import tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = ["a", "b", "th", "er", " ", "  ", "\n", "▁", "é", "ß", "日", "本", "🙂", "<s>", "##", "...", "\x00", "ing", "http://", "23", "\t"]


@pytest.fixture(scope="module")
def counter():
    return tokens.PrefixCounter(MODEL)


def test_every_prefix_counts_as_the_library_counts_it(counter):
    rng = random.Random(3)
    for _ in range(800):
        text = "".join(rng.choices(SIGNS, k=rng.randint(0, 14)))
        got = tokens.counts_at(counter.deltas(text)).tolist()
        assert got == [len(counter.encoder.encode(text[:j])) for j in range(1, len(text) + 1)], text


def test_memory_limits_do_not_change_counts(counter, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    monkeypatch.setattr(tokens, "REMEMBERED_PARTS", 5)
    own = tokens.PrefixCounter(MODEL)
    for text in ("some words of a text, and some more words", "the same words again, again"):
        assert own.deltas(text) == counter.deltas(text)


def test_odd_documents(spark, counter):
    docs = odd_documents(spark)
    got = tokens.token_counts(docs, MODEL, (10, 4096)).collect()
    texts = [r.text or "" for r in docs.select("text").collect()]
    assert [r.n_tokens for r in got] == [len(counter.encoder.encode(t)) for t in texts]
    assert [r.n_bytes for r in got] == [len(t.encode()) for t in texts]
    assert [r.doc_id for r in got] == [r.doc_id for r in docs.select("doc_id").collect()]
    for r, t in zip(got, texts):
        assert r.over_4096 == (r.n_tokens > 4096)
        if r.over_10:
            assert len(counter.encoder.encode(t[: r.kept_chars_10])) <= 10
            assert len(counter.encoder.encode(t[: r.kept_chars_10 + 1])) > 10
        else:
            assert r.kept_chars_10 == len(t)


def test_tables_can_be_kept(spark, counter):
    kept = tokens.prefix_tables(odd_documents(spark).where("doc_id = 3"), MODEL).first()
    text = odd_documents(spark).where("doc_id = 3").first().text
    assert tokens.counts_at(bytes(kept.deltas))[-1] == len(counter.encoder.encode(text))


def test_empty_table(spark):
    assert tokens.token_counts(no_documents(spark), MODEL).count() == 0
