import corpus_pipeline
import pytest

import __spark_entry__
from cases import no_documents, odd_documents
from flowvigil.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_stages_run_on_the_given_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        counts.append(docs.count())
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
            assert docs.where("n_chars <> char_length(text)").count() == 0
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] <= counts[2]
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(docs.columns)


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


@pytest.mark.parametrize("make", [odd_documents, no_documents])
def test_stages_take_odd_tables(spark, tmp_path, make):
    docs = make(spark)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    assert (docs.count() > 0) == (make is odd_documents)


def test_all_queries_are_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(queries.ORACLE) <= set(__spark_entry__.oracle_sql())


def test_packed_sequences_hold_their_tokens_and_rows(spark):
    """Two rows of one doc_id, as the mix makes them: each text can be put together again from its pieces."""
    import public_tokenizers
    from flowvigil.llm import packing, stages

    texts = ["one text of some words " * 900, "another text " * 700, "short"]
    docs = spark.createDataFrame([(7, t, "en", "s", len(t)) for t in texts], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    by_row = {}
    for r in stages.packed(spark, docs, FOLDER).collect():
        assert r.doc_id == 7 and len(r.ids) == 4 * r.length
        by_row.setdefault(r.row, []).append((r.start, bytes(r.ids)))
    encode = packing.ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"), stages.END_ID)
    got = sorted(b"".join(ids for _, ids in sorted(pieces)) for pieces in by_row.values())
    assert got == sorted(encode(t.encode()) for t in texts)
