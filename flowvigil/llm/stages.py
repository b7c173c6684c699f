"""The stages of the corpus pipeline, each with one operator of this subpackage.

A stage takes (spark, docs, sf_dir) and returns the columns of ``docs``; the last returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowvigil.llm import mixing, packing, passages, quality, simhash
from flowvigil.llm.shared import table
from flowvigil.staging import Staging

#: Score from which a document counts as good.
QUALITY_BOUND = 0.3
#: Ends a document in a packed sequence.
END_ID = 2


def with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` set to the length of the text as it is now."""
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast("bigint"), F.col("n_chars")))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the classifier, fitted on the labelled ones among them, scores as good.

    A null text is scored as an empty one. Null ids, repeated rows and other columns, whatever their names, are kept as
    they are; an empty table gives an empty one.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"), Staging(spark))
    return quality.keep_good(docs, model, QUALITY_BOUND)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of every near-duplicate component.

    Of repeated rows of that doc_id one row stays. Rows with a null doc_id have no place in that
    order and stay. A null text has no words, like an empty one. Other columns, whatever their names, are kept as they
    are; an empty table gives an empty one.
    """
    found = simhash.near_duplicates(docs, Staging(spark))
    keepers = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    named = docs.join(keepers, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages out that an earlier document holds too; a document of nothing else goes.

    Rows of one doc_id are one document; those with a null doc_id or text stay. Other columns, whatever their names, are
    kept as they are; an empty table gives an empty one.
    """
    found = passages.repeats(docs, Staging(spark))
    return with_length(passages.without_repeats(docs, found))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents as often and as far as the target weights of their sources ask for.

    Null sources are one source, null ids and repeated rows are rows like all others, and rows with a null text or
    without words go. Other columns, whatever their names, are kept as they are; an empty table gives an empty one.
    """
    return with_length(mixing.mixed_documents(docs, Staging(spark)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their tokens, in sequences of at most 4096.

    The mix can hold two rows of one doc_id with different texts; ``row`` tells whose a piece is. A null text is the end
    id alone, null ids stay null, and other columns are not read; an empty table gives an empty one.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, keep_ids=True, number_rows=True)
