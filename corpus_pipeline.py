"""Corpus pipeline: stages that each read what the one before has kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from flowvigil.llm import stages
from flowvigil.llm.shared import table
from flowvigil.staging import shared_folder

#: (name, function); a function takes (spark, docs, sf_dir).
STAGES = [
    ("good_quality", stages.good_quality),
    ("near_duplicates", stages.near_duplicates),
    ("repeated_passages", stages.repeated_passages),
    ("source_mix", stages.source_mix),
    ("packed", stages.packed),
]

#: The rows of run() depend on trained scores, fingerprints and tokenizers, which SQL has not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each to the Parquet files of the one before."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for at, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{at}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
