"""The corpus pipeline: five operators, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sentrylake.llm import stages
from sentrylake.llm.common import materialize

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("quality_classifier", stages.drop_poor),
    ("ngram_jaccard_join", stages.drop_copies),
    ("source_mixing", stages.mix),
    ("sentencepiece", stages.encode),
]

#: The trained and the hash-ordered stages have no SQL; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
