"""The operators as stages of a corpus pipeline: documents in, documents in the same columns out."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mixing, ngram_join, pieces, quality, toxicity
from .common import discard, filter_texts, map_texts
from .queries import THRESHOLD, piece_model, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with a toxicity below THRESHOLD. The labelled rows of the corpus teach the model.

    Null, empty and wordless texts have the base rate of the labels, and stay wherever that is lower; texts are read whole; repeated rows, null ids and
    equal scores make no difference; no documents in, none out. All columns stay, whatever their names. Without labels all stay.
    """
    model = toxicity.fit_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

    return filter_texts(docs, lambda: lambda texts: [found[0] < THRESHOLD for found in model.score_many(texts, shown=False)])


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with a quality of at least THRESHOLD.

    Null texts count as empty; texts are read whole; repeated rows and null ids make no difference; no documents in, none out. All columns stay, whatever
    their names. Without labels all stay.
    """
    model = quality.fit_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_texts(docs, lambda: lambda texts: [model.score(text) >= THRESHOLD for text in texts])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    return ngram_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of their sources takes each: not at all, once or twice.

    Null and wordless texts have size 0, texts of any length are taken whole, a null source is a source of its own, null ids are ordered
    like any other, repeated rows are taken each for itself, no documents give none. All columns stay, whatever their names.
    """
    size = mixing.word_count(F.col("text"))
    decided = mixing.mix_sources(docs.select("doc_id", "source", size.alias("size")))
    return mixing.take_mix(docs, decided, size)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (with an end id), n_tokens, and the digest of what the ids decode to.

    Null texts count as empty, texts are encoded whole, null ids stay, repeated rows come out repeated, no documents give none; other columns are dropped, whatever their names.
    """
    model = piece_model(spark)

    def make():
        codec = pieces.PieceCodec(model)

        def run(text):
            ids = [*codec.encode(text), codec.eos]
            return ids, len(ids), hashlib.sha256(codec.decode(ids).encode()).hexdigest()

        return run

    return map_texts(docs.select("doc_id", "text"), ["doc_id"], make, "ids array<int>, n_tokens long, decoded_sha256 string")
