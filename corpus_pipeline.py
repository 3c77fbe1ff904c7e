"""From raw documents to encoded training text: five stages, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import bpe, langid, line_dedup, mixing, ngram_join
from siltstone.llm.common import free_name, materialize, table

#: From this score on the predicted language replaces the one that a document came with.
SURE = 0.9

#: SQL cannot express the language and encoding stages; tests hold the stages against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null or empty text, or no letters) go. The others' lang is the predicted one where it was null or the prediction is sure.

    Repeated rows are judged alike, an empty table stays empty, other columns are kept, whatever their names.
    """
    pred, score = free_name(docs, "_pred"), free_name(docs, "_score")
    rows = langid.annotate(docs, pred_col=pred, score_col=score).where(F.col(pred) != langid.UNKNOWN)
    return rows.withColumn("lang", F.when(F.col("lang").isNull() | (F.col(score) >= SURE), F.col(pred)).otherwise(F.col("lang"))).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines equal or similar to an earlier line go; a document of which no words stay goes, also one that had none.

    Of repeated rows of one id each keeps what the id keeps; rows without id stay as they are; other columns are kept.
    """
    return line_dedup.clean_documents(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id: five words, a similarity of 0.8.

    Documents without words are nobody's copies; rows of one id stay or go together; rows without id stay; other columns are kept.
    """
    return ngram_join.distinct_documents(docs, n=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares; a document may come twice, whole or in part, and one without words does not come.

    Null sources are a source, repeated rows each count, other columns are kept, whatever their names.
    """
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text that they decode to."""
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("language ID", language_id),
    ("line dedup", dedup_lines),
    ("near duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
