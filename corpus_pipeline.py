"""A corpus cleaning pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All but the last
return the columns of ``documents``; ``n_chars`` follows the text where it changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import fmindex, linejoin, quality, sigtree, unigram
from tillroll.llm.common import read_table, written


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint"))


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality policy rejects."""
    return quality.keep_quality(docs)


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that an earlier line matches; a document left without a word goes."""
    return _recounted(linejoin.drop_repeated_lines(docs))


def stage_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of every group of near copies."""
    return sigtree.keep_one(docs)


def stage_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut benchmark phrases out of the texts."""
    return _recounted(fmindex.remove_hits(docs, read_table(spark, sf_dir, "benchmark")))


def stage_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every document to piece ids; ``decoded`` is spelled from the ids."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return unigram.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), path)


STAGES = [
    ("quality_rules", stage_quality),
    ("line_dedup", stage_lines),
    ("jaccard_join", stage_near_copies),
    ("decontamination", stage_benchmark),
    ("sentencepiece", stage_pieces),
]

# Viterbi decoding and the tokenizer file have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last stage's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
