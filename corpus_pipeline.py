"""A corpus pipeline over `documents`: each stage is written as Parquet and read again by the next.

quality rules -> near duplicates -> repeated substrings -> benchmark passages -> piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.llm import decontamination, ngram_jaccard, quality_rules, sentencepiece_lattice, suffix_dedup
from millwatch.llm.shared import small_batches, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified rules keep."""
    small_batches(spark)
    return quality_rules.kept_rows(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a similarity of 0.8 or more on five-word shingles: the one with the smallest id."""
    small_batches(spark)
    return ngram_jaccard.one_of_each(docs, shingle=5, percent=80)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 200 bytes that also occur elsewhere; n_chars follows. Documents with nothing left go."""
    small_batches(spark)
    cut = suffix_dedup.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.without_items(docs, table(spark, sf_dir, "benchmark"))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_pieces, ids."""
    ids = sentencepiece_lattice.encode(docs.select("doc_id", "lang", "source", "text"))
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_pieces"), "ids")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_substrings),
    ("benchmark decontamination", benchmark_passages),
    ("SentencePiece encoding and decoding", piece_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
