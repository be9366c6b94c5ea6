"""Corpus pipeline: quality rules, line dedup, near-duplicate groups, repeated passages, packing.

STAGES lists (name, function). Each function takes (spark, docs, sf_dir) and works on all that the
stage before it kept. All but the last return the columns of documents; what is read and written
between them is Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetwatt.llm import jaccard, line_dedup, packing, quality, suffix_dedup
from fleetwatt.llm.steps import stored

#: Near-duplicate documents: shingles of five words, similarity of 0.8 or more.
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; a third of junk in a language does not move them."""
    return quality.quality(docs, steady=True).where("kept").select(docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier line go; documents stay, even if no line is left."""
    return line_dedup.dedup_lines(docs).select(docs.columns).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similarity links, that of the smallest doc_id stays.

    Documents with equal sets of shingles are one group, too. Rows without an id stay.
    """
    groups = jaccard.similar_groups(docs, width=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    gone = groups.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that occur earlier go. A character that is cut in two goes, too."""
    cut = suffix_dedup.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, suffix_dedup.valid_text(F.col("kept"))).otherwise(F.col("text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences: the columns of op5."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", one_of_each_group),
    ("suffix_array_dedup", repeated_passages),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenizers and connected components have no SQL form; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each stored before the next one."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
