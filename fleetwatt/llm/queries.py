"""Registered queries of the training-data operators, over whole tables.

Each takes (spark, sf_dir). They derive their columns from the operators' own results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetwatt.llm import (
    bpe, conversations, embeddings, jaccard, line_dedup, packing, quality, sharding, spelling,
    suffix_dedup, token_counts, toxicity, warc,
)
from fleetwatt.plans.lineage import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


@query
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encode_decode(docs, keep_text=False).select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(table(spark, sf_dir, "documents", "doc_id", "text", "lang"), keep=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"),
    )


@query
def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with even ids go through version 1 archives, the others through version 2."""
    old, new = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    pages = warc.captures(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    second = F.coalesce(F.pmod("page_id", F.lit(2)), F.lit(0)) == 1
    warc.write_arc(pages.where(~second), f"{old}/1", version=1)
    warc.write_arc(pages.where(second), f"{old}/2", version=2)
    warc.write_warc(warc.arc_to_warc(spark, f"{old}/*"), new)
    back = warc.refer_pages(warc.read_warc(spark, new, payloads=False))
    return back.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to_page").alias("refers_to"), "digest_ok"
    )


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.toxicity(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


@query
def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return embeddings.near_duplicates(vectors).select("vec_id", "n_links", "component_id", "kept")


@query
def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.words_of(table(spark, sf_dir, "documents", "doc_id", "text"))
    return spelling.spelling_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


@query
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.document_shards(table(spark, sf_dir, "documents", "doc_id", "text"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, those of which damage leaves no row among them."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    found = conversations.summaries(conversations.repair_conversations(conversations.damage(rows)))
    found = found.withColumnRenamed("conv_id", "_conv")
    every = rows.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    empty = {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))}
    return joined.withColumns({**zero, **empty}).drop("_conv")
