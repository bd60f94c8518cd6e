"""The registered queries of the training-data operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import (best_fit, bpe_count, cube_mix, dual_tree, fill_middle, hash_tree, host_trust, leak_scan, line_suffix,
                         one_bit_ann, pivot_neardup, sketch_join, subword_classifier)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pivot_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_neardup.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_count.token_counts(table(spark, sf_dir, "documents"), vocabulary(), max_tokens=1024)


def op3_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (sketch_join.near_duplicates(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_shingles", "component_id"))


def op4_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.assign(table(spark, sf_dir, "documents"), shards=24)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_suffix.delete_repeats(docs, min_words=50)


def op6_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube_mix.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)


def op7_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (host_trust.judge(table(spark, sf_dir, "pages"))
            .select("page_id", "host", "path", "rule", "verdict"))


def op8_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_bit_ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_documents(table(spark, sf_dir, "documents"), vocabulary(), capacity=1024, end_id=2)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = subword_classifier.fit(docs, table(spark, sf_dir, "labels"), label="quality")
    return subword_classifier.classify(docs, model, threshold=0.3)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = fill_middle.transform(docs, plain_above=90, spm_below=20)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2(F.col("output"), 256).alias("output_sha256"),
                      F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_leak_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = leak_scan.find(docs, table(spark, sf_dir, "benchmark"), size=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op13_dual_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of corpus_pipeline.py, one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pivot_near_vectors, op2_token_counts, op3_parity_sketch_join, op4_hash_tree_shards,
                            op5_line_dedup, op6_cube_mix, op7_link_trust, op8_one_bit_search, op9_best_fit_packing,
                            op10_quality_classifier, op11_fill_middle, op12_leak_scan, op13_dual_tree_codes, pipeline)}
