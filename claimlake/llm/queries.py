"""The corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from claimlake.llm.centroids import cluster
from claimlake.llm.decontaminate import find_leaks
from claimlake.llm.hash_forest import nearest
from claimlake.llm.mixing import mix_sources
from claimlake.llm.near_dedup import near_duplicates
from claimlake.llm.oracle import ORACLE as ORACLE
from claimlake.llm.quality import score_quality
from claimlake.llm.ranked_search import ranked_search
from claimlake.llm.secrets import find_secrets, span_text
from claimlake.llm.sharding import record_size, shuffle_shards
from claimlake.llm.suffix_dedup import remove_repeats
from claimlake.llm.token_counts import edited_counts, read_vocabulary, redactions
from claimlake.llm.topk import top_k
from claimlake.llm.toxicity import score_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                        F.col("_target").alias("target"), F.col("_taken").alias("taken"),
                        F.col("_copies").alias("copies"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", size.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2(F.col("kept"), 256).alias("kept_sha256"))


#: A rank file of a public byte-level vocabulary, and what the edits of the query take out.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PERSONAL = r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|\+?[0-9][0-9 ()-]{6,}[0-9]"


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts before and after mail addresses and long numbers are redacted."""
    edits = redactions(F.col("text"), PERSONAL, "[redacted]")
    return edited_counts(_table(spark, sf_dir, "documents"), read_vocabulary(spark, VOCABULARY), edits).drop("tree_sums")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return shuffle_shards(_table(spark, sf_dir, "documents")).select(
        "doc_id", record_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.col("_grown_shard").alias("grown_shard"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def op11_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_source_mix": op3_source_mix,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_quality": op6_quality,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_sharding": op8_sharding,
    "op9_top_k": op9_top_k,
    "op10_secrets": op10_secrets,
    "op11_hash_forest": op11_hash_forest,
    "op12_ranked_search": op12_ranked_search,
    "op13_centroids": op13_centroids,
    "pipeline": corpus_pipeline.run,
}
