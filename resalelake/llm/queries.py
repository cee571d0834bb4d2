"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resalelake.llm import alignment, bitpack, centroids, line_dedup, lm_mixing, packing, pq, sharding, simhash, token_counts, toxicity, warc, winnow
from resalelake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: The vocabulary file of the token-id files.
ID_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: The vocabulary file of packed documents.
PACK_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

#: The vocabularies that are aligned.
ALIGN_A = public_tokenizers.path("byte_bpe_50k.json")
ALIGN_B = public_tokenizers.path("piece_bpe_32k.model")
#: The vocabulary file of token counts.
COUNT_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def context_mixing_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_mixing.score(table(spark, sf_dir, "documents"))


def benchmark_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def bit_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.read_digests(bitpack.write_ids(table(spark, sf_dir, "documents"), ID_VOCABULARY))


def warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.normalise(warc.write_archives(table(spark, sf_dir, "pages"))))


def pq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.near_duplicates(table(spark, sf_dir, "embeddings"))


def nonnegative_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    score = F.col("__score")
    return found.select("doc_id", toxicity.held_out().alias("held_out"), score.alias("score"), (score >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def line_dedup_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.withColumnsRenamed({"__n_lines": "n_lines", "__n_removed": "n_removed"})


def minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``bytes``: sizes as equal as groups of equal texts allow."""
    return sharding.assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), PACK_VOCABULARY)


def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.clustered(table(spark, sf_dir, "embeddings"))
    digits = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(digits.cast("binary"), 256).alias("centroid_sha256"))


def merge_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"), COUNT_VOCABULARY)


def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.aligned(table(spark, sf_dir, "documents"), ALIGN_A, ALIGN_B)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


QUERIES: dict[str, Query] = {
    "op1_context_mixing_scores": context_mixing_scores,
    "op2_benchmark_winnowing": benchmark_winnowing,
    "op3_bit_packed_ids": bit_packed_ids,
    "op4_warc_normaliser": warc_normaliser,
    "op5_pq_near_dedup": pq_near_dedup,
    "op6_nonnegative_pu_toxicity": nonnegative_pu_toxicity,
    "op7_simhash_near_dedup": simhash_near_dedup,
    "op8_line_dedup": line_dedup_windows,
    "op9_minimax_shards": minimax_shards,
    "op10_best_fit_packing": best_fit_packing,
    "op11_equal_variance_clusters": centroid_clusters,
    "op12_merge_token_counts": merge_token_counts,
    "op13_tokenizer_alignment": tokenizer_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op2_benchmark_winnowing": winnow.ORACLE.format(docs="documents", items="benchmark"),
    "op4_warc_normaliser": warc.ORACLE.format(pages="pages"),
    "op5_pq_near_dedup": pq.ORACLE.format(vectors="embeddings"),
    "op8_line_dedup": line_dedup.ORACLE.format(docs="documents"),
    "op11_equal_variance_clusters": centroids.ORACLE.format(vectors="embeddings"),
}
