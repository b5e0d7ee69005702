"""Registered queries of the subpackage: each applies one operator, with its
production parameters, to the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm import (
    byte_bpe,
    chosen_path,
    fair_mix,
    html_template,
    kd_shards,
    latent_leaks,
    license_index,
    line_winnow,
    prefix_trie,
    quality_llr,
    subvector_kmeans,
    suffix_lpf,
    toxic_chain,
)
from ratelake.llm.oracles import ORACLES
from ratelake.llm.sparkkit import table

SHARDS = 8

#: rank file and split pattern of the byte-level vocabulary
RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.jaccard_join(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(table(spark, sf_dir, "pages"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kd_shards.kd_shards(table(spark, sf_dir, "documents"), n_shards=SHARDS)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_chain.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_winnow.drop_repeated_lines(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent_leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "source", fair_mix.n_words().alias("size"))
    mix = fair_mix.queue(docs)
    return mix.queued.select("doc_id", "size", "source_size", "target", (F.col("size") * fair_mix.copies(mix)).cast("long").alias("taken"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality_llr.trusted_sample(table(spark, sf_dir, "labels"))
    out = quality_llr.judged(table(spark, sf_dir, "documents"), trusted)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_index.scan(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_lpf.drop_repeats(table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = byte_bpe.vocabulary(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    out = byte_bpe.round_trip(table(spark, sf_dir, "documents"), vocab)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turns(table(spark, sf_dir, "conversations"))))


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = subvector_kmeans.cluster(table(spark, sf_dir, "embeddings"))
    return subvector_kmeans.with_inertia(assigned, centroids)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_ngram_jaccard,
            op2_html_extraction,
            op3_sharding,
            op4_toxicity,
            op5_line_dedup,
            op6_decontamination,
            op7_mixing,
            op8_quality,
            op9_license_scan,
            op10_suffix_dedup,
            op11_byte_bpe,
            op12_prefix_trie,
            op13_clustering,
        )
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
